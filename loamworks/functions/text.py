"""Column expressions on text: cleaning, years, screening, extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import bound

# Ligatures and the long s with their plain letters.
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "ſ": "s"}
SHORTEST, FEWEST_WORDS, LEAST_UNIQUE = 1000, 200, 0.15
LINE_LENGTH, LINE_ALPHA = 20, 0.30


def plain_ligatures(text: Column) -> Column:
    for old, new in LIGATURES.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def squeezed_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def without_garbled_lines(text: Column) -> Column:
    """Drop lines of more than 20 characters with under 30 % letters."""
    fine = lambda l: (F.length(l) <= LINE_LENGTH) | (F.length(F.regexp_replace(l, r"[^\p{L}]", "")) / F.length(l) >= LINE_ALPHA)
    return F.array_join(F.filter(F.split(text, "\n", -1), fine), "\n")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def clean_ocr(text: Column) -> Column:
    """Light clean-up of scanned text; null where the text is to be rejected."""
    cleaned = without_garbled_lines(squeezed_newlines(plain_ligatures(text)))
    cleaned = F.when(F.length(text) >= SHORTEST, strip(cleaned))

    def fine(w: Column) -> Column:
        return (F.size(w) >= FEWEST_WORDS) & (F.try_divide(F.size(F.array_distinct(w)), F.size(w)) >= LEAST_UNIQUE)

    # Both the cleaned text and its words are computed once.
    return bound(cleaned, lambda t: F.when((F.length(t) >= SHORTEST) & bound(words(t), fine), t))


def parse_year(value: Column) -> Column:
    """A whole number from 1000 to 2100, else the first such year inside the text."""
    exact = F.when(F.trim(value).rlike("^[0-9]{1,9}$"), F.trim(value).try_cast("int"))
    found = F.nullif(F.regexp_extract(value, r"\b(1\d{3}|20\d{2})\b", 1), F.lit("")).try_cast("int")
    return F.coalesce(F.when(exact.between(1000, 2100), exact), found)


def before(year: Column, cutoff: int) -> Column:
    return F.coalesce(year < cutoff, F.lit(False))


# Words that point to the time after 1985.
LATE_KEYWORDS = [
    "iPhone", "iPad", "Android", "smartphone", "smart phone",
    "ChatGPT", "GPT-3", "GPT-4", "GPT-5", "Claude", "Gemini", "Copilot",
    "Wikipedia", "Google", "Amazon.com", "Facebook", "Meta", "Twitter",
    "TikTok", "Instagram", "YouTube", "Netflix", "Spotify", "Uber", "Airbnb",
    "World Wide Web", "the Web", "web browser", "Mosaic", "Netscape",
    "Internet Explorer", "Firefox", "Chrome browser", "Safari browser",
    "Bitcoin", "blockchain", "cryptocurrency", "NFT",
    "Obama", "Biden", "Trump", "Brexit",
    "9/11", "September 11", "World Trade Center attack",
    "fall of the Berlin Wall", "Berlin Wall fell",
    "dissolution of the Soviet Union", "collapse of the USSR",
    "Iraq War", "Afghanistan war", "Arab Spring",
    "COVID", "SARS-CoV", "coronavirus pandemic", "Omicron", "Delta variant",
    "CRISPR", "Cas9", "AlphaFold",
    "Higgs boson confirmed", "Higgs boson discovery", "Higgs discovery",
    "exoplanet",
    "Dolly the sheep", "induced pluripotent",
    "Human Genome Project",
    "gravitational wave detected", "LIGO detection",
    "transformer architecture", "transformer model", "self-attention",
    "deep learning revolution", "large language model", "LLM",
    "IPCC report", "Kyoto Protocol", "Paris Agreement",
]
LATE_YEAR = r"\b(?:198[5-9]|199\d|20\d{2}|21\d{2})\b"


def without_code(text: Column) -> Column:
    """Drop fenced, then inline code."""
    return F.regexp_replace(F.regexp_replace(text, r"(?s)```.*?```", " "), r"`[^`]*`", " ")


def late_hints(text: Column, keywords: list[str] = LATE_KEYWORDS, whole_words: bool = False) -> Column:
    """Whether the prose has a year from 1985 to 2199 or one of the keywords.

    Keywords match as substrings in either case; ``whole_words`` asks for word edges.
    """
    prose = without_code(text)
    lower = F.lower(prose)
    if whole_words:
        hit = lower.rlike(r"\b(?:" + "|".join(r"\Q" + k.lower() + r"\E" for k in keywords) + r")\b") if keywords else F.lit(False)
        return prose.rlike(LATE_YEAR) | hit
    hit = F.lit(False)
    for k in keywords:
        hit = hit | F.contains(lower, F.lit(k.lower()))
    return prose.rlike(LATE_YEAR) | hit


def last_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The last match of a pattern's group, null if there is none."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(-1))


def verdict(reply: Column) -> Column:
    """The last of SAFE, UNSAFE and UNSURE in a reply, UNSURE if there is none."""
    return F.coalesce(last_match(F.upper(reply), r"\b(UNSAFE|UNSURE|SAFE)\b"), F.lit("UNSURE"))


def answer_number(text: Column) -> Column:
    """The number after ``#### `` without commas, null if there is none."""
    return F.nullif(F.replace(F.regexp_extract(text, r"#### (\-?[0-9\.\,]+)", 1), F.lit(","), F.lit("")), F.lit(""))


def same_answer(given: Column, wanted: Column, strict: bool = False) -> Column:
    """Equality of extracted answers as 0 or 1; two missing answers are equal unless ``strict``."""
    a, b = answer_number(given), answer_number(wanted)
    return F.coalesce(a == b, F.lit(False)).cast("int") if strict else a.eqNullSafe(b).cast("int")


def without_reasoning(text: Column) -> Column:
    """Drop reasoning spans of both delimiter styles."""
    text = F.regexp_replace(text, r"(?s)<think>.*?</think>", "")
    return F.trim(F.regexp_replace(text, r"(?s)<\|channel\|>analysis.*?<\|end\|>", ""))


def json_body(text: Column) -> Column:
    """Text without a Markdown fence around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"(?s)^```[a-zA-Z]*\s*", ""), r"(?s)\s*```$", ""))


def program(text: Column) -> Column:
    """The first fenced code block, else the whole text, without white space around it."""
    fenced = F.nullif(F.regexp_extract(text, r"(?s)```(?:python)?\s*\n(.*?)\n```", 1), F.lit(""))
    return F.trim(F.coalesce(fenced, text))


def imports(text: Column) -> Column:
    """The import lines before the first other line (blank and comment lines pass)."""
    lines = F.transform(F.split(text, "\n"), lambda l: F.trim(l))
    start = F.struct(F.lit(True).alias("open"), F.array().cast("array<string>").alias("found"))

    def step(a: Column, l: Column) -> Column:
        is_import = l.rlike("^(import|from) ")
        passes = is_import | (l == "") | l.startswith("#")
        take = a["open"] & is_import
        return F.struct((a["open"] & passes).alias("open"), F.when(take, F.array_append(a["found"], l)).otherwise(a["found"]).alias("found"))

    return F.array_join(F.aggregate(lines, start, step)["found"], "\n")


def slug(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit(" "), F.lit("-"))


def spelled(word: Column) -> Column:
    """Letters of a word joined by commas."""
    return F.array_join(F.filter(F.split(word, ""), lambda c: c != ""), ",")


def letter_count(word: Column, letter: Column) -> Column:
    return (F.length(word) - F.length(F.replace(word, letter, F.lit("")))).cast("int")


def gpu_ranges(arg: Column) -> Column:
    """``0-1,4,6-7`` as a sorted array of distinct numbers."""

    def numbers(part: Column) -> Column:
        ends = F.split(F.trim(part), "-")
        return F.sequence(F.get(ends, F.lit(0)).cast("int"), F.try_element_at(ends, F.lit(-1)).cast("int"))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(arg, ","), numbers))))


# Peak FLOP/s by substrings of a device's name, the first row that matches.
PEAK_FLOPS = [
    (["gb200"], 2.5e15), (["grace blackwell"], 2.5e15), (["b200"], 2.25e15), (["b100"], 1.8e15),
    (["h200", "nvl"], 836e12), (["h200", "pcie"], 836e12), (["h200"], 989e12), (["h100", "nvl"], 835e12),
    (["h100", "pcie"], 756e12), (["h100"], 989e12), (["h800", "nvl"], 989e12), (["h800"], 756e12),
    (["a100"], 312e12), (["a800"], 312e12), (["a40"], 149.7e12), (["a30"], 165e12),
    (["l40s"], 362e12), (["l40-s"], 362e12), (["l40 s"], 362e12), (["l4"], 121e12),
    (["mi355"], 2.5e15), (["mi325"], 1.3074e15), (["mi300x"], 1.3074e15), (["mi300a"], 980.6e12),
    (["mi250x"], 383e12), (["mi250"], 362.1e12),
    (["5090"], 209.5e12), (["4090"], 165.2e12), (["3090"], 71e12),
]
# Dollars an hour by device type.
HOURLY = {"H100": 3.00, "A100": 1.79, "V100": 0.55}
HOURLY_OTHER = 2.00


def peak_flops(name: Column) -> Column:
    lower, out = F.lower(name), F.lit(float("inf"))
    for parts, flops in reversed(PEAK_FLOPS):
        fits = F.lit(True)
        for p in parts:
            fits = fits & F.contains(lower, F.lit(p))
        out = F.when(fits, F.lit(flops)).otherwise(out)
    return out


def hourly_cost(name: Column, count: Column) -> Column:
    rate = F.lit(HOURLY_OTHER)
    for part, dollars in reversed(HOURLY.items()):
        rate = F.when(F.contains(name, F.lit(part)), F.lit(dollars)).otherwise(rate)
    return rate * count
