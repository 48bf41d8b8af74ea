"""Operator 2: secret scans, fixed patterns and a linear-chain conditional random field.

The patterns (assign, access, hex) give base spans.  The field tags every token
of a text as secret begin, inside or outside, from its shape, its neighbours,
the last word before it and features of the whole file, decoded by Viterbi over
the whole text.  A token is a run of letters and digits or one other character,
with the white space before it, if any.

Decoding is exact but skips what can't be tagged: a stretch of tags other than
outside can only be part of the best path if its tokens' scores and the most
that transitions can add sum to more than nothing; tokens that no such stretch
covers are outside, and the others are decoded stretch by stretch.

The field is trained by stochastic gradients on windows of ``WINDOW`` tokens
from at most about ``TRAIN_DOCS`` documents, at most ``WINDOWS_A_DOC`` from each
and each half.  Labels go beyond the patterns: base spans count as secrets with
their key word taken out, and secrets of other forms are planted, made from a
hash of the text, beside harmless numbers and addresses.  Scans read all tokens
of whole texts.

Defined results: a null or empty text has no spans; field spans that overlap
base spans are left out; repeated rows give repeated results; other columns are
ignored; on an empty table the field is fitted to nothing and adds none.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import map_text, slices, tidy
from .folds import SPAN

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE = 6
KINDS = ("assign", "access", "hex", "crf")

TOKEN = re.compile(r"\s?(?:[^\W_]+|[^\w\s]|_)")
#: Tokens back to which the last word before a token counts, and the letters of a word.
NEAR, WORD = 4, 3
#: Entries of a worker's tables before they are emptied.
KNOWN = 200_000

TRAIN_DOCS = 1_000
WINDOW, WINDOWS_A_DOC, PLAIN_SHARE = 24, 8, 8
#: Windows in which a word must announce a secret to count.
KEY_TIMES = 3
BITS = 16
EPOCHS, BATCH = 8, 64
RATE, L2 = 0.3, 1e-4
OUT, BEGIN, IN = 0, 1, 2
NEVER = -1e9

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then kind as listed."""
    out = []
    lower = text.lower()
    if any(k in lower for k in ("passw", "secret", "token", "key")):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def number(feature: str) -> int:
    """The place of a feature's weights; 0 is that of no feature."""
    return max(1, xxhash.xxh32_intdigest(feature) >> (32 - BITS))


def form(token: str) -> tuple[bool, str, int, bool]:
    """What decides a token's features unless it is mixed: glued to the one before, kinds of characters, length, mixed."""
    core = token.lstrip()
    glued = len(core) == len(token)
    if core.isalpha():
        if core.islower() or core[1:].islower() or len(core) == 1:
            return glued, "a" if core[0].islower() else "Aa", min(len(core), 16), False
        if not (core.isupper() or any(map(str.isupper, core))):
            return glued, "o", min(len(core), 16), False  # letters without case
    elif core.isdecimal():
        return glued, "9", min(len(core), 24), False
    return glued, "", 0, True


def own_features(token: str) -> list[int]:
    """Features of a token by itself: always ``OWN``."""
    glued, kinds, size, mixed = form(token)
    if not mixed:
        return [number(f"{glued}{x}") for x in (f"k={kinds}", f"l={size}", f"kl={kinds}{size}")] + [0] * (OWN - 3)
    core = token.lstrip()
    n = len(core)
    if n == 1 and not core.isalnum():
        return [number(f"{glued}c={core}"), number(f"c={core}")] + [0] * (OWN - 2)
    shape = [("A", sum(map(str.isupper, core))), ("a", sum(map(str.islower, core))), ("9", sum(map(str.isdigit, core)))]
    kinds = "".join(k for k, c in shape if c)
    count = Counter(core)
    entropy = int(2 * -sum(c / n * math.log2(c / n) for c in count.values()))
    classes = ["9" if c.isdigit() else "A" if c.isupper() else "a" for c in core]
    turns = min(6, sum(x != y for x, y in zip(classes, classes[1:], strict=False)) * 8 // n)
    size = min(12, n // 2)
    return [number(f"{glued}{x}") for x in (f"m={kinds}", f"s={size}", f"ms={kinds}{size}", f"e={kinds}{entropy}", f"t={kinds}{turns}", f"h={all(c in '0123456789abcdefABCDEF' for c in core)}{size}", f"d={shape[2][1] * 4 // n}{kinds}")]


OWN = 7


def side_feature(token: str) -> str:
    """What a token is for its neighbours."""
    glued, kinds, size, mixed = form(token)
    core = token.lstrip()
    return f"{glued}{core}" if len(core) == 1 and not core.isalnum() else f"{glued}m{min(6, len(core) // 4)}" if mixed else f"{glued}{kinds}{size // 4}"


SIDES = (-2, -1, 1, 2)
#: The numbers of a token's features: its own, of each side, of the last word, of the file, and one of all tokens.
FEATURES = OWN + len(SIDES) + 1 + 3 + 1


def file_features(text: str) -> list[int]:
    """Features of the whole file: how many symbols, digits and lines it has."""
    n = max(1, len(text))
    share = lambda k: min(6, int(math.log2(1 + 1000 * k / n)))
    symbols = sum(map(text.count, "=:{};\"'#$%&*<>"))
    return [number(x) for x in (f"fs={share(symbols)}", f"fl={share(text.count(chr(10)))}", f"fq={share(text.count('@') + text.count('/'))}")]


def word_of(token: str) -> str | None:
    core = token.lstrip()
    return core.lower() if len(core) >= WORD and core.isalpha() else None


def last_words(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the last word before each token, and how far it is; -1 and 0 where it is too far."""
    at = np.arange(len(is_word))
    last = np.maximum.accumulate(np.where(is_word, at, -1))
    before = np.append(-1, last[:-1])
    gap = at - before
    near = (before >= 0) & (gap <= NEAR)
    return np.where(near, before, -1), np.where(near, gap, 0)


def features_of(tokens: list[str], file: list[int], keys: set[str] | None) -> np.ndarray:
    """The plain form: a row of ``FEATURES`` numbers a token; words out of ``keys`` give no feature."""
    words = [word_of(t) for t in tokens]
    before, gap = last_words(np.array([w is not None for w in words], dtype=bool)) if tokens else (np.zeros(0, int),) * 2
    sides = [side_feature(t) for t in tokens]
    out = []
    for i, t in enumerate(tokens):
        near = [number(f"{k}{sides[i + k]}") if 0 <= i + k < len(tokens) else number(f"{k}edge") for k in SIDES]
        word = words[before[i]] if before[i] >= 0 else None
        out.append([*own_features(t), *near, number(f"w{gap[i]}={word}") if word is not None and (keys is None or word in keys) else 0, *file, number("all")])
    return np.array(out, dtype=np.int32).reshape(len(tokens), FEATURES)


class Field:
    """Weights of BEGIN and IN by feature against OUT, of tag after tag (a text starts as after OUT), and the words that count."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None, keys: frozenset[str] = frozenset()) -> None:
        self.weights = np.zeros((2, 1 << BITS), dtype=np.float32) if weights is None else weights
        self.moves = np.zeros((3, 3)) if moves is None else moves
        self.keys = keys
        self.weights[:, 0] = 0
        self.moves[OUT, IN] = NEVER

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Of BEGIN and IN for each token."""
        return self.weights[:, features].sum(axis=2, dtype=np.float64).T

    def viterbi(self, scores: np.ndarray, ends: bool = True) -> list[int]:
        """The best tags after an outside token; ties go to the lower tag.  Unless the text ends here, an outside token follows."""
        moves = self.moves.tolist()
        best, back = None, []
        for begin, inside in scores.tolist():
            if best is None:
                best = [x + y for x, y in zip(moves[OUT], (0.0, begin, inside), strict=True)]
                continue
            now, came = [], []
            for tag, own in ((OUT, 0.0), (BEGIN, begin), (IN, inside)):
                x, y, z = best[0] + moves[0][tag], best[1] + moves[1][tag], best[2] + moves[2][tag]
                k = 0 if x >= y and x >= z else 1 if y >= z else 2
                came.append(k)
                now.append((x, y, z)[k] + own)
            best = now
            back.append(came)
        if best is None:
            return []
        if not ends:
            best = [x + m[OUT] for x, m in zip(best, moves, strict=True)]
        tags = [best.index(max(best))]
        for came in reversed(back):
            tags.append(came[tags[-1]])
        return tags[::-1]

    def tags(self, text: str) -> tuple[list[str], list[int]]:
        """The plain form: all tokens of a text, and their tags."""
        tokens = TOKEN.findall(text)
        return tokens, self.viterbi(self.scores(features_of(tokens, file_features(text), self.keys)))


def posteriors(scores: np.ndarray, moves: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of windows ``(window, token, tag)``: probabilities of the tags, and expected numbers of each tag after each."""
    many, width, _ = scores.shape
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + moves[OUT]
    for i in range(1, width):
        ahead[:, i] = np.logaddexp.reduce(ahead[:, i - 1, :, None] + moves, axis=1) + scores[:, i]
    for i in range(width - 2, -1, -1):
        step = np.logaddexp.reduce(moves + (scores[:, i + 1] + behind[:, i + 1])[:, None, :], axis=2)
        behind[:, i] = np.where((sizes > i + 1)[:, None], step, 0)
    real = np.arange(width)[None, :] < sizes[:, None]
    total = np.logaddexp.reduce(ahead[:, 0] + behind[:, 0], axis=1)[:, None, None]
    one = np.exp(ahead + behind - total) * real[:, :, None]
    pairs = np.exp(ahead[:, :-1, :, None] + moves + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - total[..., None]) * real[:, 1:, None, None]
    expected = pairs.sum(axis=(0, 1))
    expected[OUT] += one[:, 0].sum(axis=0)
    return one, expected


def train(features: np.ndarray, tags: np.ndarray, sizes: np.ndarray, keys: frozenset[str] = frozenset()) -> Field:
    """By AdaGrad on the log likelihood of windows ``(window, token, feature)``, in the order given."""
    field = Field(keys=keys)
    w, moves = field.weights, field.moves
    g2, m2 = np.full(w.shape, 1e-6, dtype=np.float32), np.full((3, 3), 1e-6)
    free = moves > NEVER / 2
    for _ in range(EPOCHS):
        for at in range(0, len(features), BATCH):
            f, t, n = features[at : at + BATCH], tags[at : at + BATCH], sizes[at : at + BATCH]
            scores = np.concatenate((np.zeros((*t.shape, 1)), np.moveaxis(w[:, f].sum(axis=3, dtype=np.float64), 0, 2)), axis=2)
            one, expected = posteriors(scores, moves, n)
            real = np.arange(t.shape[1])[None, :] < n[:, None]
            before = np.hstack((np.zeros((len(t), 1), dtype=t.dtype), t[:, :-1]))
            np.subtract.at(expected, (before[real], t[real]), 1)
            for k in (BEGIN, IN):
                off = (one[:, :, k] - (t == k)) * real
                g = np.bincount(f.ravel(), np.repeat(off.ravel(), FEATURES), 1 << BITS).astype(np.float32)
                hit = np.flatnonzero(g)
                g = g[hit] + L2 * w[k - 1, hit]
                g2[k - 1, hit] += g * g
                w[k - 1, hit] -= RATE * g / np.sqrt(g2[k - 1, hit])
            w[:, 0] = 0
            m2 += expected * expected
            moves -= np.where(free, RATE * expected / np.sqrt(m2), 0)
    return field


# Forms of planted secrets: words that announce one, what stands between, and kinds of values.
ANNOUNCING = ("pwd", "pass", "passphrase", "passcode", "credential", "credentials", "auth", "login", "pin", "key", "signing key", "access code", "private key", "bearer", "authorization", "psk", "salt", "cookie")
BETWEEN = (": ", "=", " = ", " is ", " => ", ":", ": \"", "=\"", " = '", " ")
LETTERS, ALNUM = string.ascii_letters, string.ascii_letters + string.digits
LEET = str.maketrans("aeiostAEIOST", "431057431057")


def planted_value(r: random.Random) -> str:
    """A secret of one of several kinds."""
    some = lambda chars, low, high: "".join(r.choice(chars) for _ in range(r.randint(low, high)))
    kind = r.randrange(8)
    if kind == 0:
        return (some(string.ascii_lowercase, 6, 12).capitalize() + r.choice(["", "!", "1", "99"])).translate(LEET)
    if kind == 1:
        return some(ALNUM + "!@#$%^&*", 8, 20)
    if kind == 2:
        return some(ALNUM + "+/", 20, 60) + r.choice(["", "=", "=="])
    if kind == 3:
        return some(LETTERS, 8, 24)
    if kind == 4:
        return "-".join(some("0123456789abcdef", n, n) for n in (8, 4, 4, 4, 12))
    if kind == 5:
        return r.choice(["ghp_", "sk-", "xoxb-", "pk_live_", "glpat-"]) + some(ALNUM, 16, 40)
    if kind == 6:
        return ".".join(some(ALNUM + "_-", a, b) for a, b in ((12, 30), (20, 50), (20, 40)))
    return some("0123456789ABCDEF", 24, 48)


def planted(r: random.Random) -> tuple[str, int, int]:
    """A stretch of text and where the secret in it starts and ends."""
    value = planted_value(r)
    kind = r.randrange(5)
    if kind == 0:
        lead, tail = r.choice(["postgres", "mysql", "https", "amqp", "redis"]) + "://" + r.choice(["admin", "root", "app", "svc"]) + ":", "@" + r.choice(["db", "host", "mq"]) + r.choice([".internal", ".example.com:5432/main", "/x"])
        value = re.sub(r"[^A-Za-z0-9]", "x", value)
    elif kind == 1:
        lead, tail = "", ""
        value = r.choice(["ghp_", "sk-", "xoxb-", "pk_live_"]) + "".join(r.choice(ALNUM) for _ in range(r.randint(20, 40)))
    else:
        word = r.choice(ANNOUNCING)
        lead = (word.upper() if r.random() < 0.2 else word.capitalize() if r.random() < 0.2 else word) + r.choice(BETWEEN)
        tail = lead[-1] if lead[-1] in "\"'" else r.choice(["", "", ".", ",", ";"])
    return lead + value + tail, len(lead), len(lead) + len(value)


def harmless(r: random.Random) -> str:
    """Text that looks like a secret and is none."""
    some = lambda chars, low, high: "".join(r.choice(chars) for _ in range(r.randint(low, high)))
    word = some(string.ascii_lowercase, 3, 9)
    digits = lambda n: some(string.digits, n, n)
    return r.choice([
        f"{word}.{word[:2]}{digits(2)}@{word}.example.com", f"{digits(4)}-{digits(2)}-{digits(2)}", f"v{digits(1)}.{digits(2)}.{digits(1)}", f"{digits(3)}.{digits(2)}.{digits(1)}.{digits(2)}", f"https://{word}.example.org/{word}/{digits(4)}?id={digits(6)}",
        f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", digits(16), f"{digits(3)}-{digits(2)}-{digits(4)}", f"{word}_{digits(2)}.csv", f"{word.upper()}-{digits(4)}", f"#{some('0123456789abcdef', 6, 6)}", f"{word}() == {word}[{digits(1)}]", f"{digits(1)},{digits(3)},{digits(3)}", f"{word}!!", f"$$${word}###",
    ])


def labelled(text: str, plant: bool) -> tuple[str, list[tuple[int, int]]]:
    """A text for training and its secrets' places: base spans without their key words, and planted ones."""
    r = random.Random(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")))
    words = re.findall(r"[^\W\d_]{3,}", text[:10_000]) or ["word"]
    parts: list[tuple[str, int, int]] = []
    at = 0
    for m in re.finditer(r"\S+", text):
        if plant and r.random() < 0.02:
            parts.append((text[at : m.start()], 0, 0))
            at = m.start()
            parts.append(planted(r) if r.random() < 0.5 else (harmless(r), 0, 0))
            parts.append((" ", 0, 0))
    parts.append((text[at:], 0, 0))
    out, marks, size = [], [], 0
    for part, a, b in parts:
        if a == b:
            # What stands before a value is taken out in one of two, so that it counts without its key word.
            done = 0
            for kind, m in sorted([("assign", m) for m in ASSIGN.finditer(part) if m.end(2) - m.start(2) >= ASSIGN_VALUE] + [("other", m) for p in (ACCESS, HEX) for m in p.finditer(part)], key=lambda x: x[1].start(2 if x[0] == "assign" else 0)):
                start, end = m.span(2 if kind == "assign" else 0)
                if start < done:
                    continue
                lead = part[done:start]
                if kind == "assign" and r.random() < 0.5 and m.start() >= done:
                    lead = part[done : m.start()] + r.choice(words) + part[m.end(1) : start]
                marks.append((size + len(lead), size + len(lead) + end - start))
                out += [lead, part[start:end]]
                size += len(lead) + end - start
                done = end
            out.append(part[done:])
            size += len(part) - done
        else:
            marks.append((size + a, size + b))
            out.append(part)
            size += len(part)
    return "".join(out), marks


def windows(text: str, plant: bool) -> list[tuple[np.ndarray, list[int], list[str]]]:
    """Features, tags and words that announce a secret, of windows with a secret or a mixed token and a share of the others."""
    text, marks = labelled(text, plant)
    found = list(TOKEN.finditer(text))
    tokens = [m[0] for m in found]
    tags, k = [OUT] * len(tokens), 0
    for i, m in enumerate(found):
        while k < len(marks) and marks[k][1] <= m.start():
            k += 1
        if k < len(marks) and m.end() > marks[k][0]:
            tags[i] = IN if i and tags[i - 1] and found[i - 1].end() > marks[k][0] else BEGIN
    kept = []
    for at in range(0, len(tokens), WINDOW):
        own = tokens[at : at + WINDOW]
        secret = any(tags[at : at + WINDOW])
        place = xxhash.xxh64_intdigest("".join(own).encode("utf-8", "surrogatepass"))
        if secret or any(form(t)[3] and len(t.lstrip()) > 1 for t in own) or place % PLAIN_SHARE == 0:
            kept.append((not secret, place, at))
    kept.sort()
    # At most WINDOWS_A_DOC with a secret and as many without.
    kept = [x for x in kept if not x[0]][:WINDOWS_A_DOC] + [x for x in kept if x[0]][:WINDOWS_A_DOC]
    file, out = file_features(text), []
    for _, _, at in kept:
        # The window with all that its features look at; a text's edge stays one.
        low = max(0, at - NEAR - 2)
        near = tokens[low : at + WINDOW + 2]
        own = slice(at - low, at - low + WINDOW)
        words = [word_of(t) for t in near]
        before, _ = last_words(np.array([w is not None for w in words], dtype=bool))
        marked = tags[at : at + WINDOW]
        out.append((features_of(near, file, None)[own], marked, sorted({words[before[own][i]] for i, tag in enumerate(marked) if tag == BEGIN and before[own][i] >= 0})))
    return out


def fit(docs: DataFrame) -> Field:
    """Train on windows of a bounded sample, chosen by a hash of doc_id; every document is read as it is and with secrets planted."""
    some = docs.filter(F.col("text").cast("string").rlike(r"\S")).select("doc_id", F.col("text").cast("string").alias("text"))
    n = some.count()
    place = F.pmod(F.xxhash64(F.lit("secrets"), F.col("doc_id").cast("string")), F.lit(SPAN))
    sample = some.filter(place < min(SPAN, SPAN * TRAIN_DOCS // max(1, n)))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [(str(d), k, f.tobytes(), bytes(tags), words) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for plant in (False, True) for k, (f, tags, words) in enumerate(windows(t or "", plant))]
            names, at, features, tags, words = zip(*found, strict=True) if found else ((),) * 5
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(at, pa.int32()), pa.array(features, pa.binary()), pa.array(tags, pa.binary()), pa.array(words, pa.list_(pa.string()))], ["doc_id", "at", "features", "tags", "words"])

        return work

    return fitted(map_text(sample, make, "doc_id string, at int, features binary, tags binary, words array<string>").toArrow().to_pylist())


def fitted(rows: list[dict]) -> Field:
    """From rows ``doc_id, at, features, tags, words``, in an order of their own."""
    rows.sort(key=lambda r: (xxhash.xxh64_intdigest(f"{r['doc_id']}/{r['at']}"), r["features"]))
    keys = frozenset(w for w, n in Counter(w for r in rows for w in r["words"]).items() if n >= KEY_TIMES)
    sizes = np.array([len(r["tags"]) for r in rows], dtype=np.int64)
    features, tags = np.zeros((len(rows), WINDOW, FEATURES), dtype=np.int32), np.zeros((len(rows), WINDOW), dtype=np.int64)
    for i, r in enumerate(rows):
        features[i, : sizes[i]] = np.frombuffer(r["features"], dtype=np.int32).reshape(-1, FEATURES)
        tags[i, : sizes[i]] = np.frombuffer(r["tags"], dtype=np.uint8)
    at = OWN + len(SIDES)
    known = np.array(sorted({number(f"w{gap}={w}") for w in keys for gap in range(1, NEAR + 1)}), dtype=np.int32)
    features[:, :, at] = np.where(np.isin(features[:, :, at], known), features[:, :, at], 0)
    return train(features, tags, sizes, keys)


class Scanner:
    """Scores of a field's tokens, remembered by one worker, and exact decoding of whole texts."""

    def __init__(self, field: Field) -> None:
        self.field = field
        moves = field.moves
        # A stretch starts with BEGIN after OUT; each later token is reached from a tag other than OUT.
        self.gain = moves[1:, 1:].max(axis=0) - moves[OUT, OUT]
        start = float(moves[OUT, BEGIN] - moves[1:, BEGIN].max())
        self.once = start + max(0.0, float((moves[1:, OUT] - moves[OUT, OUT]).max()))
        w = field.weights
        self.all = w[:, number("all")].astype(np.float64)
        self.edge = {k: w[:, number(f"{k}edge")].astype(np.float64) for k in SIDES}
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.forms: dict[tuple, int] = {}
        self.fresh: list[np.ndarray] = []
        self.table = np.zeros((0, 1 + len(SIDES) + NEAR, 2))
        self.word = np.zeros(0, dtype=bool)

    def learn(self, token: str) -> int:
        """The row of a new token: tokens of one form that are no key words share it."""
        core = token.lstrip()
        if core.isalpha() and core.lower() not in self.field.keys and (core[1:].islower() or core.islower()):
            # The most common case of what follows.
            key = (len(core) == len(token), core[0].islower(), min(len(core), 16), len(core) >= WORD)
        else:
            shape, word = form(token), word_of(token)
            key = token if shape[3] or word in self.field.keys else (shape, word is not None)
        if key in self.forms:
            return self.forms[key]
        word = word_of(token)
        w, side = self.field.weights, side_feature(token)
        row = [w[:, own_features(token)].sum(axis=1, dtype=np.float64), *(w[:, number(f"{k}{side}")] for k in SIDES), *(w[:, number(f"w{gap}={word}")] if word in self.field.keys else np.zeros(2) for gap in range(1, NEAR + 1))]
        self.fresh.append((np.array(row), word is not None))
        self.forms[key] = len(self.table) + len(self.fresh) - 1
        return self.forms[key]

    def places(self, tokens: list[str]) -> np.ndarray:
        """The row of each token."""
        if len(self.rows) > KNOWN or len(self.forms) > KNOWN:
            self.clear()
        found = list(map(self.rows.get, tokens))
        if None in found:
            for i, row in enumerate(found):
                if row is None:
                    token = tokens[i]
                    row = self.rows.get(token)
                    found[i] = self.rows[token] = self.learn(token) if row is None else row
            if self.fresh:
                self.table = np.concatenate((self.table, np.array([x for x, _ in self.fresh])))
                self.word = np.append(self.word, [x for _, x in self.fresh])
                self.fresh = []
        return np.array(found, dtype=np.int64)

    def scores(self, text: str, tokens: list[str]) -> np.ndarray:
        """The same sums as ``Field.scores(features_of(...))``."""
        at = self.places(tokens)
        out = self.table[at, 0] + (self.field.weights[:, file_features(text)].sum(axis=1, dtype=np.float64) + self.all)
        for j, k in enumerate(SIDES, 1):
            if k < 0:
                out[-k:] += self.table[at[:k], j]
                out[:-k] += self.edge[k]
            else:
                out[:-k] += self.table[at[k:], j]
                out[max(0, len(out) - k) :] += self.edge[k]
        before, gap = last_words(self.word[at])
        near = np.flatnonzero(gap)
        out[near] += self.table[at[before[near]], len(SIDES) + gap[near]]
        return out

    def stretches(self, scores: np.ndarray) -> list[tuple[int, int]]:
        """Where a best path may leave outside: tokens inside some stretch whose bound is above nothing."""
        most = (scores + self.gain).max(axis=1)
        total = np.cumsum(most)
        before = np.append(0.0, total[:-1])
        up = total - np.minimum.accumulate(before)
        down = np.maximum.accumulate(total[::-1])[::-1] - before
        may = np.flatnonzero(up + down - most + self.once > -1e-6)
        if not len(may):
            return []
        cuts = np.flatnonzero(np.diff(may) > 1)
        return list(zip(may[np.append(0, cuts + 1)].tolist(), (may[np.append(cuts, len(may) - 1)] + 1).tolist(), strict=True))

    def spans(self, text: str) -> list[Span]:
        tokens = TOKEN.findall(text)
        if not tokens:
            return []
        scores = self.scores(text, tokens)
        found = []
        for a, b in self.stretches(scores):
            tags = self.field.viterbi(scores[a:b], b == len(tokens))
            found += [(a + i, tag) for i, tag in enumerate(tags) if tag]
        if not found:
            return []
        out: list[Span] = []
        places = [(m.end() - len(m[0].lstrip()), m.end()) for m in TOKEN.finditer(text)]
        for i, tag in found:
            if tag == BEGIN:
                out.append(("crf", *places[i]))
            else:
                out[-1] = ("crf", out[-1][1], places[i][1])
        return out

    def scan(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans."""
        base = base_spans(text)
        more = [s for s in self.spans(text) if not any(s[1] < b and a < s[2] for _, a, b in base)]
        return base, in_order(base + more)

    def redact(self, text: str, mark: str = "[SECRET]") -> str:
        """The text with each stretch of overlapping spans replaced by ``mark``."""
        out, at, end = [], 0, -1
        for _, a, b in self.scan(text)[1]:
            if a >= end:
                if end >= 0:
                    at = end
                out += [text[at:a], mark]
                at = end = b
            else:
                end = at = max(end, b)
        return "".join(out) + text[at:]


def _light(field: Field) -> tuple:
    """Only the weights that were touched, for broadcasting."""
    at = np.flatnonzero(np.abs(field.weights).sum(axis=0) > 0)
    return at, field.weights[:, at], field.moves, field.keys


def _scanner(light: tuple) -> Scanner:
    weights = np.zeros((2, 1 << BITS), dtype=np.float32)
    weights[:, light[0]] = light[1]
    return Scanner(Field(weights, light[2].copy(), light[3]))


def spans(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(_light(field))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        own = _scanner(shared.value)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [own.scan(t or "") for t in batch.column("text").to_pylist()]
            count = lambda kind: pa.array([sum(s[0] == kind for s in every) for _, every in found], pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(count, KINDS[:3]), pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string()), pa.array([joined(every) for _, every in found], pa.string()), count("crf")],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"],
            )

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_text(docs, make, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_crf bigint")


def redacted(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced and ``n_chars``, where there is one, brought up to date; a null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(_light(field))
    place = docs.columns.index("text")

    def run(batches):
        own = _scanner(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [None if t is None else own.redact(t) for t in part.column("text").to_pylist()]
                yield part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))

    out = docs.mapInArrow(tidy(run), docs.schema)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.length("text").cast(kind))
