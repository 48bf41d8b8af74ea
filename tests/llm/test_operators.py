"""Training-data operators against brute force, the libraries they follow, and edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from loamworks.llm import byte_bpe, components, dac, langid, line_quality, pseudonyms, queries, secrets, setsketch, shingles, spaced_seeds, toxicity, trie_counts

from ..oracle import differences

SF = "/root/testdata/sf0.001"
RANKS = public.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    None, "", "   ", "\n\n", "a", "one two three", "The cat sat on the mat. " * 30, "x" * 6000, "don't WE'LL 3.14 １２ ½", "漢字かな交じり 😀👍🏽 é É İx", "tab\tvert\x0bform\x0c nbsp  wide　",
    "<|endoftext|> <|ENDOFTEXT|>a <|startoftext|>", "$$$ %%% word###, a.&&& b!!", "\x00 zero \x7f", "The cat sat on the mat. " * 30,
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, a repeated and a null doc_id, clashing extra columns."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", 0, 1.0, "k", "b") for i, t in enumerate(TEXTS)]
    rows += [rows[6], (6, "another text of doc six with quite a few words in it", "fr", "s", 1, 2.0, "k", "b"), (None, "no id here but words", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, key string, label string")


def sha(b):
    return hashlib.sha256(b).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    assert not differences(queries.queries()[name](spark, SF), queries.oracle_sql()[name], SF)


def test_all_ten_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in __spark_entry__.queries() if re.match(r"op\d+_", k))
    assert numbers == list(range(1, 11)) and "pipeline" in __spark_entry__.queries()


def test_every_operator_takes_odd_and_empty_tables(spark, odd):
    benchmark = spark.createDataFrame([(1, "one two three"), (2, None), (3, ""), (4, "The cat sat on the mat. The cat sat on the mat.")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (99, 1, 1), (2, None, None), (4, 0, 0)], "doc_id long, quality int, toxic int")
    for docs in (odd, odd.limit(0)):
        n = docs.count()
        runs = [
            line_quality.judge(docs), secrets.spans(docs, secrets.fit(docs)), langid.identify(docs), toxicity.score(docs, toxicity.fit(docs, labels)), setsketch.groups(docs),
            byte_bpe.digest(docs, RANKS, public.PATTERN), trie_counts.count(docs, trie_counts.fit(docs, RANKS, public.PATTERN), public.PATTERN), dac.round_trip(spark, docs, public.path("word_bpe_49k.json")),
            pseudonyms.pseudonymised(docs, b"k"), spaced_seeds.judge(docs, benchmark),
        ]
        assert [r.count() for r in runs] == [n] * 10
        kept = setsketch.without_copies(docs)
        assert kept.columns == docs.columns
        assert spaced_seeds.without_leaks(docs, benchmark).columns == docs.columns
        assert toxicity.clean(docs, toxicity.fit(docs, labels)).columns == docs.columns
        assert secrets.redacted(docs, secrets.fit(docs)).columns == docs.columns
    found = {r.doc_id: r.first_item for r in spaced_seeds.judge(odd, benchmark).filter("not kept").collect()}
    assert found == {5: 1, 6: 4, 14: 4}
    assert spaced_seeds.judge(odd, benchmark.limit(0)).filter("not kept").count() == 0


def test_line_limits(spark):
    shared = "this line stands in every document"
    own = lambda i: f"only document {chr(97 + i)} has these nine words of its {chr(98 + i)}"
    rows = [(i, f"{shared}\n{own(i)}", "h") for i in range(12)] + [(20 + i, f"{shared}\n{shared.upper()} \n{own(i)[:12]}", "h") for i in range(3)] + [(30, f"{shared}\n{own(13)}", "other")]
    got = {r.doc_id: r for r in line_quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"), limit=10).collect()}
    assert all(got[i].kept and got[i].n_removed_words == 6 for i in range(12))
    assert not any(got[20 + i].kept for i in range(3)) and got[30].n_removed_words == 0
    texts = {r.doc_id: r.text for r in line_quality.cleaned(spark.createDataFrame(rows, "doc_id long, text string, source string"), limit=10).collect()}
    assert texts[0] == own(0) and texts[30].startswith(shared) and 20 not in texts


def test_lines_count_distinct_documents(spark):
    """Copies under many ids are many documents; a repeated row is one."""
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, source string")
    line = "a page that was copied as a whole many times over and over"
    assert line_quality.judge(frame([(i, line, "h") for i in range(40)])).filter("kept").count() == 0
    assert line_quality.judge(frame([(1, line, "h")] * 40)).filter("kept").count() == 40
    assert line_quality.judge(frame([(i, line, f"h{i % 4}") for i in range(40)])).filter("kept").count() == 40


def test_line_quality_of_odd_rows(spark, monkeypatch):
    """Nulls, empty and repeated rows have their stated values, whether frequent lines are broadcast or not."""
    line, other = "this one line is on every page of the whole host", "quite different words that only this page has at all"
    rows = [(i, f"{line}\n{other} {chr(97 + i) * 3}", None) for i in range(12)] + [(20, None, "s"), (21, "", "s"), (None, f"{line}\n\n{other} zzz", None), (22, "few words here", "s"), (3, f"{line}\n{other} ddd", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for limit in (1_000_000, 0):
        monkeypatch.setattr(line_quality, "BROADCAST_LINES", limit)
        got = Counter((x.doc_id, x.n_words, x.base_failed, x.kept, x.n_removed_words) for x in line_quality.judge(docs).collect())
        n = len(line.split()) + len(other.split()) + 1
        want = Counter({(i, n, False, True, 11): 1 for i in range(12)})
        want.update([(20, 0, True, False, 0), (21, 0, True, False, 0), (22, 3, True, False, 0), (None, n, False, True, 11), (3, n, False, True, 11)])
        assert got == want
        clean = Counter((x.doc_id, x.text) for x in line_quality.cleaned(docs).collect())
        assert clean == Counter([(i, f"{other} {chr(97 + i) * 3}") for i in range(12)] + [(None, f"\n{other} zzz")])


BASE = [("assign", r"""(?a:(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)))""", 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24)]


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(5)
    bits = ["token", "TOKEN: ", " = ", '"', "secret", "api_key=", "apikey", "abc", "abcdef01", "AKIA", "ABCDEFGH12345678", "0123456789abcdef01234567", "ſecret=abcdefgh", "passwd:x", " ", "\n", "é", "password='hunter2hunter2'"]
    for _ in range(2000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 9)))
        want = [(k, m.start(), m.end()) for k, p, g, least in BASE for m in re.finditer(p, text) if len(m[g]) >= least]
        want.sort(key=lambda s: (s[1], secrets.KINDS.index(s[0])))
        assert secrets.base_spans(text) == want


def random_field(seed, keys=frozenset()):
    rng = np.random.default_rng(seed)
    return secrets.Field(rng.normal(size=(2, 1 << secrets.BITS)).astype(np.float32), rng.normal(size=(3, 3)), keys)


def test_field_is_exact():
    """Viterbi and posteriors equal enumeration of all tag sequences."""
    field = random_field(0)
    features = np.random.default_rng(1).integers(0, 1 << secrets.BITS, (4, secrets.FEATURES))
    s = np.hstack((np.zeros((4, 1)), field.scores(features)))
    paths = list(itertools.product(range(3), repeat=4))
    value = [sum(s[i, t] for i, t in enumerate(p)) + sum(field.moves[a, b] for a, b in zip((0, *p), p)) for p in paths]
    assert tuple(field.viterbi(s[:, 1:])) == paths[int(np.argmax(value))]
    closed = [v + field.moves[p[-1], 0] for v, p in zip(value, paths)]
    assert tuple(field.viterbi(s[:, 1:], ends=False)) == paths[int(np.argmax(closed))]
    w = np.exp(np.array(value) - max(value))
    padded = np.concatenate((s, np.ones((2, 3))))[None]
    one, expected = secrets.posteriors(padded, field.moves, np.array([4]))
    assert np.allclose(one[0, :4], [[sum(x for x, p in zip(w, paths) if p[i] == t) / w.sum() for t in range(3)] for i in range(4)]) and not one[0, 4:].any()
    assert np.allclose(expected, [[sum(x * sum(y == (a, b) for y in zip((0, *p), p)) for x, p in zip(w, paths)) / w.sum() for b in range(3)] for a in range(3)])


def test_scans_equal_plain_viterbi_over_all_tokens():
    """Remembered sums and skipped stretches change nothing, under weights that favour outside a little, much, or not."""
    r = random.Random(6)
    bits = ["plain", " words", " and", " Xk9#mQ2z!vB7w", " user@host.example.com", "=", " ", "漢字", "\n", " 4111111111111111", "İx", " _", "ſ", "pwd", ": ", "deadBEEF99", "(quoted)", " aB", "\x00", " ½"]
    for seed in range(12):
        field = random_field(seed, frozenset({"plain", "words", "pwd"}))
        field.weights[:, secrets.number("all")] -= (0, 3, 8, 14)[seed % 4]
        scanner = secrets.Scanner(field)
        for _ in range(60):
            text = "".join(r.choice(bits) for _ in range(r.randint(0, 40)))
            tokens, tags = field.tags(text)
            places = [(m.end() - len(m[0].lstrip()), m.end()) for m in secrets.TOKEN.finditer(text)]
            if tokens:
                assert np.allclose(scanner.scores(text, tokens), field.scores(secrets.features_of(tokens, secrets.file_features(text), field.keys)), atol=1e-4)
            want = []
            for (a, b), tag in zip(places, tags):
                if tag == secrets.BEGIN:
                    want.append(("crf", a, b))
                elif tag == secrets.IN:
                    want[-1] = ("crf", want[-1][1], b)
            assert scanner.spans(text) == want


def test_field_finds_secrets_that_the_patterns_miss(spark):
    """A planted table: short, digitless and broken values behind words that no pattern knows, and harmless look-alikes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    r = random.Random(17)
    letters, some = "abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ", lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    value = [lambda: some(letters, 4) + some("23456789", 2) + some(letters, 3), lambda: some(letters, 14), lambda: some(letters, 4) + "#" + some(letters + "0123456789", 5) + "!" + some("0123456789", 3), lambda: some(letters + "0123456789", 32)]
    lead = ["pwd: ", "passphrase is ", "login = ", 'credential: "', "access code: ", "auth=", "signing key => "]
    rows, want, plain = [], {}, 0
    for row in docs.filter("text is not null").orderBy("doc_id").limit(600).collect():
        words = row.text.split(" ")
        at = r.randrange(len(words) + 1)
        before = "".join(x + " " for x in words[:at])
        if row.doc_id % 2:
            announced, v = r.choice(lead), r.choice(value)()
            want[row.doc_id] = (len(before) + len(announced), len(before) + len(announced) + len(v))
            rows.append((row.doc_id, before + announced + v + ('" ' if announced.endswith('"') else " ") + " ".join(words[at:])))
        else:
            plain += 1
            rows.append((row.doc_id, before + r.choice(["order 2023-11-0042", "call +1 (212) 555-0187", "see v2.10.3", "mail me.too@site.example.com", "10.2.33.4"]) + " " + " ".join(words[at:])))
    got = secrets.spans(spark.createDataFrame(rows, "doc_id long, text string"), secrets.fit(docs)).collect()
    found = {x.doc_id: [tuple(map(int, s.split(":")[1:])) for s in x.spans.split(",") if s.startswith("crf")] for x in got}
    assert sum(x.n_crf for x in got) == sum(map(len, found.values())) > 0
    right = sum(any(a < want[d][1] and want[d][0] < b for a, b in found[d]) for d in want)
    tagged = sum(map(len, found.values()))
    assert right >= 0.9 * len(want) and right >= 0.9 * tagged
    assert sum(bool(found[d]) for d in found if d not in want) <= 0.02 * plain
    # Base columns and hashes don't depend on the field.
    for x in got[:50]:
        base = secrets.base_spans(dict(rows)[x.doc_id])
        assert x.base_sha256 == sha(secrets.joined(base).encode()) and x.n_assign == sum(s[0] == "assign" for s in base)


def test_redaction():
    field = secrets.Field()
    scanner = secrets.Scanner(field)
    assert scanner.redact("token=abcdef0123 x") == "[SECRET] x" and scanner.redact("") == "" and scanner.redact("nothing here") == "nothing here"
    assert scanner.redact("a token=" + "0123456789abcdef" * 3 + " b AKIA" + "A" * 16) == "a [SECRET] b [SECRET]"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.97 * got.count()


def test_language_table_equals_the_plain_model():
    counts = []
    for lang, words in {"aa": "the cat sat on mats", "bb": "le chat est sur un tapis"}.items():
        c = Counter(words.split())
        counts += [("w", lang, w, n) for w, n in c.items()]
        for k in range(1, langid.LONGEST_GRAM + 1):
            g = Counter(x for w in c for x in langid.grams_of(w, k))
            counts += [(f"g{k}", lang, x, n) for x, n in g.items()]
    model = langid.Model.of_counts(counts)
    table = langid.ChunkTable(model)
    texts = ["the chat", "tapistry sat!", "zzz 123", "", "Cat-le x'y " + "q" * 200, "İSTANBUL", "ſat ǅ ﬁn the½cat", "thecat" * 3_000, "q" * 9_000, "½ Ⅷ x²y"]
    cut = [t.split() for t in texts]
    at, end = table.places(cut), np.cumsum([len(c) for c in cut])
    for t, c, e in zip(texts, cut, end):
        name, score = model.judge(table.rows[at[e - len(c) : e]].sum(axis=0))
        want = model.predict(t)
        assert name == want[0] and abs(score - want[1]) < 1e-12
    for none in ("123 !!", None, "", "½", "²", "①②", "Ⅷ", "\u0301", "_ _"):
        assert model.predict(none) == ("und", 0.0)
    import pickle

    again = pickle.loads(pickle.dumps(model))
    assert again.predict("the chat") == model.predict("the chat") and again.words.keys() == model.words.keys() and again.grams.keys() == model.grams.keys()


def test_letters_are_those_of_category_l():
    import unicodedata

    every = map(chr, range(0x110000))
    assert all(bool(langid.letters().fullmatch(c)) == (unicodedata.category(c)[0] == "L") for c in every)


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").filter("held_out").select("toxic", "predicted").toPandas()
    assert got.predicted[got.toxic == 0].mean() < 0.02 and got.predicted[got.toxic == 1].mean() > 0.65


def test_features_equal_plain_arithmetic():
    r, known, mask = random.Random(3), toxicity.Bounded(toxicity.word_hash), (1 << 64) - 1
    a, b = int(toxicity._BIGRAM), int(toxicity._SKIP)
    for _ in range(200):
        text = " ".join(r.choice(["One", "two,", "(three)", "...", "é", "four-five", "!", "\tsix"]) for _ in range(r.randint(0, 12)))
        h = [x for w in text.encode().lower().split() if (x := toxicity.word_hash(w))]
        raw = h + [(x * a + y) & mask for x, y in zip(h, h[1:])] + [(x * b + y * a) & mask for x, y in zip(h, h[2:])]
        assert toxicity.features(text.encode(), known).tolist() == sorted({((x ^ x >> 31) * a & mask) >> (64 - toxicity.BITS) for x in raw})


def test_ftrl_equals_a_plain_twin(spark):
    """The model and scores against per-coordinate FTRL-proximal written out, over features cut from words one by one."""
    r = random.Random(5)
    good, bad = [f"good{i}" for i in range(30)], [f"vile{i}" for i in range(8)]
    rows = []
    for i in range(120):
        words = r.choices(good, k=r.randint(3, 20))
        if i % 4 == 0:
            words[r.randrange(len(words))] = r.choice(bad)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"))
    known = toxicity.Bounded(toxicity.word_hash)
    learn = [(d, t, y) for d, t, y in rows if zlib.crc32(str(d).encode()) % 3 != 1]
    order = sorted(learn, key=lambda x: (toxicity.xxhash.xxh64_intdigest(str(x[0])), toxicity.features(x[1].encode(), known).tobytes()))
    sizes = [sum(y == k for _, _, y in learn) for k in (0, 1)]
    times = [max(1, round(max(sizes) / n)) for n in sizes]
    z, n = Counter(), Counter()

    def weight(i):
        l1 = 0.0 if i == 1 << toxicity.BITS else toxicity.L1  # the bias has no penalty
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * l1) / ((toxicity.BETA + np.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for again in range(max(times)):
            for _, t, y in order:
                if again >= times[y]:
                    continue
                at = [*toxicity.features(t.encode(), known).tolist(), 1 << toxicity.BITS]
                w = [weight(i) for i in at]
                g = 1 / (1 + np.exp(-np.clip(sum(w), -35, 35))) - y
                for i, x in zip(at, w):
                    sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / toxicity.ALPHA
                    z[i] += g - sigma * x
                    n[i] += g * g
    want = {i: weight(i) for i in z}
    got = dict(zip(model.at.tolist(), model.weight.tolist()))
    assert set(got) == {i for i, w in want.items() if w and i != 1 << toxicity.BITS}
    assert all(abs(got[i] - want[i]) < 1e-5 for i in got) and abs(model.bias - want[1 << toxicity.BITS]) < 1e-5
    for x in toxicity.score(docs, model).collect():
        text = rows[x.doc_id][1]
        logit = sum(want.get(i, 0.0) for i in toxicity.features(text.encode(), known).tolist()) + want[1 << toxicity.BITS]
        assert abs(x.score - 1 / (1 + np.exp(-logit))) < 1e-4 and x.predicted == int(x.score >= 0.7)


def slow_groups(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            label[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates_equal_brute_force(spark):
    """Chains, hubs, a large group of copies, near copies around the limit."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(60)]
    rows = []
    for g in range(6):
        base = [word() for _ in range(80)]
        for _ in range(12):
            w = list(base)
            for _ in range(r.randint(0, 6)):
                w[r.randrange(len(w))] = word()
            rows.append(" ".join(w))
    rows += [" ".join(passage + [word() for _ in range(r.randint(5, 60))]) for _ in range(40)]
    chain = [word() for _ in range(100)]
    for _ in range(15):
        rows.append(" ".join(chain))
        chain[r.randrange(100)] = word()
        chain = chain[3:] + [word() for _ in range(3)]
    rows += ["Same text here of six words"] * 200 + ["same TEXT here of six words", "a b", "A  b", "", "  ", "a"]
    r.shuffle(rows)
    given = list(enumerate(rows))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in setsketch.groups(spark.createDataFrame(given, "doc_id long, text string").repartition(7)).collect()}
    assert got == slow_groups(given)


def test_one_document_of_each_group_stays(spark):
    """Different texts of one doc_id both stay; copies, also under null ids, leave one; texts without words stay."""
    a, b, c = ("one two three four five six seven", "a wholly different text with other words in it", "and a third text that is no copy of them either")
    unique = spark.createDataFrame([(1, a), (2, a.upper()), (3, b), (4, None), (5, " ")], "doc_id long, text string")
    assert sorted(x.doc_id for x in setsketch.without_copies(unique).collect()) == [1, 3, 4, 5]
    rows = [(5, a, 1), (5, b, 2), (7, c, 3), (5, a, 4), (9, b, 5), (None, c, 6), (None, "only here without an id at all", 7), (None, None, 8), (8, "", 9), (8, "", 10)]
    got = setsketch.without_copies(spark.createDataFrame(rows, "doc_id long, text string, key int"))
    assert got.columns == ["doc_id", "text", "key"]
    left = Counter((x.doc_id, x.text) for x in got.collect())
    assert left == {(5, a): 1, (5, b): 1, (7, c): 1, (None, "only here without an id at all"): 1, (None, None): 1, (8, ""): 2}


def test_rest_pairs_go_through_the_likelihood(spark, monkeypatch):
    """Links that no star finds: two near groups whose bucket leads differ."""
    r = random.Random(41)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.randint(2, 5)):
            w[r.randrange(120)] = word()
        rows.append((i, " ".join(w)))
    seen = []
    likely = setsketch.likely
    monkeypatch.setattr(setsketch, "likely", lambda reps, pairs: seen.append(pairs) or likely(reps, pairs))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in setsketch.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == slow_groups(rows) and len(seen) == 2


@pytest.mark.parametrize("carried", [2_048, 100])
def test_a_family_below_the_limit_hands_on_links_alone(spark, monkeypatch, carried):
    """Pairs alike by a little less than 0.75 don't leave the join, unless sets are too large to be carried; results stay."""
    r = random.Random(43)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(150)]
    rows = []
    for i in range(150):
        w = list(base)
        for at in r.sample(range(150), r.randint(2, 3)):
            w[at] = word()
        rows.append((i, " ".join(w)))
    seen, rest = [], setsketch.rest_pairs
    monkeypatch.setattr(setsketch, "rest_pairs", lambda *given: seen.append(rest(*given)) or seen[-1])
    monkeypatch.setattr(setsketch, "CARRIED", carried)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in setsketch.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == slow_groups(rows)
    known = shingles.word_cache()
    sets = [set(shingles.shingle_set(t.encode(), known).tolist()) for _, t in rows]
    linked = [100 * len(sets[x.a] & sets[x.b]) >= 75 * len(sets[x.a] | sets[x.b]) for x in seen[0].collect()]
    assert len(linked) > 0 and all(linked) == (carried == 2_048)


def test_the_pipeline_stage_hands_on_links_alone(spark, monkeypatch):
    """As above through the pipeline's stage, which keeps one text of each group."""
    r = random.Random(43)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(150)]
    rows = []
    for i in range(150):
        w = list(base)
        for at in r.sample(range(150), r.randint(2, 3)):
            w[at] = word()
        rows.append((i, " ".join(w)))
    seen, rest = [], setsketch.rest_pairs
    monkeypatch.setattr(setsketch, "rest_pairs", lambda *given: seen.append(rest(*given)) or seen[-1])
    left = sorted(x.doc_id for x in corpus_pipeline.without_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect())
    assert left == [i for i, (_, least) in sorted(slow_groups(rows).items()) if i == least]
    known = shingles.word_cache()
    sets = [set(shingles.shingle_set(t.encode(), known).tolist()) for _, t in rows]
    assert all(100 * len(sets[x.a] & sets[x.b]) >= 75 * len(sets[x.a] | sets[x.b]) for x in seen[0].collect())


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    a, b = x[:600], x[300:]
    ra, rb = setsketch.registers(a), setsketch.registers(b)
    assert (setsketch.merge(ra, rb) == setsketch.registers(x)).all()
    more, less = np.array([[(ra[:256] > rb[:256]).sum()]]), np.array([[(ra[:256] < rb[:256]).sum()]])
    at = np.linspace(0.01, 0.99, 99)[None, :]
    assert abs(at[0, setsketch.log_likelihood(more, less, np.array([[0.5]]), at).argmax()] - 1 / 3) < 0.12


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.id: r.label for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


def test_byte_bpe_equals_the_library(spark, odd):
    enc = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    codec = byte_bpe.Codec(RANKS, public.PATTERN)
    r = random.Random(4)
    texts = [t or "" for t in TEXTS] + ["".join(r.choice("abcdeétion ing.\n9漢") for _ in range(r.randint(1, 400))) for _ in range(200)] + ["ab" * 5000]
    packed = codec.encode(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [enc.encode_ordinary(t) for t in texts]
    assert codec.decode(packed) == [t.encode() for t in texts]
    back = {(x.doc_id, x.text) for x in byte_bpe.decode(byte_bpe.encode(odd, RANKS, public.PATTERN), RANKS, public.PATTERN).collect()}
    assert back == {(x.doc_id, x.text or "") for x in odd.collect()}


def test_byte_bpe_contracts_words_that_come_again_once(monkeypatch):
    """Long words of every slice, among 400,000 that come once."""
    codec = byte_bpe.Codec(RANKS, public.PATTERN)
    asked = Counter()
    monkeypatch.setattr(codec, "contract", lambda words: asked.update(words) or [b"four"] * len(words))
    often = [f" zqlongerwordx{'qzj'[i % 3] * 3}{chr(97 + i)}" for i in range(20)]
    once = iter(range(400_000))
    for _ in range(40):
        codec.encode(["".join(often), "".join(" qzxk" + str(n).translate(str.maketrans("0123456789", "qzxjkvwbpf")) for n in itertools.islice(once, 10_000))])
    assert len(asked) > 390_000
    assert {asked[w.encode()] for w in often} == {1}


def test_byte_bpe_forgets_words_and_gives_the_same_ids(monkeypatch):
    """With a small cache ids are the library's, and what is kept is bounded, also by long words."""
    enc = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    monkeypatch.setattr(byte_bpe, "KEPT_BYTES", 40_000)
    codec = byte_bpe.Codec(RANKS, public.PATTERN)
    for k in range(30):
        texts = ["".join(f" again{chr(97 + i)}zq" for i in range(20)), "".join(f" qzx{chr(97 + k % 26)}{chr(97 + i)}wk{'j' * (k // 26)}" for i in range(26)) * 2, "", "漢" * (3_000 if k == 20 else 3 + k)]
        packed = codec.encode(texts)
        assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [enc.encode_ordinary(t) for t in texts]
        assert codec.decode(packed) == [t.encode() for t in texts]
        kept = [sum(byte_bpe.ENTRY_BYTES + x.__sizeof__() + y.__sizeof__() for x, y in words.items()) for words in (codec.known, codec.older)]
        assert sum(kept) <= 40_000 + (50_000 if k >= 20 else 10_000)
    assert sum(kept) <= 50_000


def test_byte_bpe_splits_by_re_where_it_can(monkeypatch):
    """``regex`` takes twice the time of ``re``, so the texts that it gets are counted."""
    import regex

    taken = []

    def compiled(pattern):
        found = regex.compile(pattern)
        return SimpleNamespace(findall=lambda text: taken.append(text) or found.findall(text))

    counted = SimpleNamespace(compile=compiled, finditer=regex.finditer)
    monkeypatch.setattr(byte_bpe, "regex", counted, raising=False)
    monkeypatch.setattr(trie_counts, "regex", counted)
    texts = ["The cats' theory isn't 3.14 théories; 漢字", "plain words", "", "a 😀 b"]
    codec = byte_bpe.Codec(RANKS, public.PATTERN)
    assert codec.decode(codec.encode(texts)) == [t.encode() for t in texts]
    assert taken == ["a 😀 b"]


def test_byte_bpe_decodes_across_queries(monkeypatch):
    """Sequences that begin, end or are empty at a query's edge; ids that no piece has."""
    codec = byte_bpe.Codec(RANKS, public.PATTERN)
    texts = ["", "", "one text of some words", "", "漢字かな交じり", "x", "", "a longer text, with nearly twenty tokens, or more", "", ""]
    packed = codec.encode(texts)
    for rows in (1, 2, 3, 5, 7, 1_000):
        monkeypatch.setattr(byte_bpe, "ROWS_A_DECODE", rows)
        for part in (packed, packed[2:], packed[3:4], packed[:1], []):
            assert codec.decode(part) == [texts[packed.index(p)].encode() for p in part]
        for bad in ([2**31 - 1], [2**31 - 1] * 9, [97, 2**31 - 1, 98], [2**32 - 1]):
            with pytest.raises(ValueError):
                codec.decode([packed[2], np.array(bad, "<u4").tobytes(), packed[4]])


def test_byte_bpe_of_long_words_equals_the_library(monkeypatch):
    """Unbroken words, many rounds, and pieces that start merges of lower rank, under the worker's memory limit."""
    core = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})._core_bpe
    codec = byte_bpe.Codec(RANKS, public.PATTERN)
    r = random.Random(8)
    some = lambda letters, n: "".join(r.choice(letters) for _ in range(n)).encode()
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [some(letters, 500) for _ in range(600)] + [some("acgt", 50_000), some("eationsr", 4_000), some("漢字かな", 3_000), b"ab" * 30_000, b"a" * 1_000_001, some(letters, 200_000)]
    equal = lambda words: all(np.frombuffer(x, "<u4").tolist() == core.encode_single_piece(w) for w, x in zip(words, codec.contract(words), strict=True))
    assert equal(words[:600]) and all(equal([w]) for w in words[600:])
    mixed = [some(r.choice(["ab", "aabtion", letters, "eé漢"]), r.randint(1, 900)) for _ in range(300)]
    for limit in (0, 40, 10_000):  # either query gives the same ids
        monkeypatch.setattr(byte_bpe, "LONG", limit)
        assert equal(mixed[:60] if limit > 900 else mixed)
    monkeypatch.setattr(byte_bpe, "ROWS_A_DECODE", 7)
    packed = codec.encode(["one text of some words", "", "漢字かな交じり"])
    assert codec.decode(packed) == ["one text of some words".encode(), b"", "漢字かな交じり".encode()]
    with pytest.raises(ValueError):
        codec.decode([np.array([2**31 - 1], "<u4").tobytes()])


def plain_segmentation(costs, word):
    """Least cost, then fewest pieces, over all pieces that end at each place; the pieces themselves."""
    longest, best = max(map(len, costs)), [(0, 0, 0)]
    for i in range(1, len(word) + 1):
        best.append(min((best[j][0] + costs[word[j:i]], best[j][1] + 1, -j) for j in range(max(0, i - longest), i) if word[j:i] in costs))
    out, i = [], len(word)
    while i:
        out, i = [word[-best[i][2] : i], *out], -best[i][2]
    return out


def test_trie_counts_equal_a_plain_segmentation():
    costs = trie_counts.first_costs(byte_bpe.read_ranks(RANKS))
    pieces = trie_counts.Pieces(costs)
    words = ["", " the", " theory", " theoretical", "ingly", "漢字", "zzzqx", "a" * 70, "x" * 400 + "theory" * 30]
    trie = trie_counts.Trie(pieces)
    for w in map(str.encode, words):
        want = plain_segmentation(costs, w)
        assert trie.insert(w) == pieces.long_count(w) == len(want) and pieces.segmented(w) == want
    assert len(trie.best) < sum(len(w.encode()) for w in words)  # prefixes are shared
    # A very long word keeps only a few positions, and its count joins those of its halves.
    word = "漢字かな交じりtheory".encode() * 20_000
    assert abs(pieces.long_count(word) - 20_000 * (pieces.long_count(word[:2_700]) / 100)) < 300


def test_token_counts_equal_a_plain_unigram(spark, odd):
    """Fit and query columns against recounting without trie, sample hash or Spark."""
    import regex

    docs = odd.union(odd.sparkSession.createDataFrame([(50 + i, f"the cats theory number {i} and theoretical cats", None, None, 0, 0.0, None, None) for i in range(30)], odd.schema))
    split = regex.compile(public.PATTERN)
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    seen = Counter(w.encode() for _, t in rows if t for w in split.findall(t))
    seen = {w: n for w, n in seen.items() if len(w) <= trie_counts.LONG}
    costs = trie_counts.first_costs(byte_bpe.read_ranks(RANKS))
    for _ in range(trie_counts.ROUNDS):
        again = Counter(dict.fromkeys(costs, 1))
        for w, n in seen.items():
            again.update({p: n * k for p, k in Counter(plain_segmentation(costs, w)).items()})
        costs = trie_counts.costs_of(again)
    got = trie_counts.fit(docs, RANKS, public.PATTERN)
    assert got == costs
    want = Counter((d, len(split.findall(t or "")), sum(len(plain_segmentation(costs, w.encode())) for w in split.findall(t or "")), len((t or "").encode())) for d, t in rows)
    assert Counter(tuple(x) for x in trie_counts.count(docs, got, public.PATTERN).collect()) == want


def test_token_costs_come_from_all_documents(spark):
    """Words of every one of 3,000 documents are counted, whatever their ids are."""
    rows = [(i, f"theory {i} of cats and w{i % 7}ords") for i in range(3_000)]
    split = re.compile(r"\S+")
    seen = Counter(w.encode() for _, t in rows for w in split.findall(t))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {bytes(x.word): x.n for x in trie_counts.tallied(docs, r"\S+").collect()} == seen
    costs = trie_counts.first_costs(byte_bpe.read_ranks(RANKS))
    for _ in range(trie_counts.ROUNDS):
        again = Counter(dict.fromkeys(costs, 1))
        for w, n in seen.items():
            again.update({p: n * k for p, k in Counter(plain_segmentation(costs, w)).items()})
        costs = trie_counts.costs_of(again)
    assert trie_counts.fit(docs, RANKS, r"\S+") == costs


def test_pre_tokens_equal_those_of_regex():
    import regex

    assert trie_counts.GPT2 == public.PATTERN
    split, want = trie_counts.splitter(public.PATTERN), regex.compile(public.PATTERN).findall
    around = [f"a{c}b 1{c} {c}.{c}{c} '{c}s\n{c}" for c in map(chr, range(0x10000)) if not "\ud800" <= c <= "\udfff"]
    rng = random.Random(7)
    mixed = ["".join(rng.choices([" ", "  ", "\n", "\x1c", "\x85", "\u2003", "'", "'ll", "'S", "é", "漢", "½", "word", "7", "_", ".", "😀", "𝐀", "\x00"], k=30)) for _ in range(3_000)]
    for texts in (around, mixed, [t for t in TEXTS if t]):
        assert all(split(t) == want(t) for t in texts)
    assert trie_counts.splitter(r"\S+")("a  b\n") == ["a", "b"]


def test_only_texts_beyond_the_bmp_go_through_regex(monkeypatch):
    """``regex`` takes twice the time of ``re``, so characters that it gets are counted."""
    import regex

    taken = []

    def compiled(pattern):
        found = regex.compile(pattern)
        return SimpleNamespace(findall=lambda text: taken.append(text) or found.findall(text))

    monkeypatch.setattr(trie_counts, "regex", SimpleNamespace(compile=compiled, finditer=regex.finditer))
    texts = ["The cats' theory isn't 3.14 théories; 漢字", "plain words", "", "a 😀 b"]
    costs = trie_counts.first_costs(byte_bpe.read_ranks(RANKS))
    got = trie_counts.Counter(costs, public.PATTERN).counts(texts)
    want = [regex.findall(public.PATTERN, t) for t in texts]
    assert got == [(len(ws), sum(len(plain_segmentation(costs, w.encode())) for w in ws)) for ws in want]
    assert taken == ["a 😀 b"]


def test_token_files(spark, odd, tmp_path):
    path = public.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "") for r in odd.collect()))
    want, start = [], 0
    for has, doc, _, text in rows:
        ids = t.encode(text, add_special_tokens=False).ids + [1]
        want.append((doc if has else None, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    out = str(tmp_path / "dac")
    got = sorted((tuple(r) for r in dac.round_trip(spark, odd.repartition(5), path, out).collect()), key=lambda r: r[1])
    assert got == want
    data = spark.read.parquet(out).orderBy("segment").first().data
    segment = dac.Segment(data)
    assert [segment[i] for i in range(segment.n_ids)] == segment.ids().tolist()
    ids = t.encode(TEXTS[5], add_special_tokens=False).ids + [1]
    assert [dac.token(spark, out, 5, k) for k in range(-1, len(ids) + 1)] == [None, *ids, None] and dac.token(spark, out, 12_345, 0) is None


def test_codes_of_any_size():
    r = np.random.default_rng(1)
    for ids in ([], [0], [255, 256, 65535, 65536, 2**32 - 1], r.integers(0, 2**32, 3000).tolist(), r.integers(0, 300, 3000).tolist()):
        s = dac.Segment(dac.pack(np.array(ids, dtype=np.uint32), np.array([len(ids)])))
        assert s.ids().tolist() == ids and [s[i] for i in range(len(ids))] == ids


def test_feistel_is_a_permutation():
    f = pseudonyms.Feistel(b"key")
    for n in (1, 2, 10, 97, 1000):
        image = [f.permute(x, n, "t") for x in range(n)]
        assert sorted(image) == list(range(n)) and [f.permute(y, n, "t", back=True) for y in image] == list(range(n))


def test_pseudonyms_keep_their_form():
    p, q = pseudonyms.Pseudonyms(b"k"), pseudonyms.Pseudonyms(b"k", back=True)
    text = "card 4111 1111 1111 1111, 4111-1111-1111-1111; not 4111111111111112. ssn 123-45-6789 no 000-12-3456 call +1 (415) 555-2671 at 192.168.0.1 not 999.1.1.1 on 2021-03-04, 31/12/1999, 2021-02-30 iban DE89 3704 0044 0532 0130 00 mail Ann.Lee7@mail.example.com"
    new, n = p.replace(text)
    assert n == {"card": 2, "iban": 1, "ssn": 1, "phone": 1, "ip": 1, "date": 2, "email": 1}
    cards = re.findall(r"card (\d{4} \d{4} \d{4} \d{4}), (\d{4}-\d{4}-\d{4}-\d{4})", new)[0]
    assert cards[0].replace(" ", "") == cards[1].replace("-", "") and pseudonyms.luhn_digit(cards[1].replace("-", "")[:-1]) == cards[1][-1]
    assert "4111111111111112" in new and "000-12-3456" in new and "999.1.1.1" in new and "2021-02-30" in new
    assert not re.search(r"123-45-6789|Ann\.Lee7|555-2671|192\.168", new) and new.endswith("@mail.example.com")
    assert q.replace(new)[0] == text
    assert pseudonyms.Pseudonyms(b"other").replace(text)[0] != new


def test_pseudonyms_equal_brute_force_without_prefilter():
    """Addresses of single digits, and cards next to other digits, are replaced; all comes back."""
    p, q = pseudonyms.Pseudonyms(b"k"), pseudonyms.Pseudonyms(b"k", back=True)
    new, n = p.replace("server 8.8.8.8 seen")
    assert n["ip"] == 1 and new.split()[1] == p.replace("in 2021 8.8.8.8")[0].split()[2] != "8.8.8.8"
    card = "4111 1111 1111 1111"
    want = p.card(card)
    for text in ("{} 12/27", "{} 123", "{} 1", "{}-123", "12 {}", "1234 {}", "AB12 {}", "{} 415 555 2671"):
        given = text.format(card)
        new, n = p.replace(given)
        assert n["card"] == 1 and want in new and q.replace(new)[0] == given
    r = random.Random(3)
    for _ in range(300):
        digits = "".join(r.choice("0123456789") for _ in range(15))
        number = digits + pseudonyms.luhn_digit(digits)
        form = " ".join(number[i : i + 4] for i in range(0, 16, 4))
        given = f"pay {form} {r.randrange(10 ** r.randint(1, 3))}, or {r.randrange(10)}.{r.randrange(10)}.1.2"
        new, n = p.replace(given)
        # Brute force: the longest stretch of the digits from the first on that passes the check.
        found = re.search(r"[0-9 ]+", given.removeprefix("pay "))[0]
        ends = [k for k in (len(found), len(form)) if pseudonyms.Pseudonyms(b"k").card(found[:k])]
        assert new.startswith("pay " + p.card(found[: ends[0]])) and n["card"] == 1 and n["ip"] == 1 and q.replace(new)[0] == given


def test_dates_and_phones_come_back_in_their_form():
    """All days of many years in ten forms, and phone numbers, also invalid ones."""
    p, q = pseudonyms.Pseudonyms(b"k"), pseudonyms.Pseudonyms(b"k", back=True)
    r = random.Random(12)
    forms = ["{d}/{m}/{y}", "{m}/{d}/{y}", "{d:02}/{m:02}/{y}", "{m:02}/{d:02}/{y}", "{y}-{m:02}-{d:02}", "{y}-{m}-{d}", "{d}.{m}.{y}", "{d:02}.{m}.{y}", "{d}/{m:02}/{y}", "{y}/{m:02}/{d}"]
    given = {f.format(y=r.randint(1895, 2104), m=r.randint(1, 13), d=r.randint(1, 31)) for f in forms for _ in range(700)}
    changed = {x: p.date(x) for x in given}
    done = {x: y for x, y in changed.items() if y}
    assert len(done) > 5_000 and len(set(done.values())) == len(done)
    for x, y in done.items():
        assert q.date(y) == x and pseudonyms.read_date(x)[1] == pseudonyms.read_date(y)[1]
        assert re.sub("[0-9]+", "", x) == re.sub("[0-9]+", "", y)
    import datetime

    for x in given - set(done):
        a, b, c = map(int, re.split("[./-]", x))
        for y, m, d in ((a, b, c),) if a > 31 else ((c, b, a), (c, a, b)):
            try:
                assert not 1900 <= datetime.date(y, m, d).year <= 2099
                break
            except ValueError:
                continue
    ok = lambda c: c[0] in "23456789" and c[1:] != "11"
    for _ in range(3_000):
        area, exchange = (f"{r.randrange(1000):03d}" for _ in range(2))
        x = r.choice(["({}) {}-{:04d}", "+1 ({}) {}-{:04d}", "{}-{}-{:04d}", "{}.{}.{:04d}"]).format(area, exchange, r.randrange(10_000))
        y = p.phone(x)
        assert (y is not None) == (area != "000" and ok(exchange))
        if y:
            digits = re.sub("[^0-9]", "", y)[-10:]
            assert q.phone(y) == x and ok(digits[3:6]) and ok(digits[:3]) == ok(area) and re.sub("[0-9]", "", x) == re.sub("[0-9]", "", y)
    assert p.phone("(000) 000-0000") is None


def test_detection_equals_plain_patterns(spark):
    """A twin without the joint pattern: at each place the kinds are tried in turn, each with its own pattern."""
    p, twin = pseudonyms.Pseudonyms(b"k"), pseudonyms.Pseudonyms(b"k")

    def plain(text):
        out, at, found = "", 0, 0
        while at < len(text):
            for kind, pattern in pseudonyms.PATTERNS.items():
                m = re.compile(pattern, re.ASCII).match(text, at)
                if not m:
                    continue
                a, b, new = *m.span(), getattr(twin, kind)(m[0])
                if new is None and kind == "card":
                    for x, y in pseudonyms.shorter_cards(m[0]):
                        if new := twin.card(m[0][x:y]):
                            a, b = m.start() + x, m.start() + y
                            break
                if new is not None:
                    out, at, found = out + text[at:a] + new, b, found + 1
                elif kind == "email":
                    out, at = out + text[at : m.end()], m.end()
                else:
                    out, at = out + text[at], at + 1
                break
            else:
                out, at = out + text[at], at + 1
        return out, found

    r = random.Random(31)
    bits = ["1.2.3.4", "host ", " up", "8.8.8.8", "2021-03-04", "31/12/1999", "4111 1111 1111 1111", "+1 (415) 555-2671", "123-45-6789", "a.b7@c.de", "DE89 3704 0044 0532 0130 00", " ", " ", "12", "-", ".", "x", "999.1.1.1", "2021-02-30", "é", "@", "(017) 555-7713"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 8))) for _ in range(3_000)]
    for t in texts:
        new, n = p.replace(t)
        assert (new, sum(n.values())) == plain(t)
    for t in ("host 1.2.3.4 up", "host 1.2.3.4 up since 10 h", "1.2.3.4"):
        assert "1.2.3.4" not in p.replace(t)[0]
    rows = [(i, t) for i, t in enumerate(texts[:40])] + [(None, "on 2021-03-04"), (3, None), (4, "")]
    got = pseudonyms.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), b"k").collect()
    assert Counter((x.doc_id, x.text, x.n_values) for x in got) == Counter((d, None, 0) if t is None else (d, *plain(t)) for d, t in rows)


def test_spaced_seeds_tolerate_substitutions(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(5))
    items = [[word() for _ in range(n)] for n in (9, 16, 30, 60)]
    docs, want = [], set()
    for k, item in enumerate(items):
        for change in (0, len(item) // 8):
            w = list(item)
            for at in r.sample(range(len(w)), change):
                w[at] = word()
            docs.append(" ".join([word() for _ in range(20)] + w + [word() for _ in range(20)]))
            if change == 0 or len(item) >= 16:
                want.add((len(docs) - 1, k))
    docs += [" ".join(word() for _ in range(200)) for _ in range(5)]
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {(x.doc_id, x.item_id) for x in spaced_seeds.leaks(rows, benchmark).collect()}
    assert want <= got and all(d < 8 for d, _ in got)


def test_masks_hit_every_pattern_of_agreement():
    spans = [[k for k, bit in enumerate(m) if bit == "1"] for m in spaced_seeds.MASKS]
    for n in range(spaced_seeds.LEAST, spaced_seeds.REACH + 1):
        least = -(-spaced_seeds.AGREE_PERCENT * n // 100)
        for off in itertools.combinations(range(n), n - least):
            assert any(not any(i + k in off for k in at) for at in spans for i in range(n - at[-1]))


def test_leaks_equal_the_plain_rule_without_seeds(spark, monkeypatch):
    """Every fourth word replaced, random substitutions around the limit, cut passages, short items inside documents."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(5))
    items = [[word() for _ in range(n)] for n in (1, 3, 8, 9, 10, 15, 18, 20, 20, 35)]
    docs = []
    for item in items:
        for k in range(4):
            docs.append([word() for _ in range(r.randint(0, 30))] + [word() if i % 4 == k and len(item) > 8 else w for i, w in enumerate(item)] + [word() for _ in range(r.randint(0, 30))])
        for _ in range(12):
            off = set(r.sample(range(len(item)), len(item) // 4 + r.randint(0, 1)))
            docs.append([word() for _ in range(r.randint(0, 9))] + [word() if i in off else w for i, w in enumerate(item)] + [word() for _ in range(r.randint(0, 9))])
        docs += [item[len(item) // 5 :], item[: len(item) - len(item) // 4] + [word()]]

    def plain(doc, item):
        n, reach = len(item), min(len(item), spaced_seeds.REACH)
        least = n if n < spaced_seeds.LEAST else -(-spaced_seeds.AGREE_PERCENT * reach // 100)
        return any(sum(0 <= i + d < len(doc) and doc[i + d] == item[i] for i in range(s, s + reach)) >= least for s in range(n - reach + 1) for d in range(-n, len(doc)))

    want = {(d, i) for d, doc in enumerate(docs) for i, item in enumerate(items) if plain(doc, item)}
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    rows = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(docs)], "doc_id long, text string")
    assert {(x.doc_id, x.item_id) for x in spaced_seeds.leaks(rows, benchmark).collect()} == want
    monkeypatch.setattr(spaced_seeds, "BROADCAST_SEEDS", 0)
    assert {(x.doc_id, x.item_id) for x in spaced_seeds.leaks(rows, benchmark).collect()} == want


def test_a_very_long_item(spark, monkeypatch):
    """Each broadcast row has only the words near its seed."""
    words = [f"w{i % 4001}x{i // 7}" for i in range(10_000)]
    benchmark = spark.createDataFrame([(1, " ".join(words)), (2, "what is the capital of france answer paris")], "item_id long, text string")
    rows = [(1, "before it " + " ".join(words[5_000:5_020]) + " after"), (2, " ".join(words[:14])), (3, " ".join(words[-20:])), (4, "well what is the capital of france answer paris then"), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (200_000, 0):
        monkeypatch.setattr(spaced_seeds, "BROADCAST_SEEDS", limit)
        assert {(x.doc_id, x.item_id) for x in spaced_seeds.leaks(docs, benchmark).collect()} == {(1, 1), (3, 1), (4, 2)}
    items = spaced_seeds.exploded(benchmark.select("item_id", spaced_seeds.word_hashes(F.col("text")).alias("words"), spaced_seeds.word_hashes(F.col("text")).alias("item")), "item_id", "item").withColumnRenamed("at", "item_at")
    assert spaced_seeds._near_items(items, "seed").agg(F.max(F.size("x"))).first()[0] <= spaced_seeds.NEAR


def test_large_benchmark_by_shuffle(spark, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = {tuple(r) for r in spaced_seeds.leaks(docs, benchmark).collect()}
    monkeypatch.setattr(spaced_seeds, "BROADCAST_SEEDS", 0)
    assert {tuple(r) for r in spaced_seeds.leaks(docs, benchmark).collect()} == want and want


def test_shingles_of_short_and_repeated_words():
    known = shingles.word_cache()
    n = lambda t: len(shingles.shingle_set(t.encode(), known))
    assert [n(""), n(" "), n("a"), n("a b c d"), n("a b c d e"), n("a a a a a a a")] == [0, 0, 1, 1, 1, 1]
    assert (shingles.shingle_set(b"A B c d E", known) == shingles.shingle_set(b"a\tb\nc  d e", known)).all()
    assert shingles.shingle_set(b"a b", known) != shingles.shingle_set(b"b a", known)


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = corpus_pipeline.landed(out, f"test-{name}")
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] > 0
    assert docs.filter(F.col("text").rlike(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}")).count() == 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    both = out.join(docs.select("doc_id", F.sha2("text", 256).alias("want")), "doc_id")
    assert both.count() == docs.count() and both.filter("decoded_sha256 <> want or n_tokens <> length(ids) / 4").count() == 0


def test_pipeline_run_equals_its_stages(spark):
    """All of ``run``, and nothing but its last table is left behind."""
    import corpus_pipeline
    from loamworks import storage

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.landed(stage(spark, docs, SF), f"again-{name}")
    enc = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    want = {}
    for x in docs.collect():
        ids = np.array(enc.encode_ordinary(x.text or ""), "<u4").tobytes()
        want[x.doc_id] = (len(ids) // 4, sha(ids), sha((x.text or "").encode()))
    before = storage.written()
    got = {x.doc_id: (x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and storage.written() == before + 1
