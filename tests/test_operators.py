"""Golden rows and brute-force versions of operators that SQL can't express."""

import math
import random
from collections import Counter

import pytest
import tiktoken
from pyspark.sql import functions as F

from loamworks.functions import conversation as V
from loamworks.functions import sandbox
from loamworks.functions import text as T
from loamworks.operators import bpe, corpus, metrics, ordering, packing, synthesis, tasks
from loamworks.sources import bibliography, books, chats, downloads, results


def slow_pack(rows, capacity, buffer_size, refill, crop, pad):
    """The packing rule by linear scans."""
    rows, waiting, out = iter(rows), [], []
    open_ = True
    while True:
        row = []
        while len(row) < capacity:
            while open_ and len(waiting) < buffer_size:
                for _ in range(refill):
                    r = next(rows, None)
                    if r is None:
                        open_ = False
                        break
                    waiting.append(r if crop else r[:capacity])
            if not waiting:
                break
            room = capacity - len(row)
            fits = [i for i, r in enumerate(waiting) if len(r) <= room]
            if fits:
                best = max(len(waiting[i]) for i in fits)
                row += waiting.pop(next(i for i in fits if len(waiting[i]) == best))
            elif crop:
                least = min(map(len, waiting))
                row += waiting.pop(next(i for i, r in enumerate(waiting) if len(r) == least))[:room]
            else:
                break
        if not row or (crop and len(row) < capacity):
            return out
        out.append(row + [pad] * (capacity - len(row)))


def test_packing_equals_linear_scan():
    r = random.Random(7)
    for trial in range(60):
        rows = [[trial] * r.randint(1, 30) for _ in range(r.randint(0, 80))]
        for crop in (True, False):
            got = [ids for ids, *_ in packing.pack(((x, [1] * len(x), i) for i, x in enumerate(rows)), 20, 12, 5, crop, 0)]
            assert got == slow_pack(rows, 20, 12, 5, crop, 0)


def test_packed_targets_are_masked(spark):
    df = spark.createDataFrame([(0, 1, [9, 1, 2], [0, 0, 1]), (0, 2, [9, 3], [0, 1])], "rank long, doc_id long, ids array<int>, mask array<int>")
    row = packing.packed(df, 6, crop=False, pad=9).first()
    assert row.inputs == [9, 1, 2, 9, 3, 9] and row.targets == [-1, 2, -1, 3, -1, -1] and row.content == 5 and row.names == [1, 2]


def test_packed_rows_equal_each_ranks_own(spark):
    r = random.Random(5)
    docs = [(k % 3, k // 2, [r.randint(0, 99) for _ in range(n)], [r.randint(0, 1) for _ in range(n)]) for k, n in enumerate(r.randint(0, 40) for _ in range(150))]
    docs = [(rank, 2 * name + (k % 2), ids, mask) for k, (rank, name, ids, mask) in enumerate(docs)]
    df = spark.createDataFrame(docs, "rank int, doc_id long, ids array<int>, mask array<int>").repartition(5)
    for crop in (True, False):
        got = {(x.rank, x.row): tuple(x)[2:] for x in packing.packed(df, 20, crop=crop, pad=7, buffer_size=9, refill=4).collect()}
        plain = {(x.rank, x.row): tuple(x)[2:] for x in packing.packed(df.drop("mask"), 20, crop=crop, pad=7, buffer_size=9, refill=4).collect()}
        want, unmasked = {}, {}
        for rank in range(3):
            own = ((d[2], d[3], d[1]) for d in docs if d[0] == rank)
            for n, (ids, mask, content, names, sizes) in enumerate(packing.pack(own, 21, 9, 4, crop, 7)):
                ends = [i + 1 < content for i in range(20)]
                want[rank, n] = (ids[:-1], [t if m and e else -1 for t, m, e in zip(ids[1:], mask[1:], ends)], content, names, sizes)
                unmasked[rank, n] = (ids[:-1], [t if e else -1 for t, e in zip(ids[1:], ends)], content, names, sizes)
        assert got == want and plain == unmasked


def _task_of_a_rank(rows):
    """What the task that packs a rank reads, down to the table."""
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("MapInArrow") :].splitlines()[1:]
    return " ".join(below[: next(i for i, line in enumerate(below) if "Relation" in line)])


def test_the_task_of_a_rank_reads_lengths_only(spark):
    df = spark.range(40).select("id", (F.col("id") % 2).alias("rank"), F.col("id").alias("doc_id"), F.array_repeat(F.lit(1), 300).alias("ids"))
    read = _task_of_a_rank(packing.packed(df, 20))
    assert "rank#" in read and "size#" in read and "ids#" not in read


def test_whole_texts_go_to_python_in_small_batches(spark):
    from loamworks.plans import tokens

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for of in (tokens._byte_docs, tokens._sample):
        spark.conf.set(name, "10000")
        of(spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get(name)) <= 1_000


def test_names_and_sizes_of_packed_rows_need_no_ids(spark):
    df = spark.range(40).select("id", (F.col("id") % 2).alias("rank"), F.col("id").alias("doc_id"), F.array_repeat(F.lit(1), 300).alias("ids"))
    rows = packing.packed(df, 20, crop=False).select(F.explode(F.arrays_zip("names", "sizes")).alias("x"))
    assert not [x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "ids#" in x and "Relation" not in x]
    assert sorted(tuple(r.x) for r in rows.collect()) == [(i, 21) for i in range(40)]


def test_totals_of_packed_rows_need_no_ids(spark):
    df = spark.range(40).select("id", (F.col("id") % 2).alias("rank"), F.col("id").alias("doc_id"), F.array_repeat(F.lit(1), 300).alias("ids"))
    rows = packing.packed(df, 20, crop=False).groupBy("rank").agg(F.sum("content").alias("n"))
    assert not [x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "ids#" in x and "Relation" not in x]
    assert sorted(map(tuple, rows.collect())) == [(0, 420), (1, 420)]


def test_a_smaller_vocabulary_is_the_larger_ones_start(spark):
    df = spark.createDataFrame([(f"{i * i} word{i}", 1 + i % 5) for i in range(80)], "word string, n long")
    assert bpe.merges_by_rounds(df, 12)[:5] == bpe.merges_by_rounds(df, 5)


def test_training_by_rounds_leaves_no_tables(spark, monkeypatch):
    monkeypatch.setattr(bpe, "DRIVER_BYTES", 0)
    before = bpe.written()
    ranks = bpe.train(spark.createDataFrame([(1, "a banana and a bandana")], "doc_id long, text string"), 262, ["<|bos|>"])
    assert len(ranks) == 261 and bpe.written() == before


def test_merges_equal_recounting():
    words = {b"low": 5, b"lower": 2, b"newest": 6, b"widest": 3, b"aaaa": 4}
    parts = {w: [bytes([b]) for b in w] for w in words}
    want = []
    for _ in range(12):
        count = {}
        for w, n in words.items():
            for p in zip(parts[w], parts[w][1:]):
                count[p] = count.get(p, 0) + n
        if not count:
            break
        best = min(count, key=lambda p: (-count[p], p))
        want.append(best)
        for w, x in parts.items():
            new, i = [], 0
            while i < len(x):
                two = tuple(x[i : i + 2]) == best
                new.append(x[i] + x[i + 1] if two else x[i])
                i += 2 if two else 1
            parts[w] = new
    assert bpe.learn_merges(words, 12) == want


def test_merges_by_rounds_equal_the_drivers(spark, monkeypatch):
    r = random.Random(11)
    words = Counter("".join(r.choice("aaabbcdé漢 ") for _ in range(r.randint(1, 14))) for _ in range(400))
    want = bpe.learn_merges({w.encode(): n for w, n in words.items()}, 25)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    for pairs, rounds, chunk, dense in ((4096, 8, 1 << 18, 2048), (7, 2, 64, 0)):
        for name, value in {"MOST_PAIRS": pairs, "ROUNDS": rounds, "CHUNK": chunk, "DENSE": dense}.items():
            monkeypatch.setattr(bpe, name, value)
        assert bpe.merges_by_rounds(df, 25) == want
    few = spark.createDataFrame([("aaaaa", 3), ("ab", 3), ("x", 9)], "word string, n long")
    assert bpe.merges_by_rounds(few, 9) == bpe.learn_merges({b"aaaaa": 3, b"ab": 3, b"x": 9}, 9)


def test_certain_merges_stop_at_what_they_change(monkeypatch):
    pairs = [(b"a", b"b", 9), (b"c", b"d", 8), (b"a", b"e", 7), (b"b", b"f", 7), (b"g", b"h", 6)]
    assert bpe.certain(pairs, 9, []) == [(b"a", b"b"), (b"c", b"d")]
    assert bpe.certain(pairs, 1, []) == [(b"a", b"b")]
    assert bpe.certain(pairs, 9, [b"ab"]) == [(b"a", b"b")]
    assert bpe.certain([(b"a", b"a", 9), (b"c", b"d", 8)], 9, []) == [(b"a", b"a")]
    monkeypatch.setattr(bpe, "MOST_PAIRS", 2)
    assert bpe.certain(pairs[:2], 9, []) == [(b"a", b"b")]


def test_driver_merges_few_words_only(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"word{i} wörter {i * i}") for i in range(300)], "doc_id long, text string")
    want = bpe.train(df, 300)
    monkeypatch.setattr(bpe, "DRIVER_BYTES", 100)
    monkeypatch.setattr(bpe, "learn_merges", lambda *_: pytest.fail("all words came to the driver"))
    assert list(bpe.train(df, 300).items()) == list(want.items())


def test_encode_is_lossless(spark):
    texts = ["Hello world! 123, 4567, 89", "don't you'll  spaces\n\n\nlines ", "漢字 😀 naïve", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ranks = bpe.train(df, 300)
    coded = bpe.encoded(df, ranks, prepend=None)
    back = {r.doc_id: r.text for r in bpe.decoded(coded, bpe.vocabulary(spark, ranks, ["<|bos|>"])).collect()}
    assert [back[i] or "" for i in range(5)] == [t or "" for t in texts]
    plain = tiktoken.Encoding("t", pat_str=bpe.SPLIT, mergeable_ranks=ranks, special_tokens={})
    assert [r.ids for r in coded.orderBy("doc_id").collect()] == [plain.encode_ordinary(t or "") for t in texts]


def slow_round_robin(streams, weights):
    done, out = {k: 0 for k in streams}, []
    while any(done[k] < len(v) for k, v in streams.items()):
        live = [k for k in weights if k in streams and done[k] < len(streams[k])]
        k = min(live, key=lambda k: done[k] / max(weights[k], 1e-9))
        out.append(streams[k][done[k]])
        done[k] += 1
    return out


def test_round_robin_equals_loop(spark):
    r = random.Random(3)
    for _ in range(3):
        streams = {k: [ord(k) * 100 + i for i in range(r.randint(0, 12))] for k in "abc"}
        weights = {"b": 0.5, "a": r.choice([0.5, 0.1]), "c": r.choice([0.0, 0.3])}
        rows = [(k, i) for k, v in streams.items() for i in v]
        got = corpus.round_robin(spark.createDataFrame(rows, "source string, doc_id long"), weights).orderBy("pos").collect() if rows else []
        assert [x.doc_id for x in got] == slow_round_robin(streams, weights)
        assert [x.pos for x in got] == list(range(len(got)))


def test_numbering_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_A_RANGE", 37)
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), (F.col("id") % 3).alias("g"))
    assert ordering.numbered(df, "n", "k").filter("n <> k").count() == 0
    by = ordering.numbered(df, "n", "k", by=["g"]).groupBy("g").agg(F.count("*").alias("c"), F.max("n").alias("m"), F.countDistinct("n").alias("d")).collect()
    assert all(x.c == x.m + 1 == x.d for x in by)
    total = ordering.running_sum(df, "s", "k", "k")
    assert total.filter("s <> k * (k + 1) div 2").count() == 0


def test_shards_on_disk(spark, tmp_path):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.repeat(F.lit("x"), 100).alias("text"))
    out = str(tmp_path / "shards")
    corpus.build_corpus({"a": df}, {"a": 1.0}, out, target_tokens=10**9, limit=150_000)
    corpus.build_corpus({"a": df}, {"a": 1.0}, out, target_tokens=75_000, limit=150_000)
    sizes = {r.shard: r.n for r in spark.read.parquet(out).groupBy("shard").agg(F.count("*").alias("n")).collect()}
    # 1024 documents of 100 characters a block: two blocks a shard; the second run stops at 300,000.
    assert sizes == {0: 2048, 1: 2048, 2: 904, 3: 2048, 4: 2048}
    assert corpus.next_shard(spark, out) == 5


def test_clean_ocr_boundaries(spark):
    body = " ".join(f"word{i}" for i in range(300))
    cases = {
        "kept": body, "short": body[:999], "few": "x" * 1200 + " y", "repeats": "same " * 400,
        "ligature": "ﬁ ﬂ ſ " + body, "garbled": body + "\n" + "1234 5678 9012 34567" + "\n" + "12345 67890 12345 6789", "null": None,
    }
    got = {r.k: r.t for r in spark.createDataFrame(list(cases.items()), "k string, t string").select("k", T.clean_ocr(F.col("t")).alias("t")).collect()}
    assert got["kept"] == body and got["ligature"].startswith("fi fl s ")
    assert got["garbled"] == body + "\n1234 5678 9012 34567"
    assert [k for k, v in got.items() if v is None] == ["short", "few", "repeats", "null"]


def test_xml_file(spark, tmp_path):
    import gzip

    doc = '<PubmedArticleSet><PubmedArticle><PubDate><Year>1970</Year></PubDate><ArticleTitle>q <i>it</i> r</ArticleTitle><AbstractText Label="AIM">one</AbstractText></PubmedArticle>\n<PubmedArticle><PubDate><MedlineDate>1969 Spring</MedlineDate></PubDate><ArticleTitle>t</ArticleTitle></PubmedArticle></PubmedArticleSet>'
    with gzip.open(tmp_path / "a.xml.gz", "wt") as f:
        f.write(doc)
    got = sorted(tuple(r) for r in bibliography.read(spark, str(tmp_path)).collect())
    assert got == [(1969, "t", ""), (1970, "q it r", "AIM: one")]


def test_chats_round_trip(spark, tmp_path):
    assert chats.read(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "c.jsonl").write_text('[{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]\n\nbad\n')
    rows = chats.read(spark, str(tmp_path / "c.jsonl")).collect()
    assert sorted(r.valid for r in rows) == [False, True]


def test_book_probe_variants(spark):
    raw = spark.createDataFrame([("1905", None, '{"year": "[1800?]"}', "t"), (None, None, '{"year": "[1800?]"}', "t"), (None, None, "{bad", "t"), ("1930", "x", None, "t")], "year string, ocr string, metadata string, text string")
    got = books.stream("scans", raw, cleaned=False).select("year").collect()
    assert sorted(r.year for r in got) == [1800, 1905]
    assert books.or_empty(spark, lambda: spark.read.parquet("/nowhere"), "text string").count() == 0


def test_append_new_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    assert results.append_new(df, str(tmp_path / "t"), ["k"]) == 2
    assert results.append_new(df, str(tmp_path / "t"), ["k"]) == 0


def test_sandbox():
    assert not sandbox.execute("import time; time.sleep(9)", seconds=1, enabled=True).success
    assert sandbox.grade_code("", "def f(x):\n    return x + 1", "def check(f):\n    assert f(1) == 2", "f", enabled=True)
    try:
        sandbox.execute("1")
    except PermissionError:
        pass
    else:
        raise AssertionError("code ran without being enabled")


def test_tool_conversation_segments(spark):
    rows = spark.createDataFrame([(1, [("user", "q", None), ("assistant", None, [("text", "a"), ("python", "1+1"), ("python_output", "2")])])], f"id int, messages {V.MESSAGES}")
    got = rows.select(V.segments(F.col("messages")).alias("s"), V.valid_tool_use(F.col("messages")).alias("ok")).first()
    assert got.ok
    assert [(p.text, p.mask) for p in got.s] == [
        ("<|bos|>", 0), ("<|user_start|>", 0), ("q", 0), ("<|user_end|>", 0), ("<|assistant_start|>", 0), ("a", 1), ("<|python_start|>", 1), ("1+1", 1), ("<|python_end|>", 1),
        ("<|output_start|>", 0), ("2", 0), ("<|output_end|>", 0), ("<|assistant_end|>", 1),
    ]


def test_generation_errors_are_outcomes(spark):
    def model(p):
        if p == "bad":
            raise ValueError("no")
        return p.upper()

    got = {r.prompt: (r.reply, r.error) for r in synthesis.generated(spark.createDataFrame([("a",), ("bad",)], "prompt string"), model).collect()}
    assert got == {"a": ("A", None), "bad": (None, "gen err: no")}


def test_common_suffix(spark):
    df = spark.createDataFrame([("g", [1, 2, 3]), ("g", [9, 2, 3])], "g string, x array<int>")
    assert metrics.common_length(df, "g", "x").first().n == 0
    assert metrics.common_length(df, "g", "x", suffix=True).first().n == 2


def test_vocabulary_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a banana and a bandana")], "doc_id long, text string")
    ranks = bpe.train(df, 270, ["<|bos|>"])
    bpe.save(bpe.vocabulary(spark, ranks, ["<|bos|>"]), str(tmp_path / "v"))
    assert bpe.load(spark, str(tmp_path / "v")) == (ranks, ["<|bos|>"])
    assert bpe.start_token(["<|bos|>"], len(ranks)) == len(ranks)


def test_downloads(tmp_path):
    calls, waits = [], []

    def fetch(name):
        calls.append(name)
        if len(calls) < 3:
            raise OSError("no")
        return b"data"

    assert downloads.download("x", fetch, str(tmp_path), wait=waits.append) and waits == [2.0, 4.0]
    assert downloads.download("x", fetch, str(tmp_path)) and len(calls) == 3
    assert not downloads.download("y", lambda n: (_ for _ in ()).throw(OSError()), str(tmp_path), attempts=2, wait=waits.append)
    assert downloads.download_all(["p", "q"], lambda n: b"1", str(tmp_path)) == {"p": True, "q": True}
    seen = []
    downloads.download_locked("z", lambda n: b"1", str(tmp_path), seen.append)
    downloads.download_locked("z", lambda n: b"1", str(tmp_path), seen.append)
    assert len(seen) == 1


def test_model_retries_and_repairs():
    replies = iter(["not json", "```json\n{\"a\": 1}\n```"])
    waits = []

    def flaky(prompt, state={"n": 0}):
        state["n"] += 1
        if state["n"] == 1:
            raise ValueError("busy")
        return next(replies)

    model = tasks.Model([flaky], wait=waits.append)
    assert model.json("give") == {"a": 1} and waits == [2.0]


def test_report_section(spark, tmp_path):
    df = spark.createDataFrame([("core", 0.25), ("tokens", 123456.0), ("none", 0.0)], "metric string, value double")
    results.write_section(df, str(tmp_path / "r"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "r")).collect()) == ["- core: 0.2500", "- tokens: 123,456"]


def test_prompt_spans(spark):
    df = spark.createDataFrame([(1, 0, [9, 1, 2]), (1, 1, [9, 1, 3, 2])], "item long, option int, ids array<int>")
    spans = lambda kind, rows=df: {r.option: (r.span_start, r.span_end) for r in metrics.prompt_spans(rows, kind).collect()}
    assert spans("multiple_choice") == {0: (2, 3), 1: (2, 4)}
    assert spans("schema") == {0: (2, 3), 1: (3, 4)}
    longer = spark.createDataFrame([(1, 0, [9, 1]), (1, 1, [9, 1, 3])], df.schema)
    assert spans("language_modeling", longer) == {1: (2, 3)}
    same = longer.withColumn("ids", F.array(F.lit(9)))
    for wrong in (df, same):
        with pytest.raises(Exception, match="must go on"):
            spans("language_modeling", wrong)
    with pytest.raises(ValueError):
        metrics.prompt_spans(df, "other")


def test_sampled_tokens_follow_softmax(spark):
    logits, n = [0.5, 2.0, -1.0, 2.0, 1.0], 4_000
    draws = spark.range(n).select(F.array(*map(F.lit, logits)).alias("x"), ((F.col("id") + 0.5) / n).alias("u"))
    for temperature, k in ((1.0, None), (0.5, 3), (2.0, 9)):
        got = Counter(r.t for r in draws.select(metrics.sampled_token(F.col("x"), F.col("u"), temperature, k).alias("t")).collect())
        best = sorted(range(5), key=lambda i: (-logits[i], i))[:k]
        weight = {i: math.exp(logits[i] / temperature) for i in best}
        for i in range(5):
            assert abs(got[i] / n - weight.get(i, 0.0) / sum(weight.values())) < 1e-3
    greedy = draws.limit(5).select(metrics.sampled_token(F.col("x"), F.col("u"), 0.0).alias("t"))
    assert {r.t for r in greedy.collect()} == {1}
    with pytest.raises(ValueError):
        metrics.sampled_token(F.col("x"), F.col("u"), -1.0)


def test_marks_by_name_and_special_text(spark):
    ranks, names = {bytes([i]): i for i in range(256)}, ["<|bos|>", "<|end|>"]
    df = spark.createDataFrame([(1, "a<|bos|>"), (2, None)], "doc_id long, text string")
    coded = bpe.encoded(df, ranks, prepend="<|bos|>", append=257, specials=names)
    ids = {r.doc_id: r.ids for r in coded.collect()}
    assert ids == {1: [256, *b"a<|bos|>", 257], 2: [256, 257]}
    vocab = bpe.vocabulary(spark, ranks, names)
    assert {r.text for r in bpe.decoded(coded, vocab).collect()} == {"a<|bos|>", ""}
    assert {r.text for r in bpe.decoded(coded, vocab, with_specials=True).collect()} == {"<|bos|>a<|bos|><|end|>", "<|bos|><|end|>"}
    assert bpe.token_id("a", ranks, names) == 97
    with pytest.raises(KeyError):
        bpe.token_id("<|none|>", ranks, names)


def test_rank_stream_goes_on_at_the_next_stride(spark):
    rows = [(e, f, g) for e in (1, 2) for f in (0, 1) for g in range(5)]
    df = spark.createDataFrame(rows, "epoch int, file int, row_group int")
    for after in (None, (1, 0, 0), (1, 0, 1), (1, 0, 4), (1, 1, 2), (2, 1, 4)):
        for rank in range(2):
            want, live = [], after is None
            for e, f in ((e, f) for e in (1, 2) for f in (0, 1)):
                start = rank
                if after and (e, f) == after[:2]:
                    live, start = True, (after[2] // 2 + 1) * 2 + rank
                want += [(e, f, g) for g in range(start, 5, 2)] if live else []
            got = sorted(tuple(r) for r in corpus.rank_stream(df, rank, 2, after).collect())
            assert got == want
