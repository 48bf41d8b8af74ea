"""Operator 10: benchmark decontamination by spaced-seed hashing, by DataFrame functions only.

Words are lower-case runs of letters and digits.  Every window of a benchmark
item and of a document is hashed once for each mask; a mask ignores the words
at its zeros, so a substituted word there doesn't matter.  Equal hashes are
hits.  Around a hit, on its diagonal, a stretch of ``REACH`` item words (or the
whole item, if it is shorter) that contains the hit must agree with the document
in at least ``AGREE_PERCENT`` of its words.

The masks lose nothing: every way in which a stretch of ``LEAST`` to ``REACH``
words can agree in ``AGREE_PERCENT`` has a place for one of them.

Items of fewer than ``LEAST`` words match where a document has exactly these
words in a row.

The seeds of the benchmark are broadcast only up to ``BROADCAST_SEEDS`` rows, each
with the ``NEAR`` item words around it and no more, so with at most some 350
bytes; beyond that windows are joined by shuffle and hits go back to their documents.

Defined results: null and empty texts and items match nothing; rows that repeat
a doc_id are told apart by their text; repeated items count once; other columns
are ignored; with an empty benchmark every document is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bound

#: Found by trying every pair of masks of four words on every pattern of agreement.
MASKS = ("11101", "100111")
LEAST = 9
REACH = 20
AGREE_PERCENT = 75
#: Rows of at most some 350 bytes: 70 MB.
BROADCAST_SEEDS = 200_000
BROADCAST_IDS = 1_000_000


def word_hashes(text: Column) -> Column:
    """A 64-bit hash of each word."""
    return F.transform(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def _seed(words: Column, at: Column, mask: int) -> Column:
    return F.xxhash64(F.lit(mask), *(F.get(words, at + k) for k, bit in enumerate(MASKS[mask]) if bit == "1"))


def windows(w: Column) -> Column:
    """Hashes of all windows under all masks, an array for each window's place; null where a mask is too long."""
    least = min(map(len, MASKS))
    seed = lambda i, m: _seed(w, i, m) if len(MASKS[m]) == least else F.when(i + len(MASKS[m]) <= F.size(w), _seed(w, i, m))
    each = F.transform(F.sequence(F.lit(0), F.size(w) - least), lambda i: F.array(*(seed(i, m) for m in range(len(MASKS)))))
    return F.when(F.size(w) >= least, each)


def exploded(rows: DataFrame, *carried: str) -> DataFrame:
    """``carried``, ``at``, ``span``, ``seed`` of every window and mask of ``rows(words)``."""
    # One explode of a flat array: place number / masks is the window.  The outer
    # form keeps the optimiser from testing the array's size by computing it again.
    flat = rows.select(*carried, bound(F.col("words"), lambda w: F.flatten(windows(w))).alias("seeds"))
    rows = flat.select(*carried, F.posexplode_outer("seeds").alias("k", "seed")).filter("seed is not null")
    span = F.get(F.array(*(F.lit(len(m)) for m in MASKS)), F.pmod("k", F.lit(len(MASKS))))
    return rows.withColumn("at", F.floor(F.col("k") / len(MASKS)).cast("int")).withColumn("span", span).drop("k")


#: Words around a hit that any stretch with the hit can reach.
NEAR = 2 * REACH - min(map(len, MASKS))


def _near_items(seeds: DataFrame, *carried: str) -> DataFrame:
    """Seeds with only the item words near them: ``low`` is the first one's place, ``rest`` their number to the item's end."""
    low = seeds.withColumn("low", F.greatest(F.lit(0), F.col("item_at") + F.col("span") - REACH))
    return low.select(*carried, "item_id", "item_at", "span", "low", (F.size("item") - F.col("low")).alias("rest"), F.least(F.lit(REACH), F.size("item")).alias("reach"), F.slice("item", F.col("low") + 1, F.lit(NEAR)).alias("x"))


def _around(hits: DataFrame) -> DataFrame:
    """Hits with only the document's words near them: a few hundred bytes a row.

    Slices are generated code, so they are cut inside the join's stage and a
    long document's words never leave it.
    """
    start = hits.withColumn("start", F.col("low") + F.col("at") - F.col("item_at"))
    return start.select(
        "doc_id", "digest", "item_id", "span", (F.col("item_at") - F.col("low")).alias("p"), "rest", "reach", "x",
        F.slice("words", F.greatest(F.lit(0), F.col("start")) + 1, F.lit(NEAR)).alias("y"), F.greatest(F.lit(0), -F.col("start")).alias("gap"),
    )


def _agrees() -> Column:
    """Whether some stretch around a hit agrees well enough.

    Tests of both sizes keep the slices from being computed inside the lambdas.
    """
    x, y, p, reach, span = map(F.col, ("x", "y", "p", "reach", "span"))
    first = F.greatest(F.lit(0), p + span - reach)
    last = F.greatest(first, F.least(p, F.col("rest") - reach))
    same = lambda o: F.when((o >= F.col("gap")) & (F.get(x, o) == F.get(y, o - F.col("gap"))), 1).otherwise(0)
    count = lambda s: F.aggregate(F.sequence(s, s + reach - 1), F.lit(0), lambda a, o: a + same(o))
    return (F.size(x) >= span) & (F.size(y) > 0) & F.exists(F.sequence(first, last), lambda s: 100 * count(s) >= AGREE_PERCENT * reach)


def _confirmed(hits: DataFrame) -> DataFrame:
    """``doc_id, digest, item_id`` of hits that agree.

    An aggregate rather than a filter: a filter would become part of the join,
    which then isn't generated code and would buffer every window with its words.
    """
    best = _around(hits).groupBy("doc_id", "digest", "item_id").agg(F.max(_agrees()).alias("agrees"))
    return best.filter("agrees").select("doc_id", "digest", "item_id")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, digest, item_id`` of every document and item that overlap."""
    items = benchmark.select("item_id", word_hashes(F.col("text").cast("string")).alias("item")).filter("size(item) > 0").distinct()
    # Items of under LEAST words go by their own length, not by the masks.
    seeds = exploded(items.filter(f"size(item) >= {LEAST}").withColumn("words", F.col("item")), "item_id", "item").withColumnRenamed("at", "item_at")
    rows = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("digest"), word_hashes(F.col("text").cast("string")).alias("words"))
    if seeds.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        # The words ride along inside the stage; only confirmed hits leave it.
        hits = exploded(rows, "doc_id", "digest", "words").drop("span").join(F.broadcast(_near_items(seeds, "seed")), "seed")
        found = _confirmed(hits)
    else:
        thin = exploded(rows, "doc_id", "digest").drop("span").join(seeds.drop("item"), "seed").select("doc_id", "digest", "item_id", "at", "item_at", "span").distinct()
        hits = _near_items(thin.join(items, "item_id"), "doc_id", "digest", "at").join(rows.select(F.col("doc_id").alias("id"), F.col("digest").alias("d"), "words").distinct(), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d")))
        found = _confirmed(hits)
    short = items.filter(f"size(item) < {LEAST}").select("item_id", F.size("item").alias("n"), F.xxhash64("item").alias("seed"))
    lengths = sorted(r.n for r in short.select("n").distinct().collect())
    return found.union(_exact(rows, short, lengths)).distinct() if lengths else found.distinct()


def _exact(rows: DataFrame, short: DataFrame, lengths: list[int]) -> DataFrame:
    """``doc_id, digest, item_id`` where a short item's words stand in a row in a document."""
    def of(w: Column, n: int) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.struct(F.lit(n).alias("n"), F.xxhash64(F.slice(w, i + 1, n)).alias("seed")))
        return F.when(F.size(w) >= n, each)

    parts = rows.select("doc_id", "digest", F.explode(bound(F.col("words"), lambda w: F.flatten(F.filter(F.array(*(of(w, n) for n in lengths)), lambda x: x.isNotNull())))).alias("x")).select("doc_id", "digest", "x.n", "x.seed")
    if short.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        short = F.broadcast(short)
    return parts.join(short, ["n", "seed"]).select("doc_id", "digest", "item_id")


def judge(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_items, first_item, kept`` of every row: the items it overlaps, kept if none."""
    found = leaks(docs, benchmark).groupBy("doc_id", "digest").agg(F.count("*").alias("n"), F.min("item_id").alias("first_item"))
    found = found.select(F.col("doc_id").alias("id"), F.col("digest").alias("d"), "n", "first_item")
    rows = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("digest"))
    both = rows.join(found, rows["doc_id"].eqNullSafe(found["id"]) & (rows["digest"] == found["d"]), "left")
    return both.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_items"), "first_item", F.col("n").isNull().alias("kept"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no item, all columns as they are."""
    from .shared import landed

    bad = landed(leaks(docs, benchmark).select(F.col("doc_id").alias("id"), F.col("digest").alias("d")).distinct(), "leaks")
    if bad.count() <= BROADCAST_IDS:
        bad = F.broadcast(bad)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["id"]) & (F.xxhash64(docs["text"].cast("string")) == bad["d"]), "left_anti")
