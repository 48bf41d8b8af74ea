"""Operator 5: near-duplicate groups by SetSketch registers.

A register is ``clip(floor(1 - log_b(x)), 0, q + 1)`` of the least of the set's
exponential variates ``x`` under the register's own hash: exponentially spaced
truncated minima, mergeable by the larger value.  Bands of register values find
candidates, the joint likelihood of a pair's registers rules out those that
can't reach the similarity, and full shingle sets confirm the rest.

1. Documents with equal shingle sets form a class; one stands for it.
2. Stars: in every bucket of the first registers' bands, each class is paired
   with the bucket's least class; confirmed links give components.
3. Rest: in buckets that still hold several components, classes of different
   components (one of them outside the bucket's largest) are compared by size
   and by two bits of each of the registers, and those that agree by their
   shingles, cut to 32 bits, in the join's condition.  Only pairs at the
   similarity leave the join, each from the first bucket it shares, and full
   sets confirm them; so a family alike by a little less hands on no pairs.
   Sets of over ``CARRIED`` shingles aren't carried; their pairs go from the two
   bits to the full sets.  Pairs inside a component can't change the result, so
   they are never made.

With 32 bands of 4 registers, a pair at similarity 0.75 escapes the bands with
probability 2.6e-6, and the two-bit comparison with about 2e-7.  No bucket is
capped.

Hot classes: rows are joined only with classes of several members, from a
written table, so that adaptive execution splits a class of very many rows;
texts without words take no part in any join.

Defined results: texts that are null or without words have no links; rows that
repeat a doc_id are one node, which has the links of all its texts; a row with a
null doc_id joins its class, or has a null component if the class has no id;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrow import Bounded, map_text, raw_texts, tidy
from .components import components
from .shared import landed
from .shingles import mix, shingle_set, word_cache

BANDS, ROWS = 32, 4
#: Registers kept whole, for bands and likelihood, and all registers, of which two bits are kept.
FULL, REGISTERS = 256, 1024
#: Spacing, rate and largest register value before the last.
BASE, RATE, Q = 1.001, 20.0, 65_534
PERCENT = 75
#: A candidate is dropped when 0.75 or more is this much less likely (log) than the best estimate.
DOUBT = 16.0
#: Registers whose two bits may differ in a pair that is still compared: 5.2 deviations at 0.75.
MOST_DIFFERENT = 257
#: Shingles of the largest set whose elements go through the join of rest pairs, four bytes each.
CARRIED = 2_048
#: Ids that may be broadcast: 16 MB of longs; more are joined by shuffle.
BROADCAST_IDS = 1_000_000

_SEEDS = np.random.default_rng(5).integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minima(hashes: np.ndarray) -> np.ndarray:
    """Least 32-bit hash of each register; of an empty set the largest value.

    The first half of the registers permute the low halves of the 64-bit
    hashes, the others the high halves, each by its own odd factor.
    """
    low = np.full(REGISTERS, np.iinfo(np.uint32).max, dtype=np.uint32)
    half = REGISTERS // 2
    for part, words in ((slice(0, half), hashes.astype(np.uint32)), (slice(half, REGISTERS), (hashes >> np.uint64(32)).astype(np.uint32))):
        for i in range(0, len(words), 512):
            np.minimum(low[part], np.multiply.outer(_SEEDS[part], words[i : i + 512]).min(axis=1), out=low[part])
    return low


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes."""
    u = (minima(hashes).astype(np.float64) + 0.5) / 2.0**32
    x = -np.log1p(-u) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, Q + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def log_likelihood(more: np.ndarray, less: np.ndarray, u: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Joint log likelihood of similarities ``j`` given how many registers are larger and smaller.

    ``u`` is the first set's share of the two sets' sizes.
    """
    v = 1 - u
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * ((BASE - 1) / BASE)) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    same = np.clip(1 - up - down, 1e-12, 1)
    return more * np.log(up) + less * np.log(down) + (FULL - more - less) * np.log(same)


def plausible(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether pairs of registers (rows of a and b) leave room for the similarity asked for."""
    sizes = 100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb)
    u = (na / (na + nb))[:, None]
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    most = np.minimum(na, nb) / np.maximum(na, nb)
    at = np.linspace(0.0, 1.0, 101)[None, :] * most[:, None]
    lik = log_likelihood(more, less, u, at)
    enough = np.where(at >= PERCENT / 100 - 0.01, lik, -np.inf).max(axis=1)
    return sizes & (enough >= lik.max(axis=1) - DOUBT)


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set as two longs."""
    both = xxhash.xxh3_128_digest(hashes.tobytes())
    return int.from_bytes(both[:8], "little", signed=True), int.from_bytes(both[8:], "little", signed=True)


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, n, d1, d2, regs, signs``: set size, 128-bit digest of the set, registers, two bits of all registers."""

    def make():
        known = word_cache()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            known.trim()
            n, d1, d2, regs, marks = [], [], [], [], []
            for text in raw_texts(batch.column("text")):
                s = shingle_set(text, known)
                one, two = digest(s)
                n.append(len(s))
                d1.append(one)
                d2.append(two)
                own = registers(s) if len(s) else np.empty(0, dtype=np.uint16)
                regs.append(own[:FULL].tobytes())
                marks.append(signs(own).tobytes())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(regs, pa.binary()), pa.array(marks, pa.binary())], ["doc_id", "n", "d1", "d2", "regs", "signs"])

        return work

    return map_text(docs, make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n bigint, d1 bigint, d2 bigint, regs binary, signs binary")


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band, for each row of registers."""
    part = regs[:, : BANDS * ROWS].reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, k])
    return key.astype(np.int64)


def _registers_of(part: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(part.column("regs").to_pylist()), dtype=np.uint16).reshape(-1, FULL)


def banded(sketches: DataFrame) -> DataFrame:
    """``id, band, key``: a row for each band."""
    kind = sketches.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                where, band = pa.array(np.repeat(np.arange(part.num_rows), BANDS)), np.tile(np.arange(BANDS, dtype=np.int32), part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("id").take(where), pa.array(band), pa.array(band_keys(_registers_of(part)).ravel())], ["id", "band", "key"])

    return sketches.select("id", "regs").mapInArrow(tidy(run), f"id {kind}, band int, key bigint")


#: Longs that hold two bits of each register.
SIGNS = REGISTERS * 2 // 64


def signs(regs: np.ndarray) -> np.ndarray:
    """Two hashed bits of each register, 32 registers a long."""
    two = (mix(regs.astype(np.uint64) + np.uint64(1)) >> np.uint64(62)).reshape(-1, 32)
    return (two << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=1, dtype=np.uint64).astype(np.int64)


def signed(sketches: DataFrame) -> DataFrame:
    """``id, n, d1, d2``, the signs in ``s0..``, 32 bits of each band's key in ``k0..``."""
    kind = sketches.schema["id"].dataType.simpleString()
    names = ["id", "n", "d1", "d2", *(f"s{i}" for i in range(SIGNS)), *(f"k{i}" for i in range(BANDS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                keys = band_keys(_registers_of(part)).astype(np.int32)
                marks = np.frombuffer(b"".join(part.column("signs").to_pylist()), dtype=np.int64).reshape(-1, SIGNS)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names[:4]), *(pa.array(marks[:, i]) for i in range(SIGNS)), *(pa.array(keys[:, i]) for i in range(BANDS))], names)

    columns = ", ".join([*(f"s{i} bigint" for i in range(SIGNS)), *(f"k{i} int" for i in range(BANDS))])
    return sketches.select("id", "n", "d1", "d2", "regs", "signs").mapInArrow(tidy(run), f"id {kind}, n bigint, d1 bigint, d2 bigint, {columns}")


def likely(reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose registers leave room for a link, by joint likelihood."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), dtype=np.uint16).reshape(-1, FULL) for c in ("ra", "rb"))
                na, nb = (part.column(c).to_numpy().astype(np.float64) for c in ("na", "nb"))
                yield part.select(["a", "b"]).filter(pa.array(plausible(a, b, na, nb)))

    side = lambda x: reps.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
    rated = pairs.join(side("a"), "a").join(side("b"), "b").filter(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)")
    return rated.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(tidy(run), f"a {kind}, b {kind}")


def confirmed(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of a written table that are links, on full sets of whole texts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    few = ids.count() <= BROADCAST_IDS
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_cache()
        sets = Bounded(lambda text: shingle_set(text, known), 64)  # a star's centre comes again and again
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                known.trim()
                linked = []
                for ta, tb in zip(raw_texts(part.column("ta")), raw_texts(part.column("tb")), strict=True):
                    x, y = sets[ta], sets[tb]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
                    sets.trim()
                yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    text = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}"))
    both = pairs.join(text("a"), "a").join(text("b"), "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(tidy(exact), f"a {kind}, b {kind}").distinct()


def star_pairs(bands: DataFrame) -> DataFrame:
    """Each bucket's least id with every other id of the bucket, once a pair."""
    lead = bands.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z").select("key", "a")
    return bands.join(lead, "key").filter("id > a").select("a", F.col("id").alias("b")).distinct()


def _may_link() -> Column:
    """Sizes and two-bit registers of rows x and y leave room for a link."""
    sizes = 100 * F.least("x.n", "y.n") >= PERCENT * F.greatest("x.n", "y.n")
    differ = F.lit(0)
    for i in range(SIGNS):
        d = F.col(f"x.s{i}").bitwiseXOR(F.col(f"y.s{i}"))
        differ = differ + F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return sizes & (differ <= MOST_DIFFERENT)


def prints(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, d1, d2, p``: distinct 32-bit cuts of the shingles of each text of ``ids``; null for a set of over ``CARRIED``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    few = ids.count() <= BROADCAST_IDS
    texts = docs.join((F.broadcast(ids) if few else ids).withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")

    def make():
        known = word_cache()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            known.trim()
            d1, d2, cuts = [], [], []
            for text in raw_texts(batch.column("text")):
                s = shingle_set(text, known)
                one, two = digest(s)
                d1.append(one)
                d2.append(two)
                cuts.append(np.unique(s.astype(np.uint32)).view(np.int32) if len(s) <= CARRIED else None)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(cuts, pa.list_(pa.int32()))], ["id", "d1", "d2", "p"])

        return work

    return map_text(texts, make, f"id {kind}, d1 bigint, d2 bigint, p array<int>").dropDuplicates(["id", "d1", "d2"])


def _enough_shared() -> Column:
    """The sets of rows x and y can be at the similarity, or one isn't carried.

    Shingles of one set that fall on the same cut are as many as ``n`` exceeds
    the cuts, so the cuts that both sets have and the fewer of these are at
    least the size of the intersection.
    """
    lost = F.least(F.col("x.n") - F.size("x.p"), F.col("y.n") - F.size("y.p"))
    enough = (100 + PERCENT) * (F.size(F.array_intersect("x.p", "y.p")) + lost) >= PERCENT * (F.col("x.n") + F.col("y.n"))
    return F.col("x.p").isNull() | F.col("y.p").isNull() | enough


def _first_shared() -> Column:
    """No band before this one is shared by x and y, so a pair comes once."""
    out = F.lit(True)
    for i in reversed(range(BANDS)):
        out = (F.col("x.band") == i) | ((F.col(f"x.k{i}") != F.col(f"y.k{i}")) & out)
    return out


def rest_pairs(docs: DataFrame, reps: DataFrame, bands: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of different components that share a bucket and are similar by all that the join carries, once a pair."""
    named = bands.join(labels, "id", "left").select("key", "band", "id", F.coalesce("label", "id").alias("label"))
    sizes = named.groupBy("key", "label").agg(F.count("*").alias("c"))
    # The largest component of a bucket needs no pairs of its own.
    mixed = sizes.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("k")).filter("k > 1").select("key", "main")
    open_rows = landed(named.join(mixed, "key"), "open")
    ids = landed(open_rows.select("id").distinct(), "open")
    signs = signed(reps.join(ids, "id", "left_semi")).join(prints(docs, ids), ["id", "d1", "d2"], "left").drop("d1", "d2")
    rows = landed(open_rows.join(signs, "id"), "signed")
    found = rows.filter("label <> main").alias("x").join(rows.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.label") != F.col("y.label")) & _may_link() & _first_shared() & _enough_shared())
    return found.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    docs = docs.select("doc_id", "text")
    table = landed(sketch(docs), "sketch")
    filled = table.filter("n > 0")
    classes = landed(filled.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c")), "classes")
    several = classes.filter("c > 1").select("d1", "d2", "rep")
    members = landed(filled.select("doc_id", "n", "d1", "d2").join(several, ["d1", "d2"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "members")
    standing = classes.filter("rep is not null").select(F.col("rep").alias("id"), "d1", "d2")
    reps = landed(filled.withColumnRenamed("doc_id", "id").join(standing, ["id", "d1", "d2"], "left_semi").select("id", "n", "d1", "d2", "regs", "signs"), "reps")
    bands = landed(banded(reps), "bands")
    first = landed(star_pairs(bands), "stars")
    links = landed(confirmed(docs, landed(likely(reps, first), "candidates")), "links")
    labels = landed(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "labels")
    rest = landed(rest_pairs(docs, reps, bands, labels).join(first, ["a", "b"], "left_anti"), "rest")
    if rest.limit(1).count():
        links = links.union(landed(confirmed(docs, landed(likely(reps, rest), "candidates")), "links"))
        labels = landed(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "labels")
    own = members.join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left").select("doc_id", "n", F.coalesce("label", "rep").alias("component_id"))
    out = own.union(table.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, all columns as they are.

    Where doc_ids repeat or are null, rows are told apart by doc_id and text:
    different texts of one doc_id are different documents, and of rows that
    repeat both one stays, unless their text has no word.
    """
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("c")).filter("c > 1 or doc_id is null")
    if not repeated.limit(1).count():
        lost = landed(groups(docs).filter("not kept").select("doc_id"), "lost")
        few = lost.count() <= BROADCAST_IDS
        return docs.join(F.broadcast(lost) if few else lost, "doc_id", "left_anti")
    # Keys sort as doc_ids do among themselves; a null doc_id comes last.
    free = "key" + "_" * max(map(len, docs.columns))  # a name that no column has
    name = F.coalesce(F.lpad(F.col("doc_id").cast("string"), 40, " "), F.lit("~"))
    keyed = docs.withColumn(free, F.concat(name, F.lit("/"), F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)))
    judged = landed(groups(keyed.select(F.col(free).alias("doc_id"), "text")), "judged")
    lost = judged.filter("not kept").select(F.col("doc_id").alias(free)).distinct()
    kept = keyed.join(lost, free, "left_anti")
    again = landed(judged.filter("kept and n_shingles > 0").groupBy("doc_id").agg(F.count("*").alias("c")).filter("c > 1").select(F.col("doc_id").alias(free)), "again")
    one = kept.join(again, free, "left_semi").withColumn(free + "n", F.row_number().over(Window.partitionBy(free).orderBy(F.lit(0)))).filter(F.col(free + "n") == 1).drop(free + "n")
    return kept.join(again, free, "left_anti").unionByName(one).drop(free)
