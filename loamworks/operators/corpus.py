"""Corpus building: weighted mixing, character budgets, shard assignment and writing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import landed
from .ordering import numbered, running_sum

BLOCK = 1024
SHARD_CHARS = 250_000_000


def parse_mix(mix: str) -> dict[str, float]:
    """``name:weight,name:weight`` as a dict."""
    return {name.strip(): float(weight) for name, _, weight in (part.partition(":") for part in mix.split(",") if part.strip())}


def unknown_streams(mix: Mapping[str, float], known: Mapping) -> list[str]:
    """Names of a mix that no stream has."""
    return sorted(set(mix) - set(known))


def round_robin(docs: DataFrame, weights: Mapping[str, float], stream: str = "source", key: str = "doc_id", default: float | None = 1e-9) -> DataFrame:
    """Interleave streams by weight: adds ``pos``, a document's place in the mix.

    The stream with the least count / weight goes next, ties by the order of
    ``weights``, which is a sort by (place in stream / weight, stream order).
    Streams without a weight weigh ``default``, so they come when the others are
    over; with None they are left out.  ``key`` is unique in its stream.  Places are found on a written table of keys, so
    texts move once, when they are joined with their places.
    """
    pairs = [x for i, (name, w) in enumerate(weights.items()) for x in (F.lit(name), F.struct(F.lit(float(max(w, 1e-9))).alias("w"), F.lit(i).alias("k")))]
    known = F.try_element_at(F.create_map(*pairs), F.col(stream)) if pairs else F.lit(None).cast("struct<w:double,k:int>")
    other = F.struct(F.lit(float(default or 1.0)).alias("w"), F.lit(len(weights)).alias("k"))
    chosen = docs.select(stream, key, (F.coalesce(known, other) if default is not None else known).alias("_mix")).filter("_mix is not null")
    keys = landed(chosen.select(stream, key, F.col("_mix.w").alias("_w"), F.col("_mix.k").alias("_k")), "mix")
    n = keys.count()
    turns = numbered(keys, "_i", key, by=[stream], rows=n).withColumn("_turn", F.col("_i") / F.col("_w"))
    return docs.join(numbered(turns, "pos", "_turn", ["_k", stream], rows=n).select(stream, key, "pos"), [stream, key])


def char_prefix(docs: DataFrame, budget: int, key: str = "doc_id", text: str = "text", cap: int | None = None) -> DataFrame:
    """Documents up to and including the one that crosses ``budget`` characters; texts cut to ``cap`` first.

    ``key`` is unique.  Only keys and lengths are summed; the result is a filter
    by the last key, which reaches the scan.
    """
    cut = docs.withColumn(text, F.substring(text, 1, cap)) if cap else docs
    sizes = landed(cut.select(key, F.length(text).cast("long").alias("_chars")), "sizes")
    last = running_sum(sizes, "_total", "_chars", key, rows=sizes.count()).filter(F.col("_total") - F.col("_chars") <= budget).agg(F.max(key)).first()[0]
    return cut.filter(F.lit(False)) if last is None else cut.filter(F.col(key) <= F.lit(last))


def _fold(limit: int, target: int | None, tail: bool, size: int) -> Callable:
    """Walk blocks in order: close a shard at the block that brings it to ``limit`` characters."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = held = total = 0
        stopped = False
        pending: list[int] = []
        for part in parts:
            rows = []
            for block, docs, chars in part[["block", "docs", "chars"]].itertuples(index=False):
                if stopped:
                    break
                pending.append(int(block))
                held += int(chars)
                if docs == size and held >= limit:
                    rows += [(b, shard) for b in pending]
                    total += held
                    pending, held, shard = [], 0, shard + 1
                    stopped = target is not None and total >= target
            yield pd.DataFrame(rows, columns=["block", "shard"])
        if pending and tail and not stopped:
            yield pd.DataFrame([(b, shard) for b in pending], columns=["block", "shard"])

    return run


def assign_shards(docs: DataFrame, limit: int = SHARD_CHARS, target: int | None = None, tail: bool = True, pos: str = "pos", text: str = "text", block: int = BLOCK, chars: str | None = None) -> DataFrame:
    """Add ``shard`` to documents that carry their place ``pos``.

    Shards close only at the ends of blocks of ``block`` documents.  With
    ``target``, nothing follows the shard that reaches so many characters.
    ``chars`` names a column of lengths, where texts needn't be read.  ``tail``
    keeps the last shard that isn't full.  The fold streams over one
    small row a block in a single task with constant memory.
    """
    blocks = docs.withColumn("block", F.floor(F.col(pos) / block).cast("long"))
    sums = blocks.groupBy("block").agg(F.count("*").alias("docs"), F.sum(F.col(chars) if chars else F.length(text)).alias("chars"))
    folded = sums.coalesce(1).sortWithinPartitions("block").mapInPandas(_fold(limit, target, tail, block), "block long, shard long")
    return blocks.join(folded, "block").drop("block")


def write_shards(docs: DataFrame, out: str, first: int = 0, pos: str = "pos") -> None:
    """Write ``text`` of sharded documents, a folder a shard, in order, in row groups of ``BLOCK``."""
    rows = docs.select("text", pos, (F.col("shard") + first).alias("shard"))
    ordered = rows.repartition("shard").sortWithinPartitions("shard", pos).drop(pos)
    options = {"compression": "zstd", "parquet.block.row.count.limit": str(BLOCK), "parquet.enable.dictionary": "false"}
    ordered.write.mode("append").options(**options).partitionBy("shard").parquet(out)


def next_shard(spark: SparkSession, out: str) -> int:
    """One more than the highest shard number in ``out``, 0 where there is none."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(out)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    numbers = [int(n.partition("=")[2]) for n in names if n.startswith("shard=") and n.partition("=")[2].isdigit()]
    return max(numbers, default=-1) + 1


def build_corpus(sources: Mapping[str, DataFrame], mix: Mapping[str, float], out: str, target_tokens: int, chars_a_token: int = 4, limit: int = SHARD_CHARS) -> None:
    """Mix cleaned ``sources`` of ``doc_id, text`` and append shards to ``out`` until the target."""
    if missing := unknown_streams(mix, sources):
        raise ValueError(f"unknown streams: {', '.join(missing)}")
    parts = [df.select(F.lit(name).alias("source"), F.col("doc_id").cast("long").alias("doc_id"), "text") for name, df in sources.items() if name in mix]
    docs = parts[0]
    for more in parts[1:]:
        docs = docs.unionByName(more)
    spark = docs.sparkSession
    docs = landed(docs, "corpus")  # cleaned once, though read for keys, lengths and texts
    write_shards(assign_shards(round_robin(docs, mix), limit, target_tokens * chars_a_token), out, next_shard(spark, out))


def row_groups(docs: DataFrame, key: str, size: int = BLOCK) -> DataFrame:
    """Add ``row_group`` by the order of the unique ``key``; places are found on keys alone."""
    keys = docs.select(key)
    places = numbered(keys, "_at", key).select(key, F.floor(F.col("_at") / size).cast("long").alias("row_group"))
    return docs.join(places, key)


def strided(column: Column, start: int, step: int) -> Column:
    """Every ``step``-th value from ``start`` on."""
    return (column >= start) & (F.pmod(column - F.lit(start), F.lit(step)) == 0)


def epochs(df: DataFrame, n: int) -> DataFrame:
    """``df`` once an epoch, with ``epoch`` from 1."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(n))))


def rank_stream(groups: DataFrame, rank: int, world: int, after: tuple[int, int, int] | None = None) -> DataFrame:
    """A rank's rows of ``groups(epoch, file, row_group, ..)``: every ``world``-th row group of each file.

    ``after`` is the (epoch, file, row_group) that any rank had reached: rows go on at the next stride of that file.
    """
    mine = groups.filter(strided(F.col("row_group"), rank, world))
    if after is None:
        return mine
    epoch, file, group = after
    stride = (group // world + 1) * world
    here = (F.col("file") > file) | ((F.col("file") == file) & (F.col("row_group") >= stride))
    return mine.filter((F.col("epoch") > epoch) | ((F.col("epoch") == epoch) & here))


def task_slice(df: DataFrame, start: int, stop: int, step: int = 1, index: str = "idx") -> DataFrame:
    """The rows of a dense index from ``start`` up to ``stop`` by ``step``, renumbered."""
    kept = df.filter(strided(F.col(index), start, step) & (F.col(index) < stop))
    return kept.withColumn(index, F.floor((F.col(index) - start) / step).cast("long"))


def hash_order(seed: int, *keys: str) -> Column:
    """A fixed pseudo-random order that SQL can reproduce: md5 of seed and keys."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))
