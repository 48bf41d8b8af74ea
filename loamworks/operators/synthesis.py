"""Synthetic data runs: planned indices, seeds, resumption, screening with a cache of verdicts.

The language model is a function that the caller gives; it runs inside
``mapInPandas`` on batches.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import conversation as V
from ..functions import text as T

TEST_OFFSET = 10_000_000


def planned(spark: SparkSession, targets: Mapping[str, int]) -> DataFrame:
    """``category, idx``: disjoint index ranges, one category after the other."""
    out, base = None, 0
    for name, n in targets.items():
        part = spark.range(base, base + n).select(F.lit(name).alias("category"), F.col("id").alias("idx"))
        out, base = part if out is None else out.unionByName(part), base + n
    return out if out is not None else spark.createDataFrame([], "category string, idx long")


def pending(plan: DataFrame, progress: DataFrame, retry: Sequence[str] = ()) -> DataFrame:
    """Planned rows without an outcome; outcomes named in ``retry`` don't count."""
    done = progress.filter(~F.col("outcome").isin(*retry)) if retry else progress
    return plan.join(done.select("category", "idx").distinct(), ["category", "idx"], "left_anti")


def drawn(options: Sequence[str], seed: int, *keys: str) -> Column:
    """One of ``options`` by a hash of seed and keys that SQL can reproduce."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))
    at = F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") % len(options)
    return F.get(F.array(*map(F.lit, options)), at.cast("int"))


def drawn_exact(options: Sequence[str], index: str, offset: int = 0) -> Column:
    """One of ``options`` by a Mersenne Twister seeded with the index, batch by batch."""

    @F.pandas_udf("string")
    def choose(idx: pd.Series) -> pd.Series:
        return idx.map(lambda i: random.Random(int(i) + offset).choice(list(options)))

    return choose(F.col(index))


def example_seed(index: Column, split: Column) -> Column:
    """Seeds of train and test examples never meet."""
    return index + F.when(split == "test", TEST_OFFSET).otherwise(0)


def generated(rows: DataFrame, model: Callable[[str], str], prompt: str = "prompt") -> DataFrame:
    """``rows`` with ``reply``; a call that fails leaves it null and says why in ``error``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", reply string, error string"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            replies, errors = [], []
            for p in part[prompt]:
                try:
                    replies.append(model(p))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  any failure of the model is an outcome
                    replies.append(None)
                    errors.append(f"gen err: {e}")
            yield part.assign(reply=replies, error=errors)

    return rows.mapInPandas(run, schema)


def screened(conversations: DataFrame, cache: DataFrame, judge: Callable[[str], str], name: str = "judge") -> tuple[DataFrame, DataFrame]:
    """Conversations with ``hash, safe, verdict, reason``, and the verdicts that are new.

    Cached verdicts are joined by content hash; only misses, once a hash, go to
    the judge.  Prefilter hits are noted in the reason, they don't decide.
    """
    hashed = conversations.withColumn("hash", V.content_hash(F.col("messages")))
    shown = V.formatted(F.col("messages"))
    missing = hashed.join(cache.select("hash").distinct(), "hash", "left_anti").dropDuplicates(["hash"])
    asked = generated(missing.select("hash", shown.alias("prompt"), T.late_hints(shown).alias("hit")), judge)
    verdict = F.when(F.col("error").isNotNull(), "ERROR").otherwise(T.verdict(F.col("reply")))
    note = F.when(F.col("hit"), F.concat(F.lit("[prefilter] "), F.coalesce("reply", "error"))).otherwise(F.coalesce("reply", "error"))
    fresh = asked.select("hash", verdict.alias("verdict"), note.alias("reason")).withColumn("safe", (F.col("verdict") == "SAFE").cast("int")).withColumn("model", F.lit(name)).select("hash", "safe", "verdict", "reason", "model")
    both = cache.select("hash", "safe", "verdict", "reason").unionByName(fresh.select("hash", "safe", "verdict", "reason"))
    return hashed.join(both, "hash", "left"), fresh.filter("verdict <> 'ERROR'")


def upserted(cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """The cache with fresh verdicts in place of old ones."""
    both = cache.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    columns = [c for c in cache.columns if c != "hash"]
    return both.groupBy("hash").agg(F.max_by(F.struct(*columns), F.struct("_new", *columns)).alias("r")).select("hash", *(f"r.{c}" for c in columns))


def outcomes(rows: DataFrame) -> DataFrame:
    """Counts by category from ``category, messages, error``: an error is one of generation or filter."""
    failed = F.coalesce(F.col("error").rlike("gen err|filter err"), F.lit(False))
    return rows.groupBy("category").agg(
        F.count_if(F.col("messages").isNotNull()).alias("accepted"),
        F.count_if(F.col("messages").isNull() & ~failed).alias("rejected"),
        F.count_if(F.col("messages").isNull() & failed).alias("errors"),
    )


def latest(table: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return table.withColumn("_p", place).filter("_p = 1").drop("_p")
