"""Connected components of an edge table, by alternating large and small stars.

Edges stay in DataFrames; every round is written to the shared folder, so a
lost executor costs at most one round.  A node of very many edges is met by
map-side minima and an ordinary equi-join, which Spark splits when skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import landed


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, label`` of every node of ``edges(u, v)``: label is the component's least id.

    Null and self edges are ignored.  An empty table gives an empty result.
    """
    now = landed(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    state = None
    while True:
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (row[0], row[1]) == state or not row[0]:
            break
        state = (row[0], row[1])
        now = landed(_small(_large(now)), "edges")
    pointed = now.select(F.col("u").alias("id"), F.col("v").alias("label"))
    return pointed.union(pointed.select(F.col("label").alias("id"), "label").distinct())
