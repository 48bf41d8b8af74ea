"""Global order without a global task: numbering and running totals by value ranges.

A window over all rows runs in one task.  Here rows fall into ranges of a
numeric key (boundaries from approximate quantiles), windows run in a range,
and each range's offset comes from a table of one row a range and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows aimed at in a range.
ROWS_A_RANGE = 500_000
MOST_RANGES = 4_096


def ranged(df: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """``df`` with ``_range``: a number that rises with the numeric column ``key``.

    ``rows`` is the number of rows, if known; few rows need one range and no pass.
    """
    n = min(MOST_RANGES, -(-(df.count() if rows is None else rows) // ROWS_A_RANGE))
    bounds = sorted(set(df.approxQuantile(key, [i / n for i in range(1, n)], 0.25 / n))) if n > 1 else []
    if not bounds:
        return df.withColumn("_range", F.lit(0))
    marks = F.array(*map(F.lit, bounds))
    return df.withColumn("_range", F.size(F.filter(marks, lambda b: b < F.col(key))))


def _offsets(df: DataFrame, by: Sequence[str], value: Column) -> DataFrame:
    """Sum of ``value`` in earlier ranges, for each group and range: a small table."""
    sums = df.groupBy(*by, "_range").agg(value.alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*by, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))


def numbered(df: DataFrame, name: str, key: str, order: Sequence[str] = (), by: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Add ``name``: the 0-based place of a row by ``key`` then ``order``, within ``by``."""
    ranges = ranged(df, key, rows)
    place = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(key, *order)) - 1
    return ranges.withColumn(name, place.cast("long")).join(_offsets(ranges, by, F.count("*")), [*by, "_range"]).withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_before")


def running_sum(df: DataFrame, name: str, value: str, key: str, order: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` over rows up to and including this one."""
    ranges = ranged(df, key, rows)
    own = F.sum(value).over(Window.partitionBy("_range").orderBy(key, *order).rowsBetween(Window.unboundedPreceding, 0))
    return ranges.withColumn(name, own).join(_offsets(ranges, [], F.sum(value)), ["_range"]).withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_before")
