"""The split and the sampling that the trained operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Range of the sampling hash.
SPAN = 1 << 32


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of doc_id as text leaves 1 modulo 3; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bounded_sample(rows: DataFrame, by: str, bound: int, doc_id: str = "doc_id", seed: str = "sample") -> DataFrame:
    """About ``bound`` rows of each value of ``by`` at most, chosen by a hash of doc_id.

    One small aggregation counts the values; the choice itself is a filter, so
    no rows move and no order is needed.  Values are categories: few.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(by).count().collect()}
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id).cast("string")), F.lit(SPAN))
    keep = F.lit(False)
    for value, n in counts.items():
        if value is not None:
            keep = F.when(F.col(by) == F.lit(value), place < F.lit(min(SPAN, SPAN * bound // n))).otherwise(keep)
    return rows.filter(keep)
