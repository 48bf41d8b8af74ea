"""Book records of several shapes as one: year, text."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import before, clean_ocr, parse_year

CUTOFF = 1929


def probe(df: DataFrame, paths: Sequence[str]) -> list[Column]:
    """Columns among ``paths`` (``a`` or ``a.b``) that the frame has, as strings."""
    found = []
    for path in paths:
        head, _, tail = path.partition(".")
        if head not in df.columns:
            continue
        kind = df.schema[head].dataType
        if not tail:
            found.append(F.col(head).cast("string"))
        elif hasattr(kind, "names") and tail in kind.names:
            found.append(F.col(head)[tail].cast("string"))
        elif kind.typeName() == "map":
            found.append(F.try_element_at(F.col(head), F.lit(tail)).cast("string"))
        elif kind.typeName() == "string":  # JSON in a string; bad JSON has no fields
            found.append(F.get_json_object(F.col(head), f"$.{tail}"))
    return found


def first_of(df: DataFrame, paths: Sequence[str], use: Callable[[Column], Column] = lambda c: c) -> Column:
    columns = [use(c) for c in probe(df, paths)]
    return F.coalesce(*columns) if columns else F.lit(None).cast("string")


def books(raw: DataFrame, years: Sequence[str], texts: Sequence[str], cutoff: int = CUTOFF, cleaned: bool = True, limit: int | None = None) -> DataFrame:
    """``raw`` with ``year`` and ``text``: before ``cutoff``, cleaned, rejects dropped.

    The year is tested first, below the cleaning.  ``limit`` caps a stream's documents.
    """
    dated = raw.withColumn("_year", first_of(raw, years, parse_year)).withColumn("_text", F.nullif(first_of(raw, texts, lambda c: F.nullif(c, F.lit(""))), F.lit("")))
    kept = dated.filter(before(F.col("_year"), cutoff) & F.col("_text").isNotNull())
    out = kept.withColumn("year", F.col("_year")).withColumn("text", clean_ocr(F.col("_text")) if cleaned else F.col("_text")).drop("_year", "_text").filter("text is not null")
    return out.limit(limit) if limit else out


# Where each kind of record keeps its year and its text.
SHAPES: Mapping[str, tuple[Sequence[str], Sequence[str]]] = {
    "scans": (("year", "date", "publish_year", "metadata.year", "metadata.date", "metadata.publish_year"), ("text", "ocr", "content")),
    "library": (("year", "date", "metadata.year", "metadata.date"), ("text", "ocr")),
    "classics": (("METADATA.year", "METADATA.date", "METADATA.publish_year", "year"), ("TEXT", "text")),
}


def stream(name: str, raw: DataFrame, **options) -> DataFrame:
    """Books of a named shape."""
    if name not in SHAPES:
        raise ValueError(f"unknown shape: {name}")
    years, texts = SHAPES[name]
    return books(raw, years, texts, **options)


def or_empty(spark: SparkSession, read: Callable[[], DataFrame], schema: str) -> DataFrame:
    """What ``read`` gives, or no rows where the source isn't there."""
    from pyspark.errors import AnalysisException

    try:
        return read()
    except AnalysisException:
        return spark.createDataFrame([], schema)
