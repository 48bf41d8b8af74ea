"""Result tables and logs: padded CSV, last values of logs, report sections, checkpoints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header and a fixed schema."""
    return spark.read.csv(path, header=True, schema=schema, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def padded_csv(lines: DataFrame, names: Sequence[str], value: str = "value") -> DataFrame:
    """Rows of comma-separated, space-padded text; numbers that can't be read are null."""
    cells = F.split(value, ",")
    first = F.trim(F.get(cells, F.lit(0)))
    rest = [F.trim(F.get(cells, F.lit(i))).try_cast("double").alias(n) for i, n in enumerate(names[1:], 1)]
    return lines.filter(F.trim(value) != "").select(first.alias(names[0]), *rest)


def write_padded_csv(rows: DataFrame, path: str, widths: Mapping[str, int]) -> None:
    """Fixed-width, comma-separated lines."""
    line = F.concat_ws(",", *(F.rpad(F.col(c).cast("string"), w, " ") for c, w in widths.items()))
    rows.select(line.alias("value")).write.mode("overwrite").text(path)


def last_values(log: DataFrame, patterns: Mapping[str, str], by: str, order: str, value: str = "value") -> DataFrame:
    """For each log the last match of each pattern's first group."""
    out = []
    for name, pattern in patterns.items():
        found = F.nullif(F.regexp_extract(value, pattern, 1), F.lit(""))
        out.append(F.max_by(F.when(F.col(value).rlike(pattern), found), F.when(F.col(value).rlike(pattern), F.col(order))).alias(name))
    return log.groupBy(by).agg(*out)


def sections(lines: DataFrame, by: str, order: str, value: str = "value") -> DataFrame:
    """``by, metric, value``: the last ``- key: value`` of each key."""
    key, text = F.regexp_extract(value, r"^- ([^:]+): ", 1), F.regexp_extract(value, r"^- [^:]+: (.*)$", 1)
    rows = lines.select(by, order, key.alias("metric"), text.alias("v")).filter("metric <> ''")
    return rows.groupBy(by, "metric").agg(F.max_by("v", order).alias("value"))


def largest_model(names: DataFrame, name: str = "name") -> DataFrame:
    """The tag ``d<N>`` of the largest N."""
    depth = F.regexp_extract(name, r"^d(\d+)$", 1).try_cast("int")
    return names.withColumn("depth", depth).filter("depth is not null").agg(F.max_by(name, "depth").alias("tag"), F.max("depth").alias("depth"))


def last_step(names: DataFrame, name: str = "name") -> DataFrame:
    """The last step of ``model_<step>.pt`` files."""
    return names.agg(F.max(F.regexp_extract(name, r"^model_(\d+)\.pt$", 1).try_cast("int")).alias("step"))


def append_new(rows: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Append the rows whose keys aren't in the table yet; how many there were."""
    from .books import or_empty

    spark = rows.sparkSession
    there = or_empty(spark, lambda: spark.read.parquet(path), rows.schema.simpleString()[7:-1])
    fresh = rows.join(there.select(*keys).distinct(), list(keys), "left_anti").dropDuplicates(list(keys)).select(*rows.columns).persist()
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    fresh.unpersist()
    return n


def write_section(metrics: DataFrame, path: str) -> None:
    """``metric, value`` numbers as ``- metric: value`` lines; empty values are left out."""
    from ..operators.metrics import shown

    kept = metrics.filter(F.col("value").isNotNull() & (F.col("value") != 0))
    kept.select(F.concat(F.lit("- "), F.col("metric"), F.lit(": "), shown(F.col("value"))).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def log_metrics(rows: DataFrame, path: str, run: str) -> None:
    """Append ``step, metric, value`` rows of a run to a metrics table."""
    rows.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(path)
