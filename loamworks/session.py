"""Sessions for local work and for clusters."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Rows of an Arrow batch: whole texts make rows large.
ROWS_A_BATCH = 1_000


def tuned(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches of at most ``ROWS_A_BATCH`` rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= ROWS_A_BATCH:
        spark.conf.set(name, str(ROWS_A_BATCH))
    return spark


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects: UTC, adaptive plans, Arrow."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    build = SparkSession.builder.master(master or f"local[{cpus}]").appName("loamworks")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
    }
    for key, value in (settings | conf).items():
        build = build.config(key, value)
    spark = build.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
