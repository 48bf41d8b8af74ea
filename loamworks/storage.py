"""The folder that driver and executors share, and cut-off points for lineage."""

from __future__ import annotations

import tempfile
import uuid

#: Tables that this process has written, oldest first.
_WRITTEN: list[str] = []

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only where it is unset, in local mode, a temporary folder."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if given:
        return given.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loamworks-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> int:
    """How many tables this process has written and not discarded."""
    return len(_WRITTEN)


def discard(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the written tables from number ``since`` on but for the newest ``keep``; frames that read them end."""
    jvm = spark.sparkContext._jvm
    gone = _WRITTEN[since : len(_WRITTEN) - keep]
    for path in gone:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    del _WRITTEN[since : since + len(gone)]
