"""Streaming: documents from growing folders, stateful packing, idempotent sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.packing import Buffer


def documents(spark: SparkSession, path: str, schema: str = "doc_id long, text string", files: int = 1) -> DataFrame:
    """A stream over a folder of Parquet shards; offsets live in the query's checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def counted(stream: DataFrame, by: str = "source") -> DataFrame:
    """Running documents and characters by a column."""
    return stream.groupBy(by).agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars"))


def packed(stream: DataFrame, capacity: int, buffer_size: int, by: str = "rank", pad: int = 0) -> DataFrame:
    """Best-fit rows of ``capacity`` ids from a stream of ``rank, ids``, padded, never cropped.

    Waiting sequences are the state of their rank; a row is given out while
    more than ``buffer_size`` of them wait.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting = Buffer()
        held = state.get[0] if state.exists else []
        for ids in [*held, *(ids for part in parts for ids in part["ids"])]:
            if len(ids):
                waiting.add((list(map(int, ids))[:capacity], None, None))
        rows = []
        while len(waiting) > buffer_size:
            row: list[int] = []
            while len(waiting) and (found := waiting.largest(capacity - len(row))) is not None:
                row += found[0]
            rows.append((key[0], row + [pad] * (capacity - len(row)), len(row)))
        state.update(([waiting.rows[i][0] for i in sorted(waiting.rows)],))
        yield pd.DataFrame(rows, columns=["rank", "ids", "content"])

    return stream.select(F.col(by).cast("long").alias("rank"), "ids").groupBy("rank").applyInPandasWithState(
        step, "rank long, ids array<int>, content int", "held array<array<int>>", "append", GroupStateTimeout.NoTimeout
    )


def once_a_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that overwrites its own batch's folder, so a replay changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def windowed(events: DataFrame, minutes: int = 60, late: str = "2 hours") -> DataFrame:
    """An extension: events by type in tumbling windows, with a watermark for late ones."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes"), "event_type").agg(F.count("*").alias("n"))
