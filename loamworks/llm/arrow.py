"""Arrow-batch helpers shared by the Python-side operators.

Every helper works on whole texts.  Memory stays bounded because batches are
re-cut by bytes and every per-worker cache has an entry limit; a cache only
saves time, it never changes a result.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at once; one longer text is handled on its own.
SLICE_BYTES = 1 << 20
#: Entries of a per-worker cache before it is emptied.
CACHE_ENTRIES = 150_000


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds at most about ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, giving its memory back when a task ends: workers live on and serve other operators."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return tidied


def map_text(
    docs: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
    columns: Iterable[str] = ("doc_id", "text"),
    text: str = "text",
) -> DataFrame:
    """One pass over ``columns``; ``make()`` runs once a task and returns the batch function."""
    kept = [F.col(c).cast("string").alias(c) if c == text else F.col(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, text):
                yield work(part)

    return docs.select(*kept).mapInArrow(tidy(run), schema)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


class Bounded(dict):
    """A dict that computes missing entries and is emptied when it grows past its limit.

    Emptying happens in ``trim``, which callers run between batches, so entries
    stay valid while a batch is worked on.
    """

    def __init__(self, compute: Callable, limit: int = CACHE_ENTRIES) -> None:
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self[key] = self.compute(key)
        return value

    def trim(self) -> None:
        forget_long(self, self.limit)


def forget_long(known: dict, limit: int, length: int = 9) -> None:
    """Empty a full cache but for its short keys, which come again most often."""
    if len(known) > limit:
        short = {k: v for k, v in known.items() if len(k) <= length}
        known.clear()
        if len(short) <= limit // 2:
            known.update(short)
