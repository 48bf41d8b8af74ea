"""Packing token sequences into rows of fixed length, best fit first."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import landed

IGNORE = -1


class Buffer:
    """Waiting sequences by (length, arrival): the largest that fits and the shortest, each found by bisection."""

    def __init__(self) -> None:
        self.keys: list[tuple[int, int]] = []
        self.rows: dict[int, tuple] = {}
        self.arrived = 0

    def __len__(self) -> int:
        return len(self.keys)

    def add(self, row: tuple, size: int | None = None) -> None:
        insort(self.keys, (len(row[0]) if size is None else size, self.arrived))
        self.rows[self.arrived] = row
        self.arrived += 1

    def _take(self, i: int) -> tuple:
        return self.rows.pop(self.keys.pop(i)[1])

    def largest(self, room: int) -> tuple | None:
        """The longest row of at most ``room`` tokens, the earliest among equals."""
        end = bisect_right(self.keys, (room, self.arrived))
        if not end:
            return None
        return self._take(bisect_left(self.keys, (self.keys[end - 1][0], -1)))

    def shortest(self) -> tuple:
        return self._take(0)


def place(rows: Iterator[tuple[int, object]], capacity: int, buffer_size: int, refill: int, crop: bool, drain: bool = True) -> Iterator[list[tuple]]:
    """Which of ``(length, tag)`` share a row: lists of ``(tag, ids taken)``.

    ``crop`` fills the rest of a row with the head of the shortest waiting
    sequence and drops its tail; else the rest is padding, and sequences longer
    than a row are cut to it, since they would wait for ever.  The buffer is
    refilled by groups of ``refill`` while it holds fewer than ``buffer_size``.
    ``drain`` packs what is left at the end; without it a row needs a full buffer.
    """
    waiting, open_ = Buffer(), True

    def fill() -> None:
        nonlocal open_
        while open_ and len(waiting) < buffer_size:
            for _ in range(refill):
                row = next(rows, None)
                if row is None:
                    open_ = False
                    break
                size = row[0] if crop else min(row[0], capacity)
                if size:
                    waiting.add((row[1], size), size)

    while True:
        picks, room = [], capacity
        while room:
            fill()
            if not len(waiting) or (not open_ and not drain):
                break
            row = waiting.largest(room)
            if row is None:
                if not crop:
                    break
                row = waiting.shortest()
            picks.append((row[0], min(room, row[1])))
            room -= picks[-1][1]
        if not picks or (crop and room):
            return
        yield picks


def pack(rows: Iterator[tuple], capacity: int, buffer_size: int, refill: int, crop: bool, pad: int, drain: bool = True) -> Iterator[tuple]:
    """Packed rows from ``(ids, mask, name)`` by ``place``: ``ids, mask, content length, names, sizes``.

    ``sizes`` says how many ids of each name the row took.
    """
    for picks in place(((len(row[0]), row) for row in rows), capacity, buffer_size, refill, crop, drain):
        ids = [x for row, n in picks for x in row[0][:n]]
        mask = [x for row, n in picks for x in row[1][:n]]
        rest = capacity - len(ids)
        yield ids + [pad] * rest, mask + [0] * rest, len(ids), [row[2] for row, _ in picks], [n for _, n in picks]


def packed(docs: DataFrame, length: int, by: str = "rank", order: str = "doc_id", crop: bool = True, pad: int = 0, buffer_size: int = 1000, refill: int = 128) -> DataFrame:
    """Rows of ``length`` inputs and targets from ``docs(by, order, ids[, mask])``.

    Ranks are packed on their own, a task each, in the order of ``order``, from
    lengths alone; ids join their rows afterwards, in any task.  A row takes no
    more than its length of a sequence, so only such heads are written and
    joined.  Targets are ``IGNORE`` where the mask is 0 and in the padding.
    """
    capacity, masks = length + 1, ["mask"] if "mask" in docs.columns else []
    whole = F.col("ids").isNotNull() if not masks else F.size("mask") == F.size("ids")
    size = F.when(whole, F.size("ids")).otherwise(F.raise_error(F.lit("ids, and a mask of as many places, are needed")))
    cut = [F.slice(F.col(c).cast(f"array<{kind}>"), 1, capacity).alias(c) for c, kind in (("ids", "int"), ("mask", "boolean")) if c == "ids" or masks]
    heads = landed(docs.select(F.col(by).cast("long").alias("rank"), F.col(order).alias("name"), size.alias("size"), *cut, F.monotonically_increasing_id().alias("at")), "heads")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["rank", "row", "slot", "at", "taken"])

        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
        stream = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        out: list[tuple] = []
        for rank, own in groupby(stream, key=lambda row: row[0]):
            for n, picks in enumerate(place((row[1:] for row in own), capacity, buffer_size, refill, crop)):
                out += [(rank, n, slot, at, taken) for slot, (at, taken) in enumerate(picks)]
                if len(out) >= 10_000:
                    yield rows(out)
                    out = []
        if out:
            yield rows(out)

    ordered = heads.select("rank", "name", "size", "at").repartition("rank").sortWithinPartitions("rank", "name", "at")
    placed = ordered.select("rank", "size", "at").mapInArrow(run, "rank long, row long, slot int, at long, taken int")
    parts = placed.join(heads.select("at", "name", "ids", *masks), "at").groupBy("rank", "row").agg(
        F.sum("taken").cast("int").alias("content"),
        F.sort_array(F.collect_list(F.struct("slot", "name", "taken"))).alias("of"),
        F.sort_array(F.collect_list(F.struct("slot", "taken", "ids", *masks))).alias("parts"),
    )

    def joined(field: str) -> Column:
        return F.flatten(F.transform("parts", lambda p: F.slice(p[field], F.lit(1), p["taken"])))

    parts = parts.withColumns({c: joined(c) for c in ("ids", *masks)})
    targets = F.slice("ids", F.lit(2), F.col("content") - 1)
    if masks:
        targets = F.zip_with(targets, F.slice("mask", F.lit(2), F.col("content") - 1), lambda t, m: F.when(m, t).otherwise(IGNORE))
    rest = capacity - F.col("content")
    return parts.select(
        "rank", "row", F.slice(F.concat("ids", F.array_repeat(F.lit(pad), rest)), 1, length).alias("inputs"),
        F.concat(targets, F.array_repeat(F.lit(IGNORE), rest)).alias("targets"), "content", F.col("of.name").alias("names"), F.col("of.taken").alias("sizes"),
    )


def shifted(ids: Column) -> tuple[Column, Column]:
    """Inputs and next-token targets."""
    n = F.greatest(F.size(ids) - 1, F.lit(0))
    return F.slice(ids, 1, n), F.slice(ids, 2, n)


def masked(targets: Column, mask: Column) -> Column:
    return F.zip_with(targets, mask, lambda t, m: F.when(m == 0, IGNORE).otherwise(t))


def padded(ids: Column, to: Column, pad: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(to - F.size(ids), F.lit(0))))


def left_cropped(ids: Column, most: int) -> Column:
    cut = F.greatest(F.size(ids) - most, F.lit(0))
    return F.slice(ids, cut + 1, F.greatest(F.size(ids), F.lit(1)))
