"""Operator 8: token ids in directly addressable code files.

An id is split into chunks of ``CHUNK_BITS`` bits, lowest first.  Level 0 has a
chunk of every id; a bit of the level's bitmap says that the id goes on in the
next level, and the rank of that bit (ones before it, by a directory of
cumulative counts for each ``RANK_BITS`` bits) is its place there.  So any id
is read with one lookup a level and without decoding a block.

A segment file holds a run of documents in ascending ``doc_id`` order: magic,
version, counts, the documents' offsets, then the levels.  Segments are written
as the binary column of a Parquet dataset through Spark, because a file's path
may be in a store that only Spark's writers and readers reach; the column isn't
compressed, so that a token's bytes lie as they are.  ``token`` reads one id.

Defined results: a null text counts as empty (its one id is the end id); a null
doc_id sorts first; repeated rows are kept, those with one doc_id in text
order; other columns are ignored; an empty table gives no segments.
"""

from __future__ import annotations

import itertools
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow import forget_long, raw_texts, slices, tidy
from .shared import shared_dir

MAGIC = b"DACS"
VERSION = 1
CHUNK_BITS = 8
RANK_BITS = 512
#: Text bytes from which on a segment is closed (at a document's end).
SEGMENT_BYTES = 8 << 20
END_ID = 1
#: Text bytes encoded at once; more words share a call of the library than in the usual slices.
SLICE_BYTES = 4 << 20


def pack(ids: np.ndarray, doc_ends: np.ndarray) -> bytes:
    """A segment's bytes from its ids and the documents' ends."""
    parts, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >= (1 << CHUNK_BITS)
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-max(1, len(more)) // RANK_BITS) * (RANK_BITS // 8), dtype=np.uint8)
        padded[: len(bits)] = bits
        ones = np.unpackbits(padded.reshape(-1, RANK_BITS // 8), axis=1).sum(axis=1)
        ranks = np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4")
        parts.append(struct.pack("<III", len(rest), len(padded), len(ranks)) + (rest & 0xFF).astype(np.uint8).tobytes() + padded.tobytes() + ranks.tobytes())
        if not more.any():
            break
        rest = rest[more] >> CHUNK_BITS
    return MAGIC + struct.pack("<BBII", VERSION, len(parts), len(doc_ends), len(ids)) + doc_ends.astype("<u4").tobytes() + b"".join(parts)


class Segment:
    """A packed segment, opened without decoding it."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != MAGIC:
            raise ValueError("not a segment")
        version, levels, n_docs, self.n_ids = struct.unpack_from("<BBII", data, 4)
        if version != VERSION:
            raise ValueError(f"version {version}")
        at = 4 + struct.calcsize("<BBII")
        self.doc_ends = np.frombuffer(data, "<u4", n_docs, at)
        at += 4 * n_docs
        self.levels = []
        for _ in range(levels):
            n, n_bits, n_ranks = struct.unpack_from("<III", data, at)
            at += 12
            chunks = np.frombuffer(data, np.uint8, n, at)
            bits = np.frombuffer(data, np.uint8, n_bits, at + n)
            self.levels.append((chunks, bits, np.frombuffer(data, "<u4", n_ranks, at + n + n_bits)))
            at += n + n_bits + 4 * n_ranks

    def __getitem__(self, i: int) -> int:
        """Id ``i`` by one lookup a level."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK_BITS * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            first = block * (RANK_BITS // 8)
            before = int.from_bytes(bits[first : (i >> 3) + 1].tobytes(), "little") & ((1 << (i - block * RANK_BITS)) - 1)
            i = int(ranks[block]) + before.bit_count()
        return value

    def ids(self) -> np.ndarray:
        """All ids."""
        value = np.zeros(self.n_ids, dtype=np.uint32)
        where = np.arange(self.n_ids)
        for level, (chunks, bits, _) in enumerate(self.levels):
            value[where] |= chunks.astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            where = where[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return value


class WordEncoder:
    """Ids by the tokenizers library, one white-space-separated chunk at a time.

    The tokenizer's normaliser, splitter and merges never look across ASCII
    white space, so chunks can be encoded once and remembered.  Two more
    equalities make chunks repeat: the normaliser lower-cases, so A-Z may be
    lower-cased first (not in texts that could hold a special token), and its
    splitter cuts between a letter and punctuation other than an apostrophe.
    New chunks that are one Latin word each are encoded many to a call; every
    word ends with the only piece that carries the word-end mark.
    """

    #: Chunks remembered by a worker.
    LIMIT = 800_000
    WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u024f]+")
    BOUNDARY = re.compile(rb"(?<=[a-z])(?=[!-&(-/:-@\[-`{-~])")
    WORD_END = "</w>"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith(self.WORD_END)]] = True
        self.known: dict[bytes, bytes] = {}

    def chunks(self, text: bytes) -> list[bytes]:
        if b"<|" in text:
            return text.split()
        return self.BOUNDARY.sub(b" ", text.lower()).split()

    def learn(self, new: list[bytes]) -> None:
        words, others = [], []
        for x in new:
            (words if x.isalpha() or self.WORD.fullmatch(x.decode("utf-8", "replace")) else others).append(x)
        for i in range(0, len(words), 2_000):
            part = words[i : i + 2_000]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                others += part
                continue
            packed, ends = ids.tobytes(), (4 * cuts).tolist()
            self.known.update(zip(part, map(packed.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
        for i in range(0, len(others), 5_000):
            part = others[i : i + 5_000]
            for x, got in zip(part, self.tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in part], add_special_tokens=False), strict=True):
                self.known[x] = np.array(got.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed little-endian unsigned 32-bit ids of each text."""
        forget_long(self.known, self.LIMIT, 10)
        cut = [self.chunks(t) for t in texts]
        flat = list(itertools.chain.from_iterable(cut))
        found = list(map(self.known.get, flat))
        missed = [i for i, x in enumerate(found) if x is None]
        self.learn(list({flat[i] for i in missed}))
        for i in missed:
            found[i] = self.known[flat[i]]
        ends = itertools.accumulate(map(len, cut))
        return [b"".join(found[b - len(words) : b]) for words, b in zip(cut, ends, strict=True)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write(docs: DataFrame, path: str, out: str, end_id: int = END_ID) -> None:
    """Write the segments of ``docs(doc_id, text)`` to the Parquet dataset ``out``.

    Rows are ``segment, doc_ids, n_ids, data``; ``segment`` numbers follow
    ``doc_id``.  One range exchange by ``(doc_id, text digest)`` orders the
    documents; equal doc_ids may be split over tasks without losing order.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    tail = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, serial = TaskContext.get().partitionId(), itertools.count()
        ids: list[bytes] = []
        names: list = []
        size = 0

        def close() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(ids), dtype="<u4")
            ends = np.cumsum([len(x) // 4 for x in ids])
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + next(serial)], pa.int64()), pa.array([names], pa.list_(doc_type)), pa.array([len(flat)], pa.int64()), pa.array([pack(flat, ends)], pa.binary())],
                ["segment", "doc_ids", "n_ids", "data"],
            )

        doc_type = None
        for batch in batches:
            doc_type = batch.column("doc_id").type
            for part in slices(batch, "text", SLICE_BYTES):
                texts = raw_texts(part.column("text"))
                for name, raw, coded in zip(part.column("doc_id").to_pylist(), texts, encoder(path).encode(texts), strict=True):
                    ids.append(coded + tail)
                    names.append(name)
                    size += len(raw) + 16
                    if size >= SEGMENT_BYTES:
                        yield close()
                        ids, names, size = [], [], 0
        if ids:
            yield close()

    ordered = docs.select("doc_id", F.col("text").cast("string").alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(tidy(run), f"segment bigint, doc_ids array<{kind}>, n_ids bigint, data binary").write.mode("overwrite").option("compression", "none").parquet(out)


def read(spark: SparkSession, out: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``.

    Running totals are over one small row a segment within a writing task, and
    one a task above them, not over documents.
    """
    files = spark.read.parquet(out)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    earlier = lambda order: order.rowsBetween(Window.unboundedPreceding, -1)
    sizes = files.select("segment", "n_ids", F.shiftright("segment", 32).alias("task"))
    tasks = sizes.groupBy("task").agg(F.sum("n_ids").alias("n")).select("task", F.coalesce(F.sum("n").over(earlier(Window.orderBy("task"))), F.lit(0)).alias("below"))
    own = sizes.select("segment", "task", F.coalesce(F.sum("n_ids").over(earlier(Window.partitionBy("task").orderBy("segment"))), F.lit(0)).alias("own"))
    bases = own.join(tasks, "task").select("segment", (F.col("own") + F.col("below")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                segment, names = batch.column("segment")[i].as_py(), batch.column("doc_ids")[i].values
                opened = Segment(batch.column("data")[i].as_py())
                raw = memoryview(opened.ids().astype("<u4").tobytes())
                ends = opened.doc_ends.astype(np.int64)
                starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([segment] * len(names), pa.int64()), names, pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64())],
                    ["segment", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    rows = files.select("segment", "doc_ids", "data").mapInArrow(tidy(run), f"segment bigint, doc_id {kind}, at bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(bases, "segment").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token(spark: SparkSession, out: str, doc_id: object, k: int) -> int | None:
    """Id ``k`` of the first document with ``doc_id``, looked up in its segment alone; None where there is none."""
    files = spark.read.parquet(out)
    places = files.select("segment", F.array_position("doc_ids", doc_id).alias("at")).filter("at > 0").orderBy("segment").limit(1).collect()
    if not places or k < 0:
        return None
    at = places[0].at - 1
    segment = Segment(files.filter(F.col("segment") == places[0].segment).select("data").first().data)
    start = int(segment.doc_ends[at - 1]) if at else 0
    return int(segment[start + k]) if start + k < int(segment.doc_ends[at]) else None


def round_trip(spark: SparkSession, docs: DataFrame, path: str, out: str | None = None) -> DataFrame:
    """Write the files (to a fresh shared folder unless ``out`` is given), then read them back."""
    out = out or f"{shared_dir(spark)}/dac-{uuid.uuid4().hex}"
    write(docs, path, out)
    return read(spark, out)
