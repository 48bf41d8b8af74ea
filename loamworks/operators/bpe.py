"""Byte-pair vocabularies: distributed word counts, a merge loop, encoding and statistics."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import discard, landed, written

#: Bytes of distinct words up to which the driver merges; more are merged by rounds of tasks.
DRIVER_BYTES = 1_000_000
#: Symbols of a chunk of words and bytes of words of a task; below so many symbols, a table holds the counts of all pairs.
CHUNK, TASK_BYTES, DENSE = 1 << 18, 1 << 24, 2_048
#: Pairs that the driver sees in a round, and rounds after which the merged words are written.
MOST_PAIRS, ROUNDS = 4_096, 8

# Fixed value: the split pattern of texts into words to be merged.
SPLIT = r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""


def pretokens(text: Column, pattern: str = SPLIT) -> Column:
    """Pieces of a text; put together they are the text."""
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))


def word_counts(docs: DataFrame, text: str = "text", pattern: str = SPLIT) -> DataFrame:
    """``word, n`` over all documents, combined before the shuffle."""
    return docs.select(F.explode_outer(pretokens(F.col(text), pattern)).alias("word")).filter("word is not null").groupBy("word").agg(F.count("*").alias("n"))


def pair_counts(words: DataFrame) -> DataFrame:
    """``left, right, n`` of adjacent bytes (as hex) over ``word, n``."""
    hexed = F.hex(F.encode("word", "utf-8"))
    last = F.octet_length("word") - 2
    pairs = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(hexed, i * 2 + 1, F.lit(4))))
    each = words.select(F.explode_outer(pairs).alias("pair"), "n").filter("pair is not null")
    return each.groupBy(F.substring("pair", 1, 2).alias("left"), F.substring("pair", 3, 2).alias("right")).agg(F.sum("n").alias("n"))


def learn_merges(counts: Mapping[bytes, int] | Iterable[tuple[bytes, int]], n_merges: int) -> list[tuple[bytes, bytes]]:
    """The most frequent pair again and again; ties go to the pair first in byte order."""
    words = [([bytes([b]) for b in w], n) for w, n in (counts.items() if isinstance(counts, Mapping) else counts)]
    total: dict[tuple[bytes, bytes], int] = defaultdict(int)
    where: dict[tuple[bytes, bytes], set[int]] = defaultdict(set)
    for i, (parts, n) in enumerate(words):
        for pair in zip(parts, parts[1:], strict=False):
            total[pair] += n
            where[pair].add(i)
    heap = [(-n, pair) for pair, n in total.items()]
    heapq.heapify(heap)
    merges: list[tuple[bytes, bytes]] = []
    while heap and len(merges) < n_merges:
        n, pair = heapq.heappop(heap)
        if total.get(pair, 0) != -n or n == 0:
            continue
        merges.append(pair)
        touched = set()
        for i in where.pop(pair):
            parts, weight = words[i]
            new, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and (parts[k], parts[k + 1]) == pair:
                    new.append(parts[k] + parts[k + 1])
                    k += 2
                else:
                    new.append(parts[k])
                    k += 1
            for p in zip(parts, parts[1:], strict=False):
                total[p] -= weight
                touched.add(p)
            for p in zip(new, new[1:], strict=False):
                total[p] += weight
                where[p].add(i)
                touched.add(p)
            words[i] = (new, weight)
        total.pop(pair, None)
        for p in touched - {pair}:
            if total[p] > 0:
                heapq.heappush(heap, (-total[p], p))
    return merges


def certain(pairs: Sequence[tuple[bytes, bytes, int]], most: int, known: Iterable[bytes]) -> list[tuple[bytes, bytes]]:
    """The next merges, ``most`` at most, as far as the counts of ``pairs``, most frequent first, settle them.

    A merge lowers the counts of pairs that end in its left or begin with its
    right symbol; a new pair stands where one of these stood, so none is more
    frequent.  Up to the first of these all others are in place.  A merge whose
    bytes are ``known`` adds to an old symbol's pairs, and one of a symbol with
    itself makes pairs of its own: nothing is certain beyond these.
    """
    floor = pairs[-1][2] if len(pairs) >= MOST_PAIRS else 0  # unseen pairs may be as frequent
    chosen: list[tuple[bytes, bytes]] = []
    known, lefts, rights = set(known), set(), set()
    for i, (left, right, n) in enumerate(pairs):
        if len(chosen) == most:
            break
        if chosen:
            same = i
            while same < len(pairs) and pairs[same][2] == n and not (pairs[same][0] in rights or pairs[same][1] in lefts):
                same += 1
            if n <= floor or (same < len(pairs) and pairs[same][2] == n):
                break
        chosen.append((left, right))
        if left == right or left + right in known:
            break
        known.add(left + right)
        lefts.add(left)
        rights.add(right)
    return chosen


def _merged(parts: np.ndarray, merges: Iterable[tuple[int, int, int]]) -> np.ndarray:
    """``parts`` after merges ``left, right, new`` that nowhere overlap each other."""
    gone = []
    for left, right, new in merges:
        at = np.flatnonzero((parts[:-1] == left) & (parts[1:] == right))
        if left == right and len(at):  # in a run, every second place from its start
            start = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, at, 0))
            at = at[(at - start) % 2 == 0]
        if len(at):
            if not gone:
                parts = parts.copy()
            parts[at] = new
            gone.append(at + 1)
    return np.delete(parts, np.concatenate(gone)) if gone else parts


def _open(parts: np.ndarray, weights: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Without the words of one symbol, in which nothing is left to merge."""
    sizes = np.diff(np.flatnonzero(parts == end), prepend=-1)
    return parts[np.repeat(sizes > 2, sizes)], weights[sizes > 2]


def _kind(end: int) -> type:
    return np.uint16 if end < 1 << 16 else np.uint32


def _chunks(words: DataFrame, end: int) -> DataFrame:
    """``word, n`` with many words a row: ``parts`` has their bytes as symbols, each word closed by ``end``, ``weights`` their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def row() -> pa.RecordBatch:
            blobs = [np.concatenate(x).tobytes() for x in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in blobs], names=["parts", "weights"])

        for batch in batches:
            sizes = pc.binary_length(batch.column(0)).to_numpy().astype(np.int64)
            parts = np.full(sizes.sum() + len(sizes), end, _kind(end))
            parts[np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)), sizes)] = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8)
            held.append((parts, batch.column(1).to_numpy()))
            if sum(len(p) for p, _ in held) >= CHUNK:
                yield row()
                held = []
        if held:
            yield row()

    return words.select(F.encode("word", "utf-8"), F.col("n").cast("long")).mapInArrow(run, "parts binary, weights binary")


def _chunked(batches: Iterator[pa.RecordBatch], rounds: list[list[tuple[int, int, int]]], end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Symbols and counts of each chunk after the merges of ``rounds``."""
    for batch in batches:
        for blob, counts in zip(batch.column(0), batch.column(1), strict=True):
            parts = np.frombuffer(blob.as_buffer(), _kind(end))
            for merges in rounds:
                parts = _merged(parts, merges)
            yield parts, np.frombuffer(counts.as_buffer(), np.int64)


def _advanced(chunks: DataFrame, rounds: list[list[tuple[int, int, int]]], end: int) -> DataFrame:
    """``chunks`` after the merges of ``rounds``, without words that are done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, weights in _chunked(batches, rounds, end):
            blobs = [x.tobytes() for x in _open(parts, weights, end)]
            if blobs[0]:
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in blobs], names=["parts", "weights"])

    return chunks.mapInArrow(run, chunks.schema)


def _pairs(chunks: DataFrame, rounds: list[list[tuple[int, int, int]]], pieces: list[bytes], end: int) -> DataFrame:
    """``left, right, n`` of adjacent symbols, by their bytes, after the merges of ``rounds``."""
    side = end + 1

    def rows(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        inside = (codes // side != end) & (codes % side != end)
        left, right = ([pieces[i] for i in x[inside].tolist()] for x in (codes // side, codes % side))
        return pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(n[inside].astype(np.int64))], names=["left", "right", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(side * side if side <= DENSE else 0)
        for parts, weights in _chunked(batches, rounds, end):
            codes = parts[:-1].astype(np.int64) * side + parts[1:]
            n = weights[np.cumsum(parts == end)[:-1]]
            if side <= DENSE:
                total += np.bincount(codes, n, side * side)
            else:
                codes, at = np.unique(codes, return_inverse=True)
                yield rows(codes, np.bincount(at, n))
        if side <= DENSE:
            codes = np.flatnonzero(total)
            yield rows(codes, total[codes])

    return chunks.mapInArrow(run, "left binary, right binary, n long").groupBy("left", "right").agg(F.sum("n").alias("n"))


def merges_by_rounds(words: DataFrame, n_merges: int) -> list[tuple[bytes, bytes]]:
    """The merges of ``learn_merges`` over ``word, n`` that stay with the executors.

    Each round counts the pairs of all words and takes the merges that these
    counts settle; the driver sees ``MOST_PAIRS`` of them and the vocabulary.
    """
    spark, end, before = words.sparkSession, 256 + n_merges, written()
    size = words.agg(F.sum(F.octet_length("word"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    chunks = landed(_chunks(words.repartition(tasks, "word"), end), "parts")
    ids = {bytes([i]): i for i in range(256)}
    merges: list[tuple[bytes, bytes]] = []
    rounds: list[list[tuple[int, int, int]]] = []
    while len(merges) < n_merges:
        top = _pairs(chunks, rounds, list(ids), end).orderBy(F.desc("n"), "left", "right").limit(MOST_PAIRS).collect()
        found = certain([(bytes(r["left"]), bytes(r["right"]), r["n"]) for r in top], n_merges - len(merges), ids)
        if not found:
            break
        merges += found
        rounds.append([(ids[left], ids[right], ids.setdefault(left + right, len(ids))) for left, right in found])
        if len(rounds) == ROUNDS:
            chunks = landed(_advanced(chunks, rounds, end), "parts")
            discard(spark, before, keep=1)
            rounds = []
    discard(spark, before)
    return merges


def train(docs: DataFrame, vocab_size: int, specials: Iterable[str] = (), text: str = "text", least: int = 1) -> dict[bytes, int]:
    """Ranks of a vocabulary of ``vocab_size`` with room for ``specials``.

    Counting is distributed.  Distinct words seen at least ``least`` times are
    merged on the driver up to ``DRIVER_BYTES``, beyond by rounds of tasks.
    """
    n_merges = vocab_size - 256 - len(list(specials))
    if n_merges < 0:
        raise ValueError("a vocabulary needs 256 bytes and its special tokens")
    spark, before = docs.sparkSession, written()
    counts = landed(word_counts(docs, text).filter(F.col("n") >= least), "words")
    if (counts.agg(F.sum(F.octet_length("word"))).first()[0] or 0) > DRIVER_BYTES:
        merges = merges_by_rounds(counts, n_merges)
    else:
        rows = counts.orderBy("word").toLocalIterator()
        merges = learn_merges([(r["word"].encode(), r["n"]) for r in rows], n_merges)
    discard(spark, before)
    ranks = {bytes([i]): i for i in range(256)}
    for left, right in merges:
        ranks.setdefault(left + right, len(ranks))
    return ranks


def vocabulary(spark, ranks: Mapping[bytes, int], specials: Iterable[str] = ()) -> DataFrame:
    """``token_id, bytes, is_special, n_bytes``; special tokens follow and have 0 bytes."""
    rows = [(i, piece, False, len(piece)) for piece, i in ranks.items()]
    rows += [(len(ranks) + k, s.encode(), True, 0) for k, s in enumerate(specials)]
    return spark.createDataFrame(rows, "token_id int, bytes binary, is_special boolean, n_bytes int")


def special_ids(specials: Iterable[str], n_ranks: int) -> dict[str, int]:
    """Ids of special tokens, which follow the ranks."""
    return {s: n_ranks + i for i, s in enumerate(specials)}


def token_id(mark: int | str, ranks: Mapping[bytes, int], specials: Iterable[str] = ()) -> int:
    """An id as it is; a name's id among the special tokens, else among the ranks."""
    if isinstance(mark, int):
        return mark
    named = special_ids(specials, len(ranks))
    return named[mark] if mark in named else ranks[mark.encode()]


def encoded(
    docs: DataFrame, ranks: Mapping[bytes, int], text: str = "text", pattern: str = SPLIT,
    prepend: int | str | None = None, append: int | str | None = None, specials: Iterable[str] = (),
) -> DataFrame:
    """``docs`` with ``ids``, by Arrow batches; the coder is built once a task.

    Special tokens inside texts are plain text; those to ``prepend`` and
    ``append`` are given by id or name.  A null text has these alone.
    """
    import tiktoken

    specials = list(specials)
    head, tail = ([] if mark is None else [token_id(mark, ranks, specials)] for mark in (prepend, append))

    shared = docs.sparkSession.sparkContext.broadcast(dict(ranks))  # a vocabulary is bounded

    @F.pandas_udf("array<int>")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        for texts in parts:
            yield texts.map(lambda t: head + coder.encode_ordinary(t or "") + tail)

    return docs.withColumn("ids", encode(F.col(text)))


def byte_ids(text: Column, *before: int) -> Column:
    """The bytes of a text as ids after the given ones; of a null text these alone."""
    head = np.array(before, dtype=np.int32)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: np.append(head, np.frombuffer((t or "").encode(), dtype=np.uint8)).astype(np.int32))

    return ids(text)


def decoded(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", ids: str = "ids", with_specials: bool = False) -> DataFrame:
    """``key, text`` of id arrays, by Arrow batches and without a shuffle; unknown and, unless asked for, special tokens are left out.

    Bytes that are no UTF-8 become U+FFFD.  The vocabulary is read on the driver, as it is bounded.
    """
    wanted = vocab if with_specials else vocab.filter(~F.col("is_special"))
    rows = wanted.select("token_id", "bytes").collect()
    shared = docs.sparkSession.sparkContext.broadcast({r["token_id"]: bytes(r["bytes"]) for r in rows})

    @F.pandas_udf("string")
    def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        piece = shared.value.get
        for part in parts:
            yield part.map(lambda x: "" if x is None else b"".join([piece(i, b"") for i in x]).decode("utf-8", "replace"))

    return docs.select(key, text(F.col(ids)).alias("text"))


def compression(docs: DataFrame, by: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``by, n_bytes, n_tokens, ratio``: bytes a token."""
    sums = docs.groupBy(by).agg(F.sum(F.octet_length(text)).alias("n_bytes"), F.sum(F.size(ids)).alias("n_tokens"))
    return sums.withColumn("ratio", F.try_divide("n_bytes", "n_tokens"))


def save(vocab: DataFrame, path: str) -> None:
    """A vocabulary as a Parquet table."""
    vocab.coalesce(1).write.mode("overwrite").parquet(path)


def load(spark, path: str) -> tuple[dict[bytes, int], list[str]]:
    """Ranks and special tokens of a saved vocabulary."""
    rows = spark.read.parquet(path).orderBy("token_id").collect()  # a vocabulary is bounded
    return {bytes(r["bytes"]): r["token_id"] for r in rows if not r["is_special"]}, [bytes(r["bytes"]).decode() for r in rows if r["is_special"]]


def start_token(specials: Iterable[str], n_ranks: int) -> int:
    """The id of ``<|bos|>``, else of ``<|endoftext|>``."""
    ids = special_ids(specials, n_ranks)
    for name in ("<|bos|>", "<|endoftext|>"):
        if name in ids:
            return ids[name]
    raise KeyError("no token that starts documents")
