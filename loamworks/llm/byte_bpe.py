"""Operator 6: byte-level BPE encoding and decoding by DuckDB recursive queries.

Each Python worker holds one in-memory DuckDB connection with two tables: the
vocabulary ``(id, piece)`` and the merge table ``(l, r, m)``, which has every
split of a piece into two pieces.  New pre-tokens of a slice of texts become
token-position rows, cut where two bytes stand side by side in no piece, since
no merge can cross that place; a recursive query joins adjacent tokens with the
merge table and contracts each stretch's leftmost minimum-rank pair until no
pair is left.  A worker keeps the ids of the words it met last, since most words
come again.  Decoding joins ids with the vocabulary and aggregates pieces in
order.

Both recursive queries keep only the newest state of a row (``USING KEY``), so
memory is that of one round, however many rounds there are.  Stretches of over
``LONG`` bytes take the second query: it contracts all occurrences of the
minimum-rank pair in one round, left to right, up to the first that makes a pair
of lower rank with a neighbour, which then comes first.  The ids are the same.

Defined results: a null text counts as empty (no ids); repeated rows give
repeated results; a null doc_id is carried through; other columns are ignored.
Memory grows with the longest stretch alone, by at most ``BYTES_A_BYTE``.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Callable
from itertools import pairwise

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import map_text, tidy

#: Bytes from which on a stretch takes the query for long ones.
LONG = 192
#: Bytes of new words contracted by one call; one longer word is a call of its own.
BYTES_A_QUERY = 200_000
#: A worker's limit for DuckDB, and what a byte of a stretch may take: one of over 500 KB raises the limit.
MEMORY_MB, BYTES_A_BYTE = 300, 600
#: Bytes of the words and ids that a worker keeps, and what an entry takes beside them; a slice's own words come on top.
KEPT_BYTES, ENTRY_BYTES = 48 << 20, 64
#: Token rows decoded by one query.
ROWS_A_DECODE = 300_000

#: ``n`` is the stretch's number of tokens: rows of an older, longer state aren't read.
SHORT_SQL = """
WITH RECURSIVE bpe(w, pos, tok, nxt, n) USING KEY (w, pos) AS (
    SELECT w, pos, tok, nxt, n FROM start
    UNION ALL
    SELECT b.w,
           CASE WHEN b.pos > best.p THEN b.pos - 1 ELSE b.pos END,
           CASE WHEN b.pos = best.p + 1 THEN best.m ELSE b.tok END,
           CASE WHEN b.pos = best.p - 1 THEN best.m ELSE b.nxt END,
           b.n - 1
    FROM bpe b
    JOIN (SELECT w, min(m) AS m, arg_min(pos, m::BIGINT * 4294967296 + pos) AS p
          FROM bpe JOIN merges ON l = tok AND r = nxt GROUP BY w) best ON b.w = best.w
    WHERE b.pos <> best.p)
SELECT w, tok FROM bpe SEMI JOIN (SELECT w, n FROM bpe WHERE pos = 0) USING (w, n) ORDER BY w, pos
"""

#: ``after`` is the place of the next token, ``nxt`` that token, ``m`` the pair's rank; -1 marks a token that is gone.
#: Of pairs that overlap every second is free; ``stop`` is the first that makes a pair of lower rank.
LONG_SQL = """
WITH RECURSIVE bpe(w, pos, tok, after, nxt, m) USING KEY (w, pos) AS (
    SELECT w, pos, tok, pos + 1, nxt, m FROM start LEFT JOIN merges ON l = tok AND r = nxt
    UNION ALL
    (WITH found AS (
        SELECT b.w, b.pos, b.after, b.m, lag(b.after) OVER o IS DISTINCT FROM b.pos AS fresh, row_number() OVER o AS k
        FROM recurring.bpe b
        JOIN (SELECT w, min(m) AS m FROM recurring.bpe WHERE tok >= 0 GROUP BY w) best ON b.w = best.w AND b.m = best.m
        WHERE b.tok >= 0 WINDOW o AS (PARTITION BY b.w ORDER BY b.pos)),
    placed AS (SELECT *, k - max(CASE WHEN fresh THEN k END) OVER (PARTITION BY w ORDER BY pos) AS nth FROM found),
    free AS (SELECT w, pos AS p, after AS q, m FROM placed WHERE nth % 2 = 0),
    near AS (
        SELECT f.w, f.p, f.q, f.m, b.after AS next, b.nxt, a.pos AS before, CASE WHEN d.q IS NULL THEN a.tok ELSE f.m END AS tok, d.q IS NULL AS open
        FROM free f JOIN recurring.bpe b ON b.w = f.w AND b.pos = f.q
        LEFT JOIN (SELECT * FROM recurring.bpe WHERE tok >= 0) a ON a.w = f.w AND a.after = f.p
        LEFT JOIN free d ON d.w = f.w AND d.q = a.pos),
    stop AS (
        SELECT w, min(p) AS last FROM (
            SELECT w, p FROM near JOIN lower ON lower.l = near.tok AND lower.r = near.m AND lower.m < near.m
            UNION ALL
            SELECT w, p FROM near JOIN lower ON lower.l = near.m AND lower.r = near.nxt AND lower.m < near.m) GROUP BY w),
    pick AS (SELECT near.* FROM near LEFT JOIN stop USING (w) WHERE p <= coalesce(last, p)),
    changed AS (
        SELECT x.w, x.p AS pos, x.m AS tok, x.next AS after, CASE WHEN n.p IS NULL THEN x.nxt ELSE n.m END AS nxt
        FROM pick x LEFT JOIN pick n ON n.w = x.w AND n.p = x.next
        UNION ALL
        SELECT w, before, tok, p, m FROM pick WHERE open AND before IS NOT NULL)
    SELECT w, pos, tok, after, nxt, merges.m FROM changed LEFT JOIN merges ON l = tok AND r = nxt
    UNION ALL
    SELECT w, q, -1, -1, -1, NULL FROM pick))
SELECT w, tok FROM bpe WHERE tok >= 0 ORDER BY w, pos
"""

DECODE_SQL = """
SELECT list(piece ORDER BY pos) AS pieces
FROM tokens JOIN vocab USING (id)
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """Encoder and decoder of one worker; ``path`` names a rank file that every machine has."""

    def __init__(self, path: str, pattern: str) -> None:
        from .trie_counts import splitter  # which imports this module

        self.ranks = read_ranks(path)
        self.split = splitter(pattern)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        merges = [
            (left, right, rank)
            for piece, rank in self.ranks.items()
            for i in range(1, len(piece))
            if (left := self.ranks.get(piece[:i])) is not None and (right := self.ranks.get(piece[i:])) is not None
        ]
        #: Whether two bytes stand side by side in some piece.
        self.joins = np.zeros((256, 256), dtype=bool)
        for piece in self.ranks:
            self.joins[list(piece[:-1]), list(piece[1:])] = True
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": f"{MEMORY_MB}MB", "temp_directory": ""})
        l, r, m = (pa.array(x, pa.int32()) for x in zip(*merges, strict=True)) if merges else (pa.array([], pa.int32()),) * 3
        for name, table in (
            ("merges", pa.table({"l": l, "r": r, "m": m})),
            ("vocab", pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "piece": pa.array(self.ranks.keys(), pa.binary())})),
        ):
            self.con.register("given", table)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.con.unregister("given")
        self.con.execute("CREATE TABLE lower AS SELECT * FROM merges WHERE m < greatest(l, r)")
        #: Packed ids of the words met last, those of the time before, and the bytes of the former.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def ask(self, sql: str, name: str, table: pa.Table) -> pa.Table:
        self.con.register(name, table)
        try:
            return self.con.sql(sql).to_arrow_table()
        finally:
            self.con.unregister(name)

    def contract(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each non-empty word, by the recursive queries."""
        lengths = np.array([len(x) for x in words])
        ends = np.cumsum(lengths)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        first = np.zeros(len(raw), dtype=bool)
        first[ends - lengths] = True
        first[1:] |= ~self.joins[raw[:-1], raw[1:]]
        at = np.flatnonzero(first)
        size = np.diff(np.append(at, len(raw))).astype(np.int32)
        w = np.repeat(np.arange(len(at), dtype=np.int32), size)
        tok = self.byte_ids[raw]
        nxt = np.append(tok[1:], np.int32(-1))
        nxt[at + size - 1] = -1
        start = pa.table({"w": w, "pos": (np.arange(len(raw)) - at[w]).astype(np.int32), "tok": tok, "nxt": nxt, "n": size[w]})
        found = []
        for sql, own in ((SHORT_SQL, size[w] <= LONG), (LONG_SQL, size[w] > LONG)):
            if own.any():
                self.con.execute(f"SET memory_limit = '{max(MEMORY_MB, BYTES_A_BYTE * int(own.sum()) >> 20)}MB'")
                out = self.ask(sql, "start", start if own.all() else start.filter(pa.array(own)))
                found.append((out["w"].to_numpy(), out["tok"].to_numpy().astype("<u4")))
        where, ids = found[0]
        if len(found) > 1:
            where, ids = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(where, kind="stable")
            where, ids = where[order], ids[order]
        marks = 4 * np.append(np.searchsorted(where, w[ends - lengths]), len(ids))
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True)]

    def keep(self, word: str, ids: bytes) -> None:
        self.known[word] = ids
        self.held += ENTRY_BYTES + sys.getsizeof(word) + sys.getsizeof(ids)

    def recall(self, words: set[str]) -> None:
        """Have the ids of all ``words`` in the cache; the older half of a full one goes, but for words that come again."""
        if self.held > KEPT_BYTES // 2:
            self.known, self.older, self.held = {}, self.known, 0
        new = []
        for word in words.difference(self.known):
            ids = self.older.get(word)
            if ids is None:
                new.append(word)
            else:
                self.keep(word, ids)
        self.learn(new)

    def learn(self, words: list[str]) -> None:
        """Put packed ids of new words into the cache; whole words that are pieces need no merge."""
        fresh: list[tuple[str, bytes]] = []
        total = 0
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(raw)
            if rank is not None:
                self.keep(word, rank.to_bytes(4, "little"))
                continue
            if fresh and total + len(raw) > BYTES_A_QUERY:
                self._learn(fresh)
                fresh, total = [], 0
            fresh.append((word, raw))
            total += len(raw)
        if fresh:
            self._learn(fresh)

    def _learn(self, fresh: list[tuple[str, bytes]]) -> None:
        for (word, _), ids in zip(fresh, self.contract([raw for _, raw in fresh]), strict=True):
            self.keep(word, ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian unsigned 32-bit ids of each text."""
        cut = [self.split(t) for t in texts]
        self.recall(set().union(*cut))
        return [b"".join(map(self.known.__getitem__, words)) for words in cut]

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """Bytes of each id sequence; unknown ids raise, since they would lose text."""
        ends = np.cumsum([len(x) // 4 for x in packed], dtype=np.int64)
        ids = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
        #: Where the bytes of each sequence end.
        marks = np.zeros(len(packed), dtype=np.int64)
        parts, total = [], 0
        for i in range(0, len(ids), ROWS_A_DECODE):
            data, offsets = self._decoded(ids[i : i + ROWS_A_DECODE])
            a, b = np.searchsorted(ends, [i, i + len(offsets) - 1], "right")
            marks[a:b] = total + offsets[ends[a:b] - i]
            parts.append(data)
            total += len(data)
        flat = b"".join(parts)
        return [flat[a:b] for a, b in pairwise([0, *marks.tolist()])]

    def _decoded(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ``ids`` and where those of each begin, with their end."""
        got = self.ask(DECODE_SQL, "tokens", pa.table({"pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
        values = got["pieces"].combine_chunks().flatten()
        if len(values) != len(ids):
            raise ValueError("an id is not in the vocabulary")
        big = pa.types.is_large_binary(values.type)
        _, offsets, data = values.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64 if big else np.int32)[values.offset : values.offset + len(values) + 1]
        return bytes(memoryview(data)[offsets[0] : offsets[-1]]), offsets - offsets[0]


#: Codecs of this worker process, by vocabulary path and pattern.
_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec, built once a process."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _worker(path: str, pattern: str, work: Callable[[Codec, pa.RecordBatch], pa.RecordBatch]) -> Callable:
    return lambda: lambda batch: work(codec(path, pattern), batch)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids binary``: the packed ids of each whole text."""

    def work(c: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x or "" for x in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(c.encode(texts), pa.binary())], ["doc_id", "ids"])

    return map_text(docs, _worker(path, pattern, work), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, text`` of packed ids (``doc_id, ids``); bytes that are no UTF-8 become U+FFFD."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = codec(path, pattern).decode([x or b"" for x in batch.column("ids").to_pylist()])
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.decode("utf-8", "replace") for x in found])], ["doc_id", "text"])

        return work

    def run(batches):
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield work(batch.slice(at, 500))

    return coded.select("doc_id", "ids").mapInArrow(tidy(run), f"doc_id {coded.schema['doc_id'].dataType.simpleString()}, text string")


def digest(docs: DataFrame, path: str, pattern: str, ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode, then decode the ids, in one pass.

    With ``ids`` the packed ids come too.
    """

    def work(c: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = c.encode([x or "" for x in batch.column("text").to_pylist()])
        back = c.decode(packed)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(x) // 4 for x in packed], pa.int64()), "ids_sha256": pa.array(map(sha, packed), pa.string()), "decoded_sha256": pa.array(map(sha, back), pa.string())}
        if ids:
            columns["ids"] = pa.array(packed, pa.binary())
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_text(docs, _worker(path, pattern, work), f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * ids)
