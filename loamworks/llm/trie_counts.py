"""Operator 7: token counts by dynamic programming shared in a trie.

The distinct pre-tokens of a slice of texts are inserted in a trie of bytes.  A
node's forward score, the least cost of the bytes from the root, and its number
of pieces are computed once, when the node is made, from the nodes above it, so
words with one prefix share its work.  The counts of terminal nodes are kept by
word and summed for each text.

The model is a unigram over the pieces of a rank file, which is taken as it is.
Their probabilities are fitted by hard expectation-maximisation: the pre-tokens
of all documents are segmented, first under costs from the
ranks, and the pieces counted, ``ROUNDS`` times; each piece counts once more than
it was seen.  Words are counted over the whole table and stay a table; only
the counts of pieces, as many as the vocabulary, come to the driver.  Costs are whole numbers (micronats), so sums and ties are exact; of
equal costs fewer pieces win.

Words of over ``LONG`` bytes aren't put in the trie: the same recurrence runs
over the last positions that a piece can reach, in constant memory.

Defined results: a null or empty text has no tokens; repeated rows give repeated
results; other columns are ignored; on an empty table all pieces weigh the same.
"""

from __future__ import annotations

import math
import re
from collections import Counter as Tally
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import CACHE_ENTRIES, forget_long, map_text, slices, tidy
from .byte_bpe import read_ranks
from .shared import landed

ROUNDS = 2
LONG = 256
#: Nodes after which a fit's task begins a new trie.
NODES = 200_000
#: Words that a worker keeps, with their counts.
WORDS = 300_000
UNIT = 1_000_000


def costs_of(weights: dict[bytes, float]) -> dict[bytes, int]:
    """Micronats of every piece by its share of all weights."""
    total = sum(weights.values())
    return {p: round(-UNIT * math.log(w / total)) for p, w in weights.items()}


def first_costs(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """From ranks alone: the n-th piece weighs 1 / n, a single byte as much as the last piece."""
    last = max(ranks.values())
    return costs_of({p: 1 / (1 + (r if len(p) > 1 else last)) for p, r in ranks.items()})


class Pieces:
    """Costs by piece; ``tails`` also holds every end of a piece, at -1, so a look back stops where none goes on."""

    def __init__(self, costs: dict[bytes, int]) -> None:
        self.costs, self.longest = costs, max(map(len, costs))
        self.tails = {p[i:]: -1 for p in costs for i in range(1, len(p))} | costs

    def step(self, word: bytes, i: int, best: Callable, count: Callable) -> tuple[int, int, int]:
        """Least cost of the first ``i`` bytes, its number of pieces, and where the last one starts."""
        low, pieces, start = None, 0, 0
        find = self.tails.get
        for j in range(i - 1, -1, -1):
            c = find(word[j:i])
            if c is None:
                break
            if c >= 0:
                c += best(j)
                n = count(j) + 1
                if low is None or c < low or (c == low and n < pieces):
                    low, pieces, start = c, n, j
        return low, pieces, start

    def long_count(self, word: bytes) -> int:
        """Pieces of a long word's best segmentation; only the last ``longest`` positions are kept."""
        size = self.longest + 1
        best, count = [0] * size, [0] * size
        for i in range(1, len(word) + 1):
            at = i % size
            best[at], count[at], _ = self.step(word, i, lambda j: best[j % size], lambda j: count[j % size])
        return count[len(word) % size]

    def segmented(self, word: bytes) -> list[bytes]:
        """The best segmentation itself."""
        best, count, starts = [0], [0], [0]
        for i in range(1, len(word) + 1):
            low, pieces, start = self.step(word, i, best.__getitem__, count.__getitem__)
            best.append(low)
            count.append(pieces)
            starts.append(start)
        out, i = [], len(word)
        while i:
            out.append(word[starts[i] : i])
            i = starts[i]
        return out[::-1]


class Trie:
    """Nodes are numbers; ``best``, ``count`` and ``start`` are the forward score, the pieces and the last piece's start up to a node."""

    def __init__(self, pieces: Pieces) -> None:
        self.tails = pieces.tails
        self.children: dict[int, int] = {}
        self.best, self.count, self.start = [0], [0], [0]

    def walk(self, word: bytes) -> list[int]:
        """The nodes of the word's prefixes, the empty one first; new ones are made."""
        node, path = 0, [0]
        find, tail, best, count, starts = self.children, self.tails.get, self.best, self.count, self.start
        for i, byte in enumerate(word, 1):
            key = node << 8 | byte
            child = find.get(key)
            if child is None:
                child = find[key] = len(best)
                low, pieces, start = None, 0, 0
                for j in range(i - 1, -1, -1):
                    c = tail(word[j:i])
                    if c is None:
                        break
                    if c >= 0:
                        at = path[j]
                        c += best[at]
                        n = count[at] + 1
                        if low is None or c < low or (c == low and n < pieces):
                            low, pieces, start = c, n, j
                best.append(low)
                count.append(pieces)
                starts.append(start)
            node = child
            path.append(node)
        return path

    def insert(self, word: bytes) -> int:
        """The number of pieces of the word's best segmentation."""
        return self.count[self.walk(word)[-1]]

    def segmented(self, word: bytes) -> list[bytes]:
        """The best segmentation itself."""
        path, starts, out, i = self.walk(word), self.start, [], len(word)
        while i:
            j = starts[path[i]]
            out.append(word[j:i])
            i = j
        return out[::-1]


#: The pattern of GPT-2 and its followers.
GPT2 = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def bmp_class(kind: str) -> str:
    """The characters below U+10000 that ``regex`` counts to ``kind``, as ranges for a class of ``re``."""
    every = "".join(chr(i) for i in range(1 << 16) if not 0xD800 <= i < 0xE000)
    return "".join(f"\\u{ord(m[0][0]):04x}-\\u{ord(m[0][-1]):04x}" for m in regex.finditer(kind + "+", every))


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern`` in a text.

    For ``GPT2`` and texts without characters from U+10000 on, ``re`` finds the same
    in half the time: its classes are spelled out from those of ``regex``, and words
    are tried first, which changes nothing as no other match begins with a letter.
    """
    whole = regex.compile(pattern).findall
    if pattern != GPT2:
        return whole
    letter, number, space = map(bmp_class, (r"\p{L}", r"\p{N}", r"\s"))
    plain = re.compile(rf" ?[{letter}]+|'(?:s|t|re|ve|m|ll|d)| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+").findall

    def split(text: str) -> list[str]:
        low = text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        return plain(text) if low else whole(text)

    return split


def tallied(docs: DataFrame, pattern: str) -> DataFrame:
    """``word, n`` of the pre-tokens of all texts, but for long words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = splitter(pattern), Tally()

        def flushed() -> pa.RecordBatch:
            short = [(raw, n) for w, n in seen.items() if len(raw := w.encode("utf-8", "surrogatepass")) <= LONG]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in short], pa.binary()), pa.array([n for _, n in short], pa.int64())], ["word", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    seen.update(split(text or ""))
                if len(seen) > CACHE_ENTRIES:
                    yield flushed()
        yield flushed()

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), "word binary, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


#: The pieces of this worker process, by their model.
_PIECES: dict[int, Pieces] = {}


def refitted(costs: dict[bytes, int], words: DataFrame) -> dict[bytes, int]:
    """Costs after one round over a table of words and how often each comes."""
    shared = words.sparkSession.sparkContext.broadcast(costs)  # as many entries as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, seen = None, Tally()
        for batch in batches:
            if trie is None:
                key = hash(frozenset(shared.value.items()))
                if key not in _PIECES:
                    _PIECES.clear()
                    _PIECES[key] = Pieces(shared.value)
                trie = Trie(_PIECES[key])
            elif len(trie.best) > NODES:
                trie = Trie(_PIECES[key])
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                for piece in trie.segmented(word):
                    seen[piece] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["piece", "n"])

    counts = words.mapInArrow(tidy(run), "piece binary, n bigint").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
    seen = Tally(dict.fromkeys(costs, 1))
    seen.update(dict(zip(counts.column("piece").to_pylist(), counts.column("n").to_pylist(), strict=True)))
    return costs_of(seen)


def fit(docs: DataFrame, path: str, pattern: str) -> dict[bytes, int]:
    """Costs of the pieces from the pre-tokens of all documents; long words take no part."""
    words = landed(tallied(docs, pattern).sortWithinPartitions("word"), "words")  # neighbours share prefixes
    ranks = read_ranks(path)
    if not words.limit(1).count():
        return costs_of(dict.fromkeys(ranks, 1))
    costs = first_costs(ranks)
    for _ in range(ROUNDS):
        costs = refitted(costs, words)
    return costs


class Counter:
    """Token counts of texts by one worker."""

    def __init__(self, costs: dict[bytes, int], pattern: str) -> None:
        self.pieces, self.split = Pieces(costs), splitter(pattern)
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[tuple[int, int]]:
        """Pre-tokens and tokens of each text."""
        forget_long(self.known, WORDS)
        cut = [self.split(t) for t in texts]
        new: set[str] = set()
        for words in cut:
            new.update(words)
        trie = Trie(self.pieces)
        for word in sorted(w for w in new if w not in self.known):
            raw = word.encode("utf-8", "surrogatepass")
            self.known[word] = trie.insert(raw) if len(raw) <= LONG else self.pieces.long_count(raw)
        return [(len(words), sum(map(self.known.__getitem__, words))) for words in cut]


#: The counter of this worker process, by the model and pattern.
_COUNTERS: dict[tuple[int, str], Counter] = {}


def count(docs: DataFrame, costs: dict[bytes, int], pattern: str) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens, n_bytes`` of every whole text under the unigram ``costs``."""
    shared = docs.sparkSession.sparkContext.broadcast(costs)  # as many entries as the vocabulary

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        key = (hash(frozenset(shared.value.items())), pattern)
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = Counter(shared.value, pattern)
        own = _COUNTERS[key]

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = own.counts(texts)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64()), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64())],
                ["doc_id", "n_pretokens", "n_tokens", "n_bytes"],
            )

        return work

    return map_text(docs, make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_pretokens bigint, n_tokens bigint, n_bytes bigint")
