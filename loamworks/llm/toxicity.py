"""Operator 4: FTRL-proximal logistic regression for toxicity.

Features of a text are the distinct hashed word unigrams, bigrams and skip-grams
(two words with one between them).  Per-coordinate learning rates and L1
sparsity come from the FTRL-proximal update; the weights that aren't zero are
few and are broadcast.

Fitting uses a sample of at most about ``ROWS_A_CLASS`` labelled training rows
of each class, chosen by a hash of doc_id; the rarer class is repeated until
classes weigh about alike.  Scoring reads every whole text.

Defined results: a null or empty text has the score of the bias alone; several
label rows of one document count as toxic if one is; null labels and labels of
unknown documents are left out; with no labels every score is 0.5; repeated
rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Bounded, map_text, raw_texts, slices, tidy
from .folds import bounded_sample, held_out

ROWS_A_CLASS = 3_000
BITS = 20
EPOCHS = 12
ALPHA, BETA, L1, L2 = 1.0, 1.0, 16.0, 0.0
#: Scores from here on reject a document.
THRESHOLD = 0.7

_EDGES = bytes(range(33)) + b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BIGRAM, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def word_hash(chunk: bytes) -> int:
    """64 bits of a chunk without punctuation at its ends; 0 if nothing is left."""
    word = chunk.strip(_EDGES)
    return xxhash.xxh64_intdigest(word) or 1 if word else 0


def features(text: bytes, known: Bounded) -> np.ndarray:
    """Distinct feature numbers of a text, in order."""
    chunks = text.lower().split()
    h = np.fromiter(map(known.__getitem__, chunks), dtype=np.uint64, count=len(chunks))
    h = h[h != 0]
    both = [h, h[:-1] * _BIGRAM + h[1:], h[:-2] * _SKIP + h[2:] * _BIGRAM]
    mixed = np.concatenate(both)
    mixed ^= mixed >> np.uint64(31)
    mixed *= _BIGRAM
    return np.unique((mixed >> np.uint64(64 - BITS)).astype(np.uint32))


class Ftrl:
    """The learner: z and n by coordinate, weights derived from them."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == 1 << BITS, 0.0, L1)  # the bias has no penalty
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


class Model:
    """The weights that aren't zero, and the bias."""

    def __init__(self, at: np.ndarray, weight: np.ndarray, bias: float) -> None:
        self.at, self.weight, self.bias = at.astype(np.uint32), weight.astype(np.float32), bias

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, dtype=np.float32)
        out[self.at] = self.weight
        return out


def learn(rows: list[tuple[int, np.ndarray]]) -> Model:
    """From ``(label, features)`` rows, in the order given."""
    model = Ftrl()
    sizes = [sum(y == label for y, _ in rows) for label in (0, 1)]
    times = [max(1, round(max(sizes) / n)) if n else 0 for n in sizes]
    steps = [(y, np.append(at.astype(np.int64), 1 << BITS)) for y, at in rows]
    for _ in range(EPOCHS):
        for again in range(max(times)):
            for y, at in steps:
                if again < times[y]:
                    model.learn(at, y)
    w = model.weights(np.arange((1 << BITS) + 1))
    at = np.flatnonzero(w[:-1])
    return Model(at, w[at], float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn ``labels(doc_id, toxic)`` from the rows that aren't held out."""
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    sample = bounded_sample(marked, "toxic", ROWS_A_CLASS, seed="toxic").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most about twice ROWS_A_CLASS rows

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        known = Bounded(word_hash)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            known.trim()
            found = [features(t, known).tobytes() for t in raw_texts(batch.column("text"))]
            return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("toxic"), pa.array(found, pa.binary())], ["doc_id", "toxic", "at"])

        return work

    got = map_text(rows, make, "doc_id string, toxic int, at binary", ("doc_id", "text", "toxic")).collect()
    got.sort(key=lambda r: (xxhash.xxh64_intdigest(r["doc_id"]), bytes(r["at"])))
    return learn([(r["toxic"], np.frombuffer(r["at"], dtype=np.uint32)) for r in got])


def scorer(model: Model) -> Callable[[list[bytes]], np.ndarray]:
    """Scores of texts by one worker."""
    known, dense = Bounded(word_hash), model.dense()

    def score(texts: list[bytes]) -> np.ndarray:
        known.trim()
        logit = np.array([dense[features(t, known)].sum(dtype=np.float64) for t in texts]) + model.bias
        return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))

    return score


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        rate = scorer(shared.value)
        return lambda batch: pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rate(raw_texts(batch.column("text"))), pa.float64())], ["doc_id", "score"])

    found = map_text(docs, make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return found.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text isn't predicted toxic, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        rate = scorer(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(rate(raw_texts(part.column("text"))) < THRESHOLD))

    return docs.mapInArrow(tidy(run), docs.schema)
