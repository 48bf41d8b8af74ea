"""Operator 3: word-first backoff language identification.

Known words score by their log frequency in each language; a word that no
language knows falls back to the longest character n-grams of the marked word
``<word>`` of which the model knows any, five characters down to one.  A text's
score of a language is the sum over its words; the prediction is the best
language, its posterior under equal priors the ``score``.

Fitting uses a sample of at most about ``DOCS_A_LANGUAGE`` training documents a
language, and all words and n-grams of their whole texts: the model is bounded
by that sample alone.  Prediction reads whole texts.

Defined results: a null text, or one without a letter, is ``und`` with score
0; with nothing to learn from every text is; ties go to the first language by
name; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import map_text, slices, tidy
from .folds import bounded_sample, held_out

DOCS_A_LANGUAGE = 1_000
LONGEST_GRAM = 5
#: Additive smoothing of counts.
SMOOTH = 0.5
#: Entries of a worker's table of chunk scores before it is emptied.
CHUNKS = 250_000
#: Characters from which on a word's n-grams are averaged piece by piece.
LONG = 4_096
UNKNOWN = "und"


@cache
def letters() -> re.Pattern:
    r"""Runs of letters, the characters of category L: of what ``\w`` takes, no digits, marks or numbers such as a half."""
    out = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()]
    return re.compile(rf"[^\W\d_{''.join(out)}]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return letters().findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of the marked word."""
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies by language of words and n-grams; ``langs`` in name order."""

    def __init__(self, langs: list[str], words: dict[str, np.ndarray], grams: dict[str, np.ndarray]) -> None:
        self.langs, self.words, self.grams = langs, words, grams

    def __getstate__(self) -> tuple:
        """Names beside one matrix a table: a fraction of the arrays' own size."""
        pack = lambda t: ("\n".join(t), np.array(list(t.values()), dtype=np.float64).reshape(len(t), len(self.langs)))
        return self.langs, pack(self.words), pack(self.grams)

    def __setstate__(self, state: tuple) -> None:
        self.langs = state[0]
        self.words, self.grams = (dict(zip(names.split("\n"), rows, strict=True)) if len(rows) else {} for names, rows in state[1:])

    @classmethod
    def of_counts(cls, counts: list[tuple[str, str, str, int]]) -> Model:
        """From rows ``kind ('w' or 'g' and its length), lang, item, n``."""
        langs = sorted({r[1] for r in counts})
        place = {x: i for i, x in enumerate(langs)}
        tables: dict[str, dict[str, np.ndarray]] = {}
        for kind, lang, item, n in counts:
            tables.setdefault(kind, {}).setdefault(item, np.zeros(len(langs)))[place[lang]] += n
        logs: dict[str, dict[str, np.ndarray]] = {}
        for kind, table in tables.items():
            total = sum(table.values()) + SMOOTH * len(table)
            logs[kind] = {k: np.log((v + SMOOTH) / total) for k, v in table.items()}
        return cls(langs, logs.get("w", {}), {k: v for kind, t in logs.items() if kind != "w" for k, v in t.items()})

    def word_score(self, word: str) -> np.ndarray:
        """Log score of one word by language; zeros when even its letters are new."""
        known = self.words.get(word)
        if known is not None:
            return known
        for n in range(min(LONGEST_GRAM, len(word) + 2), 0, -1):
            found = [x for g in grams_of(word, n) if (x := self.grams.get(g)) is not None]
            if found:
                return sum(found) / len(found)
        return np.zeros(len(self.langs))

    def chunk_score(self, chunk: str) -> np.ndarray:
        """Scores of the words in a white-space-free chunk, then its number of words."""
        words = words_of(chunk)
        return np.append(sum(map(self.word_score, words), np.zeros(len(self.langs))), len(words))

    def judge(self, scores: np.ndarray) -> tuple[str, float]:
        """Prediction and score of summed chunk scores."""
        if not self.langs or not scores[-1]:
            return UNKNOWN, 0.0
        logs = scores[:-1]
        best = int(np.argmax(logs))
        return self.langs[best], float(1 / np.exp(np.maximum(logs - logs[best], -700)).sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        """The plain form: one text, word by word."""
        return self.judge(sum(map(self.chunk_score, (text or "").split()), np.zeros(len(self.langs) + 1)))


class ChunkTable:
    """Scores of white-space-free chunks, remembered by one worker.

    New chunks of a slice are scored together: each word gives a run of rows of
    the model's matrix (the word's own, or its n-grams'), averaged at once.
    """

    def __init__(self, model: Model) -> None:
        self.model = model
        width = len(model.langs)
        items = [*model.words.values(), *model.grams.values()]
        self.matrix = np.array(items).reshape(len(items), width)
        self.word_rows = {w: i for i, w in enumerate(model.words)}
        self.gram_rows = {g: len(model.words) + i for i, g in enumerate(model.grams)}
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, width + 1))

    def word_run(self, word: str) -> list[int]:
        """Rows to average for one word; empty when even its letters are new."""
        row = self.word_rows.get(word)
        if row is not None:
            return [row]
        marked, find = f"<{word}>", self.gram_rows.get
        for n in range(min(LONGEST_GRAM, len(marked)), 0, -1):
            found = [x for i in range(len(marked) - n + 1) if (x := find(marked[i : i + n])) is not None]
            if found:
                return found
        return []

    def long_score(self, word: str) -> np.ndarray:
        """Score of a very long word, from bounded pieces of its n-grams."""
        row = self.word_rows.get(word)
        if row is not None:
            return self.matrix[row]
        marked, find = f"<{word}>", self.gram_rows.get
        for n in range(LONGEST_GRAM, 0, -1):
            total, found = np.zeros(self.matrix.shape[1]), 0
            for at in range(0, len(marked) - n + 1, LONG):
                rows = [x for i in range(at, min(at + LONG, len(marked) - n + 1)) if (x := find(marked[i : i + n])) is not None]
                total += self.matrix[rows].sum(axis=0)
                found += len(rows)
            if found:
                return total / found
        return np.zeros(self.matrix.shape[1])

    def learn(self, new: list[str]) -> None:
        flat: list[int] = []
        sizes: list[int] = []
        owners: list[int] = []
        long: list[tuple[int, np.ndarray]] = []
        count = np.zeros(len(new))
        for k, chunk in enumerate(new):
            low = chunk.lower()
            words = [low] if low.isalpha() else words_of(chunk)
            count[k] = len(words)
            for w in words:
                if len(w) > LONG:
                    long.append((k, self.long_score(w)))
                    continue
                run = self.word_run(w)
                if run:
                    flat += run
                    sizes.append(len(run))
                    owners.append(k)
        fresh = np.zeros((len(new), self.rows.shape[1]))
        if flat:
            size = np.array(sizes)
            means = np.add.reduceat(self.matrix[flat], np.cumsum(size) - size, axis=0) / size[:, None]
            np.add.at(fresh[:, :-1], owners, means)
        for k, mean in long:
            fresh[k, :-1] += mean
        fresh[:, -1] = count
        start = len(self.rows)
        self.rows = np.concatenate((self.rows, fresh))
        self.known.update(zip(new, range(start, start + len(new)), strict=True))

    def places(self, cut: list[list[str]]) -> np.ndarray:
        """Row of every chunk, in order."""
        if len(self.known) > CHUNKS:
            short = [(c, i) for c, i in self.known.items() if len(c) <= 9][: CHUNKS // 2]
            self.rows = self.rows[[i for _, i in short]]
            self.known = {c: i for i, (c, _) in enumerate(short)}
        flat = [c for chunks in cut for c in chunks]
        found = list(map(self.known.get, flat))
        missed = [i for i, x in enumerate(found) if x is None]
        self.learn(list({flat[i] for i in missed}))
        for i in missed:
            found[i] = self.known[flat[i]]
        return np.array(found, dtype=np.int64)


def counts(rows: DataFrame) -> DataFrame:
    """``kind, lang, item, n`` over the texts of ``rows(lang, text)``, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words: dict[str, Counter] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                    words.setdefault(lang, Counter()).update(words_of(text))
                out = []
                for lang, found in words.items():
                    out += [("w", lang, w, n) for w, n in found.items()]
                    for size in range(1, LONGEST_GRAM + 1):
                        grams: Counter = Counter()
                        for w, n in found.items():
                            for g in grams_of(w, size):
                                grams[g] += n
                        out += [(f"g{size}", lang, g, n) for g, n in grams.items()]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["kind", "lang", "item", "n"])

    return rows.select("lang", F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), "kind string, lang string, item string, n bigint").groupBy("kind", "lang", "item").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Model:
    """Learn from text and non-null lang of the rows that aren't held out."""
    learn = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    sample = bounded_sample(learn, "lang", DOCS_A_LANGUAGE, seed="langid")
    found = counts(sample).toArrow()
    return Model.of_counts(list(zip(*(found.column(c).to_pylist() for c in ("kind", "lang", "item", "n")), strict=True)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def make():
        table = ChunkTable(shared.value)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            cut = [(text or "").split() for text in batch.column("text").to_pylist()]
            at = table.places(cut)
            ends = np.cumsum([len(c) for c in cut])
            names, scores = [], []
            for chunks, end in zip(cut, ends.tolist(), strict=True):
                name, score = table.model.judge(table.rows[at[end - len(chunks) : end]].sum(axis=0))
                names.append(name)
                scores.append(score)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = map_text(docs, make, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the training rows of ``docs(doc_id, text, lang)``, then predict all of them."""
    return predict(docs, fit(docs))

