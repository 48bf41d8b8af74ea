"""Tasks: a registry of datasets and graders, spelling examples, models with retries."""

from __future__ import annotations

import itertools
import json
import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import conversation as V
from ..functions import text as T
from .corpus import task_slice
from .synthesis import TEST_OFFSET


@dataclass(frozen=True)
class Task:
    """A dataset with a dense ``idx``, how it is graded, and the grade of ``reply`` rows."""

    name: str
    rows: DataFrame
    kind: str  # "generative" or "categorical"
    grade: Callable[[DataFrame], DataFrame]

    def slice(self, start: int = 0, stop: int = 2**62, step: int = 1) -> Task:
        return Task(self.name, task_slice(self.rows, start, stop, step), self.kind, self.grade)

    def __len__(self) -> int:
        return self.rows.count()


def numeric_grade(replies: DataFrame) -> DataFrame:
    """``idx, passed`` from ``idx, reply, answer``."""
    return replies.select("idx", (T.same_answer(F.col("reply"), F.col("answer")) == 1).alias("passed"))


def letter_grade(replies: DataFrame) -> DataFrame:
    """``idx, passed`` from ``idx, reply, answer, letters``; a letter that isn't offered is wrong."""
    return replies.select("idx", ((F.col("reply") == F.col("answer")) & F.array_contains("letters", F.col("reply"))).alias("passed"))


def evaluate(task: Task, replies: DataFrame) -> DataFrame:
    """``task, n, accuracy``: a problem passes if any of its replies does."""
    rows = replies.join(task.rows, "idx")
    each = task.grade(rows).groupBy("idx").agg(F.bool_or(F.coalesce("passed", F.lit(False))).alias("passed"))
    return each.agg(F.lit(task.name).alias("task"), F.count("*").alias("n"), F.avg(F.col("passed").cast("double")).alias("accuracy"))


def by_type(items: DataFrame, losses: DataFrame, predictions: DataFrame) -> DataFrame:
    """``item, correct`` for all three kinds of item.

    ``items(item, task_type, gold)``; choices and schemas by ``losses(item,
    option, loss)``: the least mean loss is the answer, the first among equals;
    completions by ``predictions(item, predicted, actual)``: all must agree.
    """
    from .metrics import lowest_mean_loss

    chosen = lowest_mean_loss(losses, ["item"], "option", "loss")
    options = items.filter(F.col("task_type").isin("multiple_choice", "schema")).join(chosen, "item").select("item", (F.col("choice") == F.col("gold")).alias("correct"))
    whole = predictions.groupBy("item").agg(F.bool_and(F.col("predicted") == F.col("actual")).alias("correct"))
    return options.unionByName(items.filter("task_type = 'language_modeling'").select("item").join(whole, "item"))


# Question forms of the counting task.
COUNT_FORMS = ["How many {letter} are in {word}", "How many times does {letter} appear in the word {word}", "Count the letter {letter} in {word}", "In {word}, how often is there a {letter}"]


def _digest(index: Column, salt: str, modulus: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{salt}:"), index.cast("string"))), 1, 7), 16, 10).cast("long") % modulus


def spelling_examples(index: DataFrame, words: Sequence[str] | DataFrame, split: str = "train", n_words: int | None = None) -> DataFrame:
    """``idx, word, letter, question, answer`` for ``index(idx)``: count a letter in a word.

    Word, letter (nine times in ten one of the word's), form, case, quotes and
    question mark are drawn by hashes of the index; test indices are moved by an
    offset, so no example is in both splits.  Words are joined by their number.
    """
    spark = index.sparkSession
    table = words if isinstance(words, DataFrame) else spark.createDataFrame(list(enumerate(words)), "word_no long, word string")
    total = n_words or table.count()
    seed = F.col("idx") + (TEST_OFFSET if split == "test" else 0)
    rows = index.select("idx", seed.alias("seed")).withColumn("word_no", _digest(F.col("seed"), "word", total)).join(table, "word_no")
    s, word = F.col("seed"), F.col("word")
    own = F.substring(word, (F.pmod(_digest(s, "place", 1 << 20), F.length(word)) + 1).cast("int"), F.lit(1))
    other = F.char(97 + _digest(s, "letter", 26))
    rows = rows.withColumn("letter", F.when(_digest(s, "own", 10) < 9, own).otherwise(other))
    form = F.get(F.array(*map(F.lit, COUNT_FORMS)), _digest(s, "form", len(COUNT_FORMS)).cast("int"))
    mark = F.when(_digest(s, "quote", 2) == 0, F.lit("'")).otherwise(F.lit(""))
    asked = F.replace(F.replace(form, F.lit("{letter}"), F.concat(mark, F.col("letter"), mark)), F.lit("{word}"), F.concat(mark, word, mark))
    asked = F.when(_digest(s, "lower", 10) < 3, F.lower(asked)).otherwise(asked)
    asked = F.concat(asked, F.when(_digest(s, "mark", 2) == 0, F.lit("?")).otherwise(F.lit("")))
    count = T.letter_count(word, F.col("letter"))
    parts = F.array(
        F.struct(F.lit("text").alias("type"), F.concat(F.lit("Spelled out: "), T.spelled(word), F.lit("\n")).alias("text")),
        F.struct(F.lit("python").alias("type"), F.concat(F.lit("'"), word, F.lit("'.count('"), F.col("letter"), F.lit("')")).alias("text")),
        F.struct(F.lit("python_output").alias("type"), count.cast("string").alias("text")),
        F.struct(F.lit("text").alias("type"), F.concat(F.lit("\n#### "), count.cast("string")).alias("text")),
    )
    nothing = F.lit(None).cast(f"array<{V.PART}>")
    user = F.struct(F.lit("user").alias("role"), asked.alias("content"), nothing.alias("parts"))
    reply = F.struct(F.lit("assistant").alias("role"), F.lit(None).cast("string").alias("content"), parts.alias("parts"))
    return rows.select("idx", "word", "letter", asked.alias("question"), count.alias("answer"), F.array(user, reply).alias("messages"))


class Model:
    """Several back ends in turn, each with so many calls at once, retried with growing waits."""

    def __init__(self, backends: Sequence[Callable[[str], str]], at_once: int = 8, attempts: int = 5, wait: Callable[[float], None] = time.sleep) -> None:
        self._turn = itertools.cycle([(b, threading.Semaphore(at_once)) for b in backends])
        self._lock, self.attempts, self.wait = threading.Lock(), attempts, wait

    def __call__(self, prompt: str) -> str:
        for attempt in range(1, self.attempts + 1):
            with self._lock:
                backend, gate = next(self._turn)
            try:
                with gate:
                    return backend(prompt)
            except Exception:  # noqa: BLE001  whatever a back end raises is retried
                if attempt == self.attempts:
                    raise
                self.wait(min(2.0**attempt, 60.0))
        raise AssertionError

    def json(self, prompt: str, tries: int = 3):
        """A reply parsed as JSON; a reply that can't be is asked for again with the parser's message."""
        ask, error = prompt, ""
        for _ in range(tries):
            reply = self(ask).strip()
            if reply.startswith("```"):
                reply = reply.split("\n", 1)[-1].rsplit("```", 1)[0]
            try:
                return json.loads(reply)
            except json.JSONDecodeError as e:
                error = str(e)
                ask = f"{prompt}\n\nThe last reply was not valid JSON ({error}). Reply with JSON only."
        raise ValueError(f"no JSON after {tries} tries: {error}")
