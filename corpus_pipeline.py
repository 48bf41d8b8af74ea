"""The corpus pipeline: toxicity, near-duplicates, decontamination, secrets, byte-level BPE.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept.  All but the last return the columns of ``docs`` as they are;
the last returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loamworks.llm import byte_bpe, secrets, setsketch, spaced_seeds, toxicity
from loamworks.llm.shared import landed, tuned
from loamworks.storage import discard, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that score 0.7 or more go."""
    return toxicity.clean(docs, toxicity.fit(docs, tuned(spark).read.parquet(f"{sf_dir}/labels.parquet")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group stays."""
    tuned(spark)
    return setsketch.without_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that overlap a benchmark item go."""
    return spaced_seeds.without_leaks(docs, tuned(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: secrets are replaced in the text; documents stay."""
    tuned(spark)
    return secrets.redacted(docs, secrets.fit(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: packed token ids of each document, with digests of the ids and of what they decode to."""
    import public_tokenizers as public

    tuned(spark)
    return byte_bpe.digest(docs, public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN, ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("byte_bpe", encoded),
]

#: Trained models, a regular-expression splitter with look-ahead and merges aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written before the next reads it, and what led to it is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = written()
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(spark, before, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
