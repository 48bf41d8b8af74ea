"""The queries of this subpackage: ``opN_<name>`` over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, dac, langid, line_quality, oracles, pseudonyms, secrets, setsketch, spaced_seeds, toxicity, trie_counts
from .shared import tuned

#: The key of the registered query; a real run gives its own.
PSEUDONYM_KEY = b"loamworks"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_frequency_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(table(spark, sf_dir, "documents"))


def op2_crf_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.spans(docs, secrets.fit(docs))


def op3_word_first_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_setsketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.groups(table(spark, sf_dir, "documents"))


def op6_recursive_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return byte_bpe.digest(table(spark, sf_dir, "documents"), public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)


def op7_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    docs = table(spark, sf_dir, "documents")
    return trie_counts.count(docs, trie_counts.fit(docs, public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN), public.PATTERN)


def op8_addressable_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return dac.round_trip(spark, table(spark, sf_dir, "documents"), public.path("word_bpe_49k.json"))


def op9_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op10_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_frequency_quality": oracles.LINE_QUALITY,
        "op5_setsketch_near_duplicates": oracles.NEAR_DUPLICATES,
        "op10_spaced_seed_decontamination": oracles.SPACED_SEEDS,
    }
