"""Queries on tokens: pre-tokens, vocabularies, encoding, compression, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conversation import SPECIALS
from ..operators import bpe, packing
from ..registry import query
from ..session import tuned
from .corpus import docs

# DuckDB's expressions have no look-ahead: a run of white space before a word gives its last
# character to the word there, which the step below does by hand on texts without such runs.
PLAIN = r"""'(?:[sdmtSDMT]|[lL][lL]|[vV][eE]|[rR][eE])|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]|\s+"""
TAME = "regexp_replace(text, '\\s+', ' ', 'g')"
WORDS = f"w AS (SELECT doc_id, unnest(regexp_extract_all({TAME}, '{PLAIN.replace(chr(39), chr(39) * 2)}')) AS word FROM documents)"


def tame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with single spaces, on which both engines' patterns agree."""
    return docs(spark, sf_dir).withColumn("text", F.regexp_replace("text", r"(?U)\s+", " "))


@query("pretoken_counts", f"WITH {WORDS} SELECT word, count(*) AS n FROM w GROUP BY word")
def pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.word_counts(tame(spark, sf_dir))


@query("pretokens_lossless", "SELECT doc_id, md5(text) AS digest FROM documents")
def pretokens_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces put together are the text, white space as it is."""
    return docs(spark, sf_dir).select("doc_id", F.md5(F.array_join(bpe.pretokens(F.col("text")), "")).alias("digest"))


@query("byte_pair_counts", f"""WITH {WORDS}, c AS (SELECT hex(encode(word)) AS h, count(*) AS n FROM w GROUP BY 1),
    p AS (SELECT h[2 * i + 1:2 * i + 2] AS "left", h[2 * i + 3:2 * i + 4] AS "right", n FROM (SELECT h, n, unnest(range(0, length(h) // 2 - 1)) AS i FROM c))
    SELECT "left", "right", sum(n)::BIGINT AS n FROM p GROUP BY ALL""")  # fmt: skip
def byte_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts from which the first merge is chosen."""
    return bpe.pair_counts(bpe.word_counts(tame(spark, sf_dir)))


def _sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(tuned(spark), sf_dir).select("doc_id", "lang", "text")


@query("marked_ids", """
SELECT item_id, len(x)::INTEGER AS n, md5(array_to_string(x, ',')) AS digest FROM (SELECT item_id,
    [256] || list_transform(range(octet_length(encode(text))), lambda i: ('0x' || substr(hex(encode(text)), (2 * i + 1)::INTEGER, 2))::INTEGER) || [10] AS x FROM benchmark)""")  # fmt: skip
def marked_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of whole texts between a special token and a token of the ranks, both given by name."""
    ranks = {bytes([i]): i for i in range(256)}
    coded = bpe.encoded(docs(spark, sf_dir, "benchmark"), ranks, prepend=SPECIALS[0], append="\n", specials=SPECIALS)
    return coded.select("item_id", F.size("ids").alias("n"), F.md5(F.array_join("ids", ",")).alias("digest"))


@query("trained_vocabulary")
def trained_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.train(_sample(spark, sf_dir), 600, SPECIALS)
    return bpe.vocabulary(spark, ranks, SPECIALS).select("token_id", F.hex("bytes").alias("hex"), "is_special", "n_bytes")


@query("encode_decode_round_trip", "SELECT doc_id, md5(text) AS digest FROM documents")
def encode_decode_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode with a vocabulary trained here, decode by joins: the texts again."""
    ranks = bpe.train(_sample(spark, sf_dir), 400, SPECIALS)
    back = bpe.decoded(bpe.encoded(_sample(spark, sf_dir), ranks), bpe.vocabulary(spark, ranks, SPECIALS))
    return back.select("doc_id", F.md5("text").alias("digest"))


@query("byte_vocabulary_stats", "SELECT count(*) AS n, min(b)::INTEGER AS least, max(b)::INTEGER AS most, avg(b) AS mean, stddev_samp(b) AS spread FROM (SELECT 1 AS b FROM range(0, 256) UNION ALL SELECT length(p_brand) FROM part)")
def byte_vocabulary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of pieces that aren't special: 256 bytes and some words."""
    n = spark.range(256).select(F.lit(1).alias("b")).unionAll(docs(spark, sf_dir, "part").select(F.length("p_brand").alias("b")))
    return n.agg(F.count("*").alias("n"), F.min("b").alias("least"), F.max("b").alias("most"), F.avg("b").alias("mean"), F.stddev_samp("b").alias("spread"))


@query("byte_compression", """
WITH d AS (SELECT lang, sum(strlen(text))::BIGINT AS n_bytes, sum(length(text))::BIGINT AS chars FROM documents GROUP BY lang)
SELECT lang, n_bytes, chars, round(n_bytes / chars, 9) AS ratio, round((n_bytes - chars) / n_bytes * 100, 9) AS relative FROM d""")  # fmt: skip
def byte_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes as one tokenizer, characters as the other, compared by language."""
    d = docs(spark, sf_dir).groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n_bytes"), F.sum(F.length("text")).alias("chars"))
    return d.select("lang", "n_bytes", "chars", F.round(F.col("n_bytes") / F.col("chars"), 9).alias("ratio"), F.round((F.col("n_bytes") - F.col("chars")) / F.col("n_bytes") * 100, 9).alias("relative"))


@query("tokenizer_comparison")
def tokenizer_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small and a larger vocabulary by language: tokens, relative difference, winner."""
    ranks = bpe.train(_sample(spark, sf_dir), 500)
    # The smaller vocabulary is the larger one's start: merges are learned in order.
    base, ours = (bpe.compression(bpe.encoded(_sample(spark, sf_dir), {p: r for p, r in ranks.items() if r < n}), "lang") for n in (300, 500))
    both = base.select("lang", F.col("n_tokens").alias("base")).join(ours.select("lang", "n_tokens"), "lang")
    return both.select("lang", "base", "n_tokens", F.round((F.col("base") - F.col("n_tokens")) / F.col("base") * 100, 6).alias("fewer_percent"), F.when(F.col("n_tokens") < F.col("base"), "ours").otherwise("base").alias("winner"))


def _byte_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as byte ids after a start token, dealt to four ranks."""
    return docs(tuned(spark), sf_dir).select("doc_id", F.pmod("doc_id", F.lit(4)).alias("rank"), bpe.byte_ids(F.col("text"), 256).alias("ids"))


@query("best_fit_crop")
def best_fit_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_byte_docs(spark, sf_dir), 256, buffer_size=50, refill=16).select("rank", "row", "content", F.md5(F.to_json("inputs")).alias("digest"), "names")


@query("best_fit_pad", "SELECT doc_id AS name, least(1 + strlen(text), 257)::INTEGER AS n FROM documents")
def best_fit_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing with padding places every document once, whole up to the row's length."""
    rows = packing.packed(_byte_docs(spark, sf_dir), 256, crop=False, pad=256, buffer_size=50, refill=16)
    return rows.select(F.explode(F.arrays_zip("names", "sizes")).alias("x")).select(F.col("x.names").alias("name"), F.col("x.sizes").alias("n"))


@query("packed_totals", "SELECT doc_id % 4 AS rank, sum(least(1 + strlen(text), 257))::BIGINT AS tokens FROM documents GROUP BY 1")
def packed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No token is lost: contents of padded rows by rank."""
    return packing.packed(_byte_docs(spark, sf_dir), 256, crop=False, pad=256, buffer_size=50, refill=16).groupBy("rank").agg(F.sum("content").alias("tokens"))


IDS = "i AS (SELECT item_id, list_transform(string_split(text, ''), lambda c: ascii(c)) AS ids FROM benchmark)"


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.transform(F.filter(F.split("text", ""), lambda c: c != ""), F.ascii)
    return docs(spark, sf_dir, "benchmark").select("item_id", ids.alias("ids"))


@query("shifted_targets", f"WITH {IDS} SELECT item_id, ids[1:len(ids) - 1] AS inputs, list_transform(range(2, len(ids) + 1), lambda k: CASE WHEN k % 3 = 0 THEN -1 ELSE ids[k] END) AS targets FROM i")
def shifted_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next-token targets, ignored where the mask is 0 (every third place)."""
    inputs, targets = packing.shifted(F.col("ids"))
    mask = F.transform(F.sequence(F.lit(2), F.size("ids")), lambda k: F.when(k % 3 == 0, 0).otherwise(1))
    return _ids(spark, sf_dir).select("item_id", inputs.alias("inputs"), packing.masked(targets, mask).alias("targets"))


@query("padded_sequences", f"WITH {IDS} SELECT item_id, list_concat(ids, list_transform(range(0, 4096 - len(ids)), lambda _: 0)) AS padded, ids[greatest(len(ids) - 15, 1):] AS cropped FROM i")
def padded_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir).select("item_id", packing.padded(F.col("ids"), F.lit(4096), 0).alias("padded"), packing.left_cropped(F.col("ids"), 16).alias("cropped"))


@query("fixed_batches", "SELECT doc_id // 32 AS batch, count(*) AS n, max(length(text))::INTEGER AS longest FROM documents GROUP BY 1")
def fixed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).groupBy(F.floor(F.col("doc_id") / 32).alias("batch")).agg(F.count("*").alias("n"), F.max(F.length("text")).alias("longest"))
