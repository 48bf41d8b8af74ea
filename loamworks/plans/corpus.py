"""Queries on corpus building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import corpus as C
from ..operators import ordering
from ..registry import query
from ..storage import landed


def docs(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEAN = r"""
cleaned AS (
    SELECT *, regexp_replace(array_to_string(list_filter(string_split(regexp_replace(
        replace(replace(replace(replace(replace(replace(text, 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬀ', 'ff'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), 'ſ', 's'),
        '\n{3,}', chr(10) || chr(10), 'g'), chr(10)),
        lambda l: length(l) <= 20 OR length(regexp_replace(l, '[^\p{L}]', '', 'g')) / length(l) >= 0.30), chr(10)), '\A\s+|\s+\z', '', 'g') AS t
    FROM documents WHERE length(text) >= 1000),
counted AS (SELECT *, list_filter(regexp_split_to_array(t, '\s+'), lambda w: w <> '') AS w FROM cleaned),
clean AS (SELECT doc_id, source, t AS text FROM counted WHERE length(t) >= 1000 AND len(w) >= 200 AND len(list_distinct(w)) / len(w) >= 0.15)"""


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned documents; the outer explode keeps the filter from cleaning again."""
    return docs(spark, sf_dir).select("doc_id", "source", F.explode_outer(F.array(T.clean_ocr(F.col("text")))).alias("text")).filter("text is not null")


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and lengths of the mix; texts are cleaned once, for a written table."""
    sizes = landed(clean(spark, sf_dir).select("doc_id", "source", F.length("text").alias("chars")), "clean")
    return C.round_robin(sizes, WEIGHTS)


@query("clean_documents", "WITH" + CLEAN + " SELECT doc_id, length(text) AS n_chars, md5(text) AS digest FROM clean")
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir).select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


WEIGHTS = {"src0": 0.55, "src1": 0.10, "src2": 0.05, "src3": 0.30}
MIXED = r"""
weights(source, w, k) AS (VALUES ('src0', 0.55::DOUBLE, 0), ('src1', 0.10::DOUBLE, 1), ('src2', 0.05::DOUBLE, 2), ('src3', 0.30::DOUBLE, 3)),
turns AS (
    SELECT d.doc_id, d.source, d.text, coalesce(w.k, 4) AS k, (row_number() OVER (PARTITION BY d.source ORDER BY d.doc_id) - 1) / coalesce(w.w, 1e-9::DOUBLE) AS turn
    FROM clean d LEFT JOIN weights w USING (source)),
mixed AS (SELECT doc_id, source, text, row_number() OVER (ORDER BY turn, k, source) - 1 AS pos FROM turns)"""


@query("weighted_round_robin", "WITH" + CLEAN + "," + MIXED + " SELECT pos, doc_id, source FROM mixed")
def weighted_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark, sf_dir).select("pos", "doc_id", "source")


SHARDED = r"""
blocks AS (SELECT pos // 8 AS block, count(*) AS docs, sum(length(text))::BIGINT AS chars FROM mixed GROUP BY 1),
fold(block, shard, held) AS (
    SELECT block, 0::BIGINT, chars FROM blocks WHERE block = 0
    UNION ALL
    SELECT b.block, CASE WHEN f.held >= 40000 THEN f.shard + 1 ELSE f.shard END, CASE WHEN f.held >= 40000 THEN 0 ELSE f.held END + b.chars
    FROM fold f JOIN blocks b ON b.block = f.block + 1),
sharded AS (SELECT m.*, f.shard FROM mixed m JOIN fold f ON f.block = m.pos // 8)"""


@query("shard_assignment", "WITH RECURSIVE" + CLEAN + "," + MIXED + "," + SHARDED + " SELECT shard, count(*) AS docs, sum(length(text))::BIGINT AS chars, min(pos) AS first_pos, max(pos) AS last_pos FROM sharded GROUP BY shard")
def shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.assign_shards(mixed(spark, sf_dir), 40_000, block=8, chars="chars").groupBy("shard").agg(F.count("*").alias("docs"), F.sum("chars").alias("chars"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


@query(
    "shard_assignment_target",
    "WITH RECURSIVE" + CLEAN + "," + MIXED + "," + SHARDED
    + """, sizes AS (SELECT shard, count(*) AS docs, sum(length(text))::BIGINT AS chars, max(pos) AS last_pos FROM sharded GROUP BY shard),
    run AS (SELECT *, sum(chars) OVER (ORDER BY shard) AS total FROM sizes)
    SELECT shard, docs, chars FROM run WHERE total - chars < 100000 AND docs % 8 = 0 AND chars >= 40000""",
)
def shard_assignment_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops at 100,000 characters and drops the shard that isn't full."""
    sharded = C.assign_shards(mixed(spark, sf_dir), 40_000, target=100_000, tail=False, block=8, chars="chars")
    return sharded.groupBy("shard").agg(F.count("*").alias("docs"), F.sum("chars").alias("chars"))


@query(
    "corpus_report",
    "WITH RECURSIVE" + CLEAN + "," + MIXED + "," + SHARDED
    + """, kept AS (SELECT source, count(*) AS docs, sum(length(text))::BIGINT AS chars, count(DISTINCT shard) AS shards FROM sharded GROUP BY source),
    seen AS (SELECT source, count(*) AS read FROM documents GROUP BY source)
    SELECT source, read, coalesce(docs, 0) AS docs, coalesce(chars, 0)::BIGINT AS chars, coalesce(shards, 0) AS shards, read - coalesce(docs, 0) AS rejected
    FROM seen LEFT JOIN kept USING (source)""",
)
def corpus_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, mix by weight, assign shards; documents, characters and rejects by source."""
    seen = docs(spark, sf_dir).groupBy("source").agg(F.count("*").alias("read"))
    sharded = C.assign_shards(mixed(spark, sf_dir), 40_000, block=8, chars="chars")
    kept = sharded.groupBy("source").agg(F.count("*").alias("docs"), F.sum("chars").alias("chars"), F.countDistinct("shard").alias("shards"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return seen.join(kept, "source", "left").select("source", "read", zero("docs"), zero("chars"), zero("shards"), (F.col("read") - F.coalesce("docs", F.lit(0))).alias("rejected"))


@query("char_budget_prefix", """
WITH r AS (SELECT doc_id, least(length(text), 2000) AS n, sum(least(length(text), 2000)) OVER (ORDER BY doc_id) AS total FROM documents)
SELECT doc_id, n::BIGINT AS n_chars FROM r WHERE total - n <= 300000""")  # fmt: skip
def char_budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.char_prefix(docs(spark, sf_dir), 300_000, cap=2_000).select("doc_id", F.length("text").cast("long").alias("n_chars"))


@query("running_char_total", "SELECT doc_id, sum(length(text)) OVER (ORDER BY doc_id)::BIGINT AS total FROM documents")
def running_char_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.running_sum(docs(spark, sf_dir).select("doc_id", F.length("text").cast("long").alias("n")), "total", "n", "doc_id").select("doc_id", "total")


ROW_GROUPS = "g AS (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS row_group FROM documents)"


@query("row_group_stride", f"WITH {ROW_GROUPS} SELECT row_group, count(*) AS docs, min(doc_id) AS first_doc FROM g WHERE row_group >= 1 AND (row_group - 1) % 3 = 0 GROUP BY row_group")
def row_group_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = C.row_groups(docs(spark, sf_dir).select("doc_id"), "doc_id", 64)
    return groups.filter(C.strided(F.col("row_group"), 1, 3)).groupBy("row_group").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first_doc"))


@query("train_val_split", f"WITH {ROW_GROUPS} SELECT CASE WHEN row_group = (SELECT max(row_group) FROM g) THEN 'val' ELSE 'train' END AS split, count(*) AS docs, sum(length(text))::BIGINT AS chars FROM g GROUP BY 1")
def train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last group is held out, as the last file of a sorted folder is."""
    groups = C.row_groups(docs(spark, sf_dir).select("doc_id", F.length("text").alias("n")), "doc_id", 64)
    last = groups.agg(F.max("row_group").alias("last"))
    return groups.join(F.broadcast(last)).groupBy(F.when(F.col("row_group") == F.col("last"), "val").otherwise("train").alias("split")).agg(F.count("*").alias("docs"), F.sum("n").alias("chars"))  # one row


@query("rank_batches_epochs", f"WITH {ROW_GROUPS} SELECT e AS epoch, row_group % 4 AS rank, count(DISTINCT row_group) AS groups, count(*) AS docs FROM g, range(1, 3) r(e) GROUP BY 1, 2")
def rank_batches_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = C.row_groups(docs(spark, sf_dir).select("doc_id"), "doc_id", 64)
    both = C.epochs(groups, 2).withColumn("rank", F.pmod("row_group", F.lit(4)))
    return both.groupBy(F.col("epoch").cast("long").alias("epoch"), "rank").agg(F.countDistinct("row_group").alias("groups"), F.count("*").alias("docs"))


@query("resumed_rank_stream", f"""WITH {ROW_GROUPS}, f AS (SELECT e AS epoch, row_group // 6 AS file, row_group % 6 AS row_group, doc_id FROM g, range(1, 3) r(e))
SELECT epoch, file, row_group, count(*) AS docs FROM f WHERE row_group IN (1, 3, 5) AND (epoch > 1 OR file > 0 OR row_group > 3) GROUP BY ALL""")  # fmt: skip
def resumed_rank_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank 1 of 2 goes on after row group 2 of file 0 in the first of two epochs."""
    groups = C.row_groups(docs(spark, sf_dir).select("doc_id"), "doc_id", 64)
    files = groups.select("doc_id", F.floor(F.col("row_group") / 6).alias("file"), F.pmod("row_group", F.lit(6)).alias("row_group"))
    stream = C.rank_stream(C.epochs(files, 2), 1, 2, after=(1, 0, 2))
    return stream.groupBy(F.col("epoch").cast("long").alias("epoch"), "file", "row_group").agg(F.count("*").alias("docs"))


@query("download_plan", "SELECT i AS shard FROM (SELECT i FROM range(0, 20) r(i) UNION SELECT 6542) WHERE i NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def download_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted shards and the last one, less those that are there."""
    wanted = spark.range(20).select(F.col("id").alias("shard")).union(spark.range(6542, 6543)).distinct()
    there = docs(spark, sf_dir, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").cast("long").alias("shard"))
    return wanted.join(there, "shard", "left_anti")


@query("late_hints", """
WITH p AS (SELECT doc_id, regexp_replace(regexp_replace(text, '(?s)```.*?```', ' ', 'g'), '`[^`]*`', ' ', 'g') AS t FROM documents)
SELECT doc_id, regexp_matches(t, '\\b(?:198[5-9]|199[0-9]|20[0-9]{2}|21[0-9]{2})\\b') OR len(list_filter([KEYS], lambda k: contains(lower(t), k))) > 0 AS hit FROM p
""".replace("KEYS", ", ".join("'" + k.lower() + "'" for k in T.LATE_KEYWORDS)).replace("\\\\", "\\"))  # fmt: skip
def late_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", T.late_hints(F.col("text")).alias("hit"))


@query("late_hints_whole_words", """
WITH p AS (SELECT doc_id, regexp_replace(regexp_replace(text, '(?s)```.*?```', ' ', 'g'), '`[^`]*`', ' ', 'g') AS t FROM documents)
SELECT doc_id, regexp_matches(t, '\\b(?:198[5-9]|199[0-9]|20[0-9]{2}|21[0-9]{2})\\b') OR regexp_matches(lower(t), '\\b(?:KEYS)\\b') AS hit FROM p
""".replace("KEYS", "|".join(k.lower().replace(".", "[.]") for k in T.LATE_KEYWORDS)).replace("\\\\", "\\"))  # fmt: skip
def late_hints_whole_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", T.late_hints(F.col("text"), whole_words=True).alias("hit"))


YEARS = "('1905'), ('c1905'), ('[1905?]'), ('999'), ('2101'), (''), (NULL), ('in 1776 and 1812'), ('20x'), ('1999-05-01'), (' 1850 ')"


@query("parse_years", rf"""
SELECT v AS value, coalesce(CASE WHEN regexp_matches(trim(v), '^[0-9]{{1,9}}$') AND try_cast(trim(v) AS INTEGER) BETWEEN 1000 AND 2100 THEN try_cast(trim(v) AS INTEGER) END,
    try_cast(nullif(regexp_extract(v, '\b(1[0-9]{{3}}|20[0-9]{{2}})\b', 1), '') AS INTEGER)) AS year FROM (VALUES {YEARS}) t(v)""")  # fmt: skip
def parse_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {YEARS} AS t(value)").select("value", T.parse_year(F.col("value")).alias("year"))


@query("temporal_cutoff", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE year(o_orderdate) < 2000 GROUP BY o_orderpriority")
def temporal_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir, "orders").filter(T.before(F.year("o_orderdate"), 2000)).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("stream_caps", "SELECT source, doc_id FROM documents WHERE length(text) >= 50 QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 7")
def stream_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first documents of each stream after its filter: the cap is the feature."""
    place = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    return docs(spark, sf_dir).filter(F.length("text") >= 50).select("source", "doc_id", place.alias("n")).filter("n <= 7").drop("n")


@query("task_slice", "SELECT (i - 5) // 3 AS idx, doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) WHERE i >= 5 AND i < 100 AND (i - 5) % 3 = 0")
def task_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ordering.numbered(docs(spark, sf_dir).select("doc_id"), "idx", "doc_id")
    return C.task_slice(rows, 5, 100, 3).select("idx", "doc_id")


@query("hash_shuffle_head", "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5('1337:' || doc_id), doc_id) <= 5")
def hash_shuffle_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded sample of each stream."""
    place = F.row_number().over(Window.partitionBy("source").orderBy(C.hash_order(1337, "doc_id"), "doc_id"))
    return docs(spark, sf_dir).select("source", "doc_id", place.alias("n")).filter("n <= 5").drop("n")


@query("mixture_epochs", """
WITH m AS (SELECT 'chat' AS task, conv_id AS idx FROM (SELECT DISTINCT conv_id FROM conversations) UNION ALL SELECT 'chat', conv_id FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL SELECT 'docs', doc_id FROM documents WHERE lang = 'es')
SELECT task, idx, count(*) AS copies FROM m GROUP BY task, idx""")  # fmt: skip
def mixture_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixture in which one task counts twice, and its members in hash order."""
    chat = C.epochs(docs(spark, sf_dir, "conversations").select(F.col("conv_id").alias("idx")).distinct(), 2).select(F.lit("chat").alias("task"), "idx")
    rest = docs(spark, sf_dir).filter("lang = 'es'").select(F.lit("docs").alias("task"), F.col("doc_id").alias("idx"))
    return chat.unionByName(rest).groupBy("task", "idx").agg(F.count("*").alias("copies"))


@query("task_sequence", "SELECT task_no, local_idx, id FROM (SELECT 0 AS task_no, n_nationkey::BIGINT AS id, row_number() OVER (ORDER BY n_nationkey) - 1 AS local_idx FROM nation UNION ALL SELECT 1, r_regionkey::BIGINT, row_number() OVER (ORDER BY r_regionkey) - 1 FROM region)")
def task_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks one after the other, addressed by task and place."""
    parts = [ordering.numbered(docs(spark, sf_dir, t).select(F.col(k).cast("long").alias("id")), "local_idx", "id").withColumn("task_no", F.lit(n)) for n, (t, k) in enumerate((("nation", "n_nationkey"), ("region", "r_regionkey")))]
    return parts[0].unionByName(parts[1]).select("task_no", "local_idx", "id")


@query("disjoint_split", "SELECT source, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 10 THEN 'val' ELSE 'train' END AS split, doc_id FROM documents")
def disjoint_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ordering.numbered(docs(spark, sf_dir).select("source", "doc_id"), "i", "doc_id", by=["source"])
    return rows.select("source", F.when(F.col("i") < 10, "val").otherwise("train").alias("split"), "doc_id")


@query("unknown_streams", "SELECT source FROM (SELECT DISTINCT source FROM documents) EXCEPT SELECT source FROM (VALUES ('src0'), ('src1'), ('src2'), ('src3')) t(source)")
def unknown_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("source").distinct().join(spark.createDataFrame([(s,) for s in WEIGHTS], "source string"), "source", "left_anti")


@query("passages", """
SELECT doc_id, CASE WHEN length(text) <= 400 THEN text ELSE substr(text, 1 + (ascii(md5('7:' || doc_id)[1]) * 7919 + doc_id) % (length(text) - 400), 400) END AS passage FROM documents""")  # fmt: skip
def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window of each text at a place drawn by a hash; short texts whole."""
    n = F.length("text")
    start = F.pmod(F.ascii(F.substring(C.hash_order(7, "doc_id"), 1, 1)) * 7919 + F.col("doc_id"), n - 400) + 1
    return docs(spark, sf_dir).select("doc_id", F.when(n <= 400, F.col("text")).otherwise(F.substring(F.col("text"), start.cast("int"), F.lit(400))).alias("passage"))
