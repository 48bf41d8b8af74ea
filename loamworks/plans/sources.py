"""Queries on sources, bookkeeping of synthetic runs, lookups and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import conversation as V
from ..functions.sandbox import calculator
from ..operators import synthesis as J
from ..operators import tasks
from ..operators.ordering import numbered
from ..registry import query
from ..sources import bibliography, books, chats, results
from .conversations import chats as conversations
from .corpus import docs


@query("link_listing", r"""SELECT DISTINCT unnest(regexp_extract_all(html, 'href="/([a-zA-Z]+)"', 1)) AS name FROM pages""")
def link_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in link lists, each once."""
    return bibliography.listed(docs(spark, sf_dir, "pages"), pattern=r'href="/([a-zA-Z]+)"')


@query("book_shapes", """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1800 + doc_id % 100 WHEN doc_id % 3 = 1 THEN 1850 + doc_id % 150 END::INTEGER AS year, length(text) AS n_chars
FROM documents WHERE CASE WHEN doc_id % 3 = 0 THEN 1800 + doc_id % 100 WHEN doc_id % 3 = 1 THEN 1850 + doc_id % 150 END < 1929""")  # fmt: skip
def book_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years from a column, else from JSON in a string (sometimes broken); before the cutoff."""
    year = F.when(F.col("doc_id") % 3 == 0, 1800 + F.col("doc_id") % 100)
    meta = F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit('{"year": "c'), F.lit("["), (1850 + F.col("doc_id") % 150).cast("string"), F.lit(']"}'))).otherwise(F.lit("{bad"))
    raw = docs(spark, sf_dir).select("doc_id", year.cast("string").alias("year"), meta.alias("METADATA"), F.col("text").alias("TEXT"))
    out = books.books(raw, ("year", "METADATA.year"), ("TEXT", "ocr"), cleaned=False)
    return out.select("doc_id", "year", F.length("text").alias("n_chars"))


ARTICLES = [
    (1, "<PubmedArticle><PubDate><Year>1970</Year></PubDate><ArticleTitle>On <i>quartz</i> &amp; more</ArticleTitle><Abstract><AbstractText Label=\"AIM\">To see q <i>it</i> r.</AbstractText><AbstractText>It was seen in all of the trials.</AbstractText></Abstract>"),
    (2, "<PubmedArticle><PubDate><MedlineDate>1984 Dec-1985 Jan</MedlineDate></PubDate><ArticleTitle>A title that alone is long enough to be kept as a text</ArticleTitle>"),
    (3, "<PubmedArticle><PubDate><Year>1984</Year></PubDate><ArticleTitle>Short</ArticleTitle>"),
    (4, "<PubmedArticle><PubDate><Year>1990</Year></PubDate><ArticleTitle>A title that alone is long enough to be kept as a text</ArticleTitle>"),
    (6, "<PubmedArticle><PubDate><Year>1984</Year></PubDate><ArticleTitle>Caf&#233; <![CDATA[a<b & c]]> &#x3b1;&amp;#1; <!-- no --> study of the whole of it and more</ArticleTitle>"),
    (5, "<PubmedArticle><PubDate></PubDate><ArticleTitle>A title that alone is long enough to be kept as a text</ArticleTitle>"),
]


@query("bibliographic_texts", """SELECT * FROM (VALUES (1970, 'On quartz & more' || chr(10) || chr(10) || 'AIM: To see q it r.' || chr(10) || 'It was seen in all of the trials.'), (1984, 'A title that alone is long enough to be kept as a text'), (1984, 'Café a<b & c α&#1;  study of the whole of it and more')) t(year, text)""")
def bibliographic_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(ARTICLES, "id int, xml string").select(*bibliography.records(F.col("xml")))
    return bibliography.texts(rows)


LINES = [
    (1, '{"messages": 1}'),
    (2, '[{"role": "user", "content": "hi"}, {"role": "assistant", "content": "ho"}]'),
    (3, '[{"role": "user", "content": "hi"}, {"role": "assistant", "content": [{"type": "text", "text": "a"}, {"type": "python", "text": "1+1"}]}]'),
    (4, '[{"role": "assistant", "content": "hi"}]'),
    (5, "not json"),
    (6, '[{"role": "system", "content": "s"}, {"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]'),
    (7, '[{"role": "user", "content": "u"}, {"role": "assistant", "content": "[{\\"type\\": \\"x\\", \\"text\\": \\"literal\\"}]"}]'),
]


@query("json_conversations", "SELECT * FROM (VALUES (2, 2, NULL, true), (3, 2, 'a1+1', true), (4, 1, NULL, false), (6, 3, NULL, true), (7, 2, NULL, true)) t(id, n, parts, valid)")
def json_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as conversations, contents as strings or parts, and whether roles alternate."""
    rows = spark.createDataFrame(LINES, "id int, value string")
    both = chats.parsed(rows).join(rows.withColumnRenamed("value", "line"), "line")
    parts = F.array_join(F.transform(F.get("messages", F.lit(1))["parts"], lambda p: p["text"]), "")
    return both.filter(F.get("messages", F.lit(0))["role"].isNotNull()).select("id", F.size("messages").alias("n"), parts.alias("parts"), "valid")


TABLE = "name   , size, score\n gpt-a , 12 ,  0.5 \n\ngpt-b, x, 0.25\n".split("\n")


@query("padded_table", "SELECT * FROM (VALUES ('gpt-a', 12.0::DOUBLE, 0.5::DOUBLE), ('gpt-b', NULL, 0.25)) t(name, size, score)")
def padded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.createDataFrame([(x,) for x in TABLE[1:]], "value string")
    return results.padded_csv(lines, ["name", "size", "score"])


@query("log_last_values", """
WITH l AS (SELECT user_id AS run, event_id AS line, 'step ' || event_type || ' loss: ' || round(value, 2)::DECIMAL(18, 2) AS value FROM events WHERE event_type <> 'view')
SELECT run, arg_max(regexp_extract(value, 'loss: ([0-9.]+)', 1), line) AS loss, arg_max(regexp_extract(value, 'step (error)', 1), CASE WHEN value LIKE '%step error%' THEN line END) AS failed FROM l GROUP BY run""")  # fmt: skip
def log_last_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last loss and error of each run's log."""
    line = F.concat(F.lit("step "), F.col("event_type"), F.lit(" loss: "), F.round("value", 2).cast("decimal(18,2)").cast("string"))
    log = docs(spark, sf_dir, "events").filter("event_type <> 'view'").select(F.col("user_id").alias("run"), F.col("event_id").alias("line"), line.alias("value"))
    return results.last_values(log, {"loss": r"loss: ([0-9.]+)", "failed": r"step (error)"}, "run", "line")


@query("report_sections", "SELECT user_id AS section, event_type AS metric, arg_max(round(value, 2)::DECIMAL(18, 2)::VARCHAR, event_id) AS value FROM events GROUP BY ALL")
def report_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and value lines of sections; the last of a key counts."""
    line = F.concat(F.lit("- "), F.col("event_type"), F.lit(": "), F.round("value", 2).cast("decimal(18,2)").cast("string"))
    rows = docs(spark, sf_dir, "events").select(F.col("user_id").alias("section"), "event_id", line.alias("value"))
    return results.sections(rows, "section", "event_id")


@query("checkpoints", "SELECT * FROM (VALUES ('d20', 20, 1500)) t(tag, depth, step)")
def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = spark.createDataFrame([("d12",), ("d20",), ("d3",), ("draft",)], "name string")
    steps = spark.createDataFrame([("model_000100.pt",), ("model_001500.pt",), ("meta_009999.json",)], "name string")
    return results.largest_model(tags).join(F.broadcast(results.last_step(steps)))  # one row each


@query("planned_minus_done", """
WITH p AS (SELECT 'qa' AS category, i AS idx FROM range(0, 300) r(i) UNION ALL SELECT 'code', i FROM range(300, 500) r(i)),
d AS (SELECT CASE WHEN doc_id < 300 THEN 'qa' ELSE 'code' END AS category, doc_id AS idx, CASE WHEN doc_id % 7 = 0 THEN 'error' ELSE 'accepted' END AS outcome FROM documents WHERE doc_id % 3 = 0)
SELECT category, count(*) AS pending, min(idx) AS first FROM p WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.category = p.category AND d.idx = p.idx) GROUP BY category""")  # fmt: skip
def planned_minus_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disjoint ranges by category, less what any outcome has been recorded for."""
    category = F.when(F.col("doc_id") < 300, "qa").otherwise("code")
    done = docs(spark, sf_dir).filter("doc_id % 3 = 0").select(category.alias("category"), F.col("doc_id").alias("idx"), F.when(F.col("doc_id") % 7 == 0, "error").otherwise("accepted").alias("outcome"))
    left = J.pending(J.planned(spark, {"qa": 300, "code": 200}), done)
    return left.groupBy("category").agg(F.count("*").alias("pending"), F.min("idx").alias("first"))


@query("seeded_choices", "SELECT doc_id, ['plain', 'formal', 'brief'][1 + ('0x' || substr(md5('11:' || doc_id), 1, 7))::BIGINT % 3] AS style, doc_id + CASE WHEN doc_id % 2 = 0 THEN 10000000 ELSE 0 END AS seed FROM documents")
def seeded_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A style by hash, and seeds of train and test that never meet."""
    split = F.when(F.col("doc_id") % 2 == 0, "test").otherwise("train")
    return docs(spark, sf_dir).select("doc_id", J.drawn(["plain", "formal", "brief"], 11, "doc_id").alias("style"), J.example_seed(F.col("doc_id"), split).alias("seed"))


@query("seeded_choices_exact")
def seeded_choices_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", J.drawn_exact(["plain", "formal", "brief"], "doc_id").alias("style"))


def _judge(prompt: str) -> str:
    """Stands in for a model: texts of even length are fine."""
    return "SAFE" if len(prompt) % 2 == 0 else "Looks modern. UNSAFE"


@query("screened_conversations", """
WITH m AS (SELECT conv_id, string_agg('### ' || upper(role) || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS f FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN 'CACHED' WHEN length(f) % 2 = 0 THEN 'SAFE' ELSE 'UNSAFE' END AS verdict, CASE WHEN conv_id % 5 = 0 OR length(f) % 2 = 0 THEN 1 ELSE 0 END AS safe
FROM m x WHERE NOT EXISTS (SELECT 1 FROM m y WHERE y.f = x.f AND y.conv_id <> x.conv_id)""")  # fmt: skip
def screened_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts from the cache where there are some, from the judge elsewhere."""
    given = conversations(spark, sf_dir)
    known = given.filter("conv_id % 5 = 0").select(V.content_hash(F.col("messages")).alias("hash"), F.lit(1).alias("safe"), F.lit("CACHED").alias("verdict"), F.lit("-").alias("reason"), F.lit("old").alias("model"))
    out, _ = J.screened(given, known.dropDuplicates(["hash"]), _judge)
    single = given.groupBy(V.content_hash(F.col("messages")).alias("hash")).count().filter("count = 1").select("hash")
    return out.join(single, "hash", "left_semi").select("conv_id", "verdict", "safe")


@query("cache_upsert", "SELECT o_custkey AS hash, 'v' || (o_custkey % 3) AS verdict FROM orders WHERE o_custkey % 2 = 0 GROUP BY o_custkey UNION ALL SELECT o_custkey, 'old' FROM orders WHERE o_custkey % 2 = 1 GROUP BY o_custkey")
def cache_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = docs(spark, sf_dir, "orders").select(F.col("o_custkey").alias("hash")).distinct()
    old = keys.withColumn("verdict", F.lit("old"))
    new = keys.filter("hash % 2 = 0").select("hash", F.concat(F.lit("v"), (F.col("hash") % 3).cast("string")).alias("verdict"))
    return J.upserted(old, new)


@query("sweep_runs_left", "SELECT c, d FROM (VALUES (1, 8), (1, 12), (2, 8), (2, 12)) t(c, d) WHERE NOT EXISTS (SELECT 1 FROM (VALUES (1, 12), (2, 8)) r(c, d) WHERE r.c = t.c AND r.d = t.d)")
def sweep_runs_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a sweep that have no result, by two keys."""
    all_ = spark.createDataFrame([(1, 8), (1, 12), (2, 8), (2, 12)], "c int, d int")
    return all_.join(spark.createDataFrame([(1, 12), (2, 8)], "c int, d int"), ["c", "d"], "left_anti")


@query("positional_lookup", "WITH d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM documents) SELECT o_orderkey, doc_id FROM orders JOIN d ON d.source = 'src' || (o_orderkey % 20) AND d.i = o_custkey % 30 WHERE o_orderstatus = 'F'")
def positional_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a mixture by task and place in the task."""
    d = numbered(docs(spark, sf_dir).select("doc_id", "source"), "i", "doc_id", by=["source"])
    o = docs(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", F.concat(F.lit("src"), (F.col("o_orderkey") % 20).cast("string")).alias("source"), (F.col("o_custkey") % 30).alias("i"))
    return o.join(d, ["source", "i"]).select("o_orderkey", "doc_id")


@query("category_topics", "SELECT r_name AS category, n_name AS topic FROM region, nation")
def category_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All combinations of two small fixed dimensions, by exploding the smaller one's list."""
    topics = docs(spark, sf_dir, "nation").agg(F.collect_list("n_name").alias("t"))
    r = docs(spark, sf_dir, "region").join(F.broadcast(topics))  # one row of 25 names
    return r.select(F.col("r_name").alias("category"), F.explode("t").alias("topic"))


SUMS = ["1+2*3", "12/60", "1,000+1", "2**3", "'strawberry'.count('r')", "__import__('os')", "1/0", "-(2-5)", ""]


@query("calculator", "SELECT * FROM (VALUES ('1+2*3', '7'), ('12/60', '0.2'), ('1,000+1', '1001'), ('2**3', NULL), ('''strawberry''.count(''r'')', '3'), ('__import__(''os'')', NULL), ('1/0', NULL), ('-(2-5)', '3'), ('', NULL)) t(expr, result)")
def calculator_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(x,) for x in SUMS], "expr string")
    return rows.select("expr", calculator(F.col("expr")).alias("result"))


@query("outcome_counts", "SELECT lang AS category, count(*) FILTER (doc_id % 4 = 0) AS accepted, count(*) FILTER (doc_id % 4 IN (1, 2)) AS rejected, count(*) FILTER (doc_id % 4 = 3) AS errors FROM documents GROUP BY lang")
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 4
    rows = docs(spark, sf_dir).select(F.col("lang").alias("category"), F.when(k == 0, "m").alias("messages"), F.when(k == 1, "blank text").when(k == 3, "gen err: x").alias("error"))
    return J.outcomes(rows)


@query("word_list", "SELECT DISTINCT lower(trim(p_type)) AS word, length(trim(p_type)) AS n FROM part WHERE trim(p_type) <> ''")
def word_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trimmed word a line, each once."""
    w = F.trim("p_type")
    return docs(spark, sf_dir, "part").filter(w != "").select(F.lower(w).alias("word"), F.length(w).alias("n")).distinct()


@query("ids_to_text", "SELECT n_nationkey AS id, n_name AS text FROM nation")
def ids_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte ids back to text through a vocabulary join."""
    from ..operators import bpe

    hexed = F.hex(F.encode("n_name", "utf-8"))
    ids = F.transform(F.sequence(F.lit(0), F.length("n_name") - 1), lambda i: F.conv(F.substring(hexed, i * 2 + 1, F.lit(2)), 16, 10).cast("int"))
    rows = docs(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), ids.alias("ids"))
    return bpe.decoded(rows, bpe.vocabulary(spark, {bytes([i]): i for i in range(256)}), "id")


@query("spelling_examples", """
WITH w AS (SELECT n_nationkey::BIGINT AS word_no, lower(n_name) AS word FROM nation),
h AS (SELECT i AS idx, i + 10000000 AS seed FROM range(0, 400) r(i)),
d AS (SELECT idx, seed, ('0x' || substr(md5('word:' || seed), 1, 7))::BIGINT % 25 AS word_no FROM h)
SELECT idx, word, CASE WHEN ('0x' || substr(md5('own:' || seed), 1, 7))::BIGINT % 10 < 9 THEN word[(('0x' || substr(md5('place:' || seed), 1, 7))::BIGINT % 1048576) % length(word) + 1] ELSE chr((97 + ('0x' || substr(md5('letter:' || seed), 1, 7))::BIGINT % 26)::INTEGER) END AS letter
FROM d JOIN w USING (word_no)""")  # fmt: skip
def spelling_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and letters of test examples, drawn by hashes."""
    words = docs(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("word_no"), F.lower("n_name").alias("word"))
    return tasks.spelling_examples(spark.range(400).withColumnRenamed("id", "idx"), words, "test", 25).select("idx", "word", "letter")


@query("spelling_graded", "SELECT 'spelling' AS task, 400::BIGINT AS n, 1.0::DOUBLE AS accuracy")
def spelling_graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples graded against their own worked answers."""
    words = docs(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("word_no"), F.lower("n_name").alias("word"))
    rows = tasks.spelling_examples(spark.range(400).withColumnRenamed("id", "idx"), words, "train", 25)
    replies = rows.select("idx", V.message_text(F.get("messages", F.lit(1))).alias("reply"))
    task = tasks.Task("spelling", rows.select("idx", F.concat(F.lit("#### "), F.col("answer").cast("string")).alias("answer")), "generative", tasks.numeric_grade)
    return tasks.evaluate(task, replies)


@query("items_by_type", """
WITH i AS (SELECT o_orderkey AS item, CASE o_orderkey % 3 WHEN 0 THEN 'multiple_choice' WHEN 1 THEN 'schema' ELSE 'language_modeling' END AS t, o_orderkey % 2 AS gold FROM orders),
m AS (SELECT l_orderkey AS item, l_linenumber % 2 AS option, avg(l_tax) AS m FROM lineitem GROUP BY ALL),
c AS (SELECT item, arg_min(option, {'m': round(m, 9), 'o': option}) AS choice FROM m GROUP BY item),
p AS (SELECT l_orderkey AS item, bool_and(l_returnflag <> 'R') AS correct FROM lineitem GROUP BY l_orderkey)
SELECT i.item, c.choice = i.gold AS correct FROM i JOIN c USING (item) WHERE t <> 'language_modeling' UNION ALL SELECT i.item, p.correct FROM i JOIN p USING (item) WHERE t = 'language_modeling'""")  # fmt: skip
def items_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choices and schemas by least mean loss, completions by agreement of all tokens."""
    kind = F.when(F.col("o_orderkey") % 3 == 0, "multiple_choice").when(F.col("o_orderkey") % 3 == 1, "schema").otherwise("language_modeling")
    items = docs(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"), kind.alias("task_type"), (F.col("o_orderkey") % 2).alias("gold"))
    lines = docs(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "item")
    losses = lines.groupBy("item", (F.col("l_linenumber") % 2).alias("option")).agg(F.round(F.avg("l_tax"), 9).alias("loss"))
    return tasks.by_type(items, losses, lines.select("item", F.col("l_returnflag").alias("predicted"), F.when(F.col("l_returnflag") == "R", "-").otherwise(F.col("l_returnflag")).alias("actual")))
