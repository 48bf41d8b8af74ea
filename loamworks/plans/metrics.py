"""Queries on evaluation metrics, schedules, regressions and reports."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import schedules as H
from ..operators import bpe
from ..operators import metrics as X
from ..registry import query
from .corpus import docs

# Doubles are rounded in both engines, since the order of a sum is free.
TASKS = "(VALUES ('en', 25.0), ('fr', 10.0), ('de', 0.0)) b(lang, baseline)"


def _baselines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("en", 25.0), ("fr", 10.0), ("de", 0.0)], "lang string, baseline double")


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir, "labels").join(docs(spark, sf_dir).select("doc_id", "lang", "source"), "doc_id")


OUT = "o AS (SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source FROM labels l JOIN documents d USING (doc_id))"


@query("task_accuracy", f"WITH {OUT} SELECT lang, count(*) AS n, round(avg(quality::DOUBLE), 9) AS accuracy FROM o GROUP BY lang")
def task_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg(F.col("quality").cast("double")), 9).alias("accuracy"))


@query("centered_accuracy", f"WITH {OUT}, a AS (SELECT lang, avg(quality::DOUBLE) AS acc FROM o GROUP BY lang) SELECT lang, round((acc - 0.01 * baseline) / (1 - 0.01 * baseline), 9) AS centered FROM a JOIN {TASKS} USING (lang)")
def centered_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks with their random baselines; a task without one drops out."""
    acc = _outcomes(spark, sf_dir).groupBy("lang").agg(F.avg(F.col("quality").cast("double")).alias("acc"))
    return acc.join(_baselines(spark), "lang").select("lang", F.round(X.centered(F.col("acc"), F.col("baseline")), 9).alias("centered"))


@query("core_score", f"WITH {OUT}, a AS (SELECT lang, avg(quality::DOUBLE) AS acc FROM o GROUP BY lang) SELECT round(avg((acc - 0.01 * coalesce(baseline, 0)) / (1 - 0.01 * coalesce(baseline, 0))), 9) AS core, count(*) AS tasks FROM a LEFT JOIN {TASKS} USING (lang)")
def core_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of centered accuracies over all tasks, baseline 0 where none is known."""
    acc = _outcomes(spark, sf_dir).groupBy("lang").agg(F.avg(F.col("quality").cast("double")).alias("acc"))
    both = acc.join(_baselines(spark), "lang", "left").withColumn("c", X.centered(F.col("acc"), F.coalesce("baseline", F.lit(0.0))))
    return both.agg(F.round(F.avg("c"), 9).alias("core"), F.count("*").alias("tasks"))


@query("chat_core_if_complete", f"WITH {OUT}, a AS (SELECT lang, avg(quality::DOUBLE) AS acc FROM o GROUP BY lang) SELECT CASE WHEN count(*) = 4 THEN round(avg(acc), 9) END AS chat_core, round(avg(acc) FILTER (lang IN ('en', 'fr')), 9) AS categorical FROM a")
def chat_core_if_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mean over all four tasks only if all are there, and one over some of them."""
    acc = _outcomes(spark, sf_dir).groupBy("lang").agg(F.avg(F.col("quality").cast("double")).alias("acc"))
    return acc.agg(F.when(F.count("*") == 4, F.round(F.avg("acc"), 9)).alias("chat_core"), F.round(F.avg(F.when(F.col("lang").isin("en", "fr"), F.col("acc"))), 9).alias("categorical"))


@query("bits_per_byte", """
WITH t AS (SELECT doc_id, source, ascii(unnest(string_split(text, ''))) AS id FROM documents),
l AS (SELECT source, CASE WHEN id % 7 = 0 THEN -1 ELSE id END AS id, 0.5 + (id % 13) / 10.0 AS nats FROM t),
b AS (SELECT source, CASE WHEN id < 0 OR id = 32 THEN 0 WHEN id > 127 THEN 2 ELSE 1 END AS n, nats FROM l)
SELECT source, sum(n)::BIGINT AS bytes, round(sum(CASE WHEN n > 0 THEN nats ELSE 0 END) / (ln(2) * sum(n)), 9) AS bpb FROM b GROUP BY source""")  # fmt: skip
def bits_per_byte(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Losses of targets joined with their byte lengths; ignored and special targets have none."""
    chars = docs(spark, sf_dir).select("source", F.explode_outer(F.split("text", "")).alias("c")).filter("c <> ''")
    t = chars.select("source", F.ascii("c").alias("id")).withColumn("nats", 0.5 + F.pmod("id", F.lit(13)) / 10.0).withColumn("id", F.when(F.col("id") % 7 == 0, -1).otherwise(F.col("id")))
    n = F.when((F.col("id") < 0) | (F.col("id") == 32), 0).when(F.col("id") > 127, 2).otherwise(1)
    return t.withColumn("n", n).groupBy("source").agg(F.sum("n").alias("bytes"), F.round(X.bits_per_byte("nats", "n"), 9).alias("bpb"))


@query("any_outcome_passes", "SELECT o_custkey AS problem, bool_or(o_orderstatus = 'F') AS passed FROM orders GROUP BY o_custkey")
def any_outcome_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("problem")).agg(F.bool_or(F.col("o_orderstatus") == "F").alias("passed"))


@query("pass_at_k", """
WITH s AS (SELECT l_orderkey AS p, l_linenumber AS i, l_returnflag = 'R' AS ok FROM lineitem),
f AS (SELECT p, min(CASE WHEN ok THEN i END) AS first FROM s GROUP BY p)
SELECT k::INTEGER AS k, round(avg(CASE WHEN first <= k THEN 1.0 ELSE 0.0 END), 9) AS pass_at_k FROM f, range(1, 5) r(k) GROUP BY k""")  # fmt: skip
def pass_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = docs(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("i"), (F.col("l_returnflag") == "R").alias("ok"))
    out = X.pass_at_k(s, 4, "l_orderkey", "i", "ok")
    return out.select("k", F.round("pass_at_k", 9).alias("pass_at_k"))


@query("categorical_argmax", "SELECT vec_id, chr(65 + (list_position(embedding[1:4], list_max(embedding[1:4])) - 1)::INTEGER) AS letter, label % 4 = list_position(embedding[1:4], list_max(embedding[1:4])) - 1 AS correct FROM embeddings")
def categorical_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The allowed letter with the largest logit, the first among equals."""
    four = F.slice("embedding", 1, 4)
    at = F.array_position(four, F.array_max(four)) - 1
    return docs(spark, sf_dir, "embeddings").select("vec_id", F.char(65 + at).alias("letter"), (F.pmod("label", F.lit(4)) == at).alias("correct"))


@query("lowest_mean_loss", """
WITH l AS (SELECT l_orderkey AS item, l_linenumber % 4 AS option, l_discount AS loss FROM lineitem),
m AS (SELECT item, option, avg(loss) AS m FROM l GROUP BY item, option)
SELECT item, arg_min(option, {'m': round(m, 9), 'o': option}) AS choice FROM m GROUP BY item""")  # fmt: skip
def lowest_mean_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = docs(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("item"), F.pmod("l_linenumber", F.lit(4)).alias("option"), F.col("l_discount").alias("loss"))
    means = l.groupBy("item", "option").agg(F.round(F.avg("loss"), 9).alias("loss"))
    return X.lowest_mean_loss(means, ["item"], "option", "loss")


@query("all_tokens_equal", "SELECT l_orderkey AS item, bool_and(l_quantity >= 5) AS correct FROM lineitem WHERE l_linenumber BETWEEN 2 AND 4 GROUP BY l_orderkey")
def all_tokens_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A continuation counts when every predicted token of its span is right."""
    span = docs(spark, sf_dir, "lineitem").filter(F.col("l_linenumber").between(2, 4))
    return span.groupBy(F.col("l_orderkey").alias("item")).agg(F.bool_and(F.col("l_quantity") >= 5).alias("correct"))


@query("common_lengths", """
WITH s AS (SELECT lang, string_split(text, ' ') AS x FROM documents),
p AS (SELECT lang, unnest(x) AS w, unnest(range(1, len(x) + 1)) AS i FROM s),
d AS (SELECT lang, min(i) - 1 AS first FROM (SELECT lang, i FROM p GROUP BY lang, i HAVING min(w) <> max(w)) GROUP BY lang),
n AS (SELECT lang, min(len(x)) AS least FROM s GROUP BY lang)
SELECT lang, least(least, coalesce(first, least))::INTEGER AS n FROM n LEFT JOIN d USING (lang)""")  # fmt: skip
def common_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many leading ids the members of a group share."""
    s = docs(spark, sf_dir).select("lang", F.split("text", " ").alias("x"))
    return X.common_length(s, "lang", "x").select("lang", F.col("n").cast("int").alias("n"))


BYTES = "[256] || list_transform(range(octet_length(encode({0}))), lambda i: ('0x' || substr(hex(encode({0})), (2 * i + 1)::INTEGER, 2))::INTEGER)"


@query("prompt_spans", f"""
WITH b AS (SELECT item_id, n_nationkey AS option, text || ' ' || n_name AS "after", n_name || ' ' || text AS "before", text FROM benchmark JOIN nation ON item_id % 5 = n_regionkey),
s AS (SELECT 'multiple_choice' AS kind, item_id AS item, option, {BYTES.format('"after"')} AS x FROM b
      UNION ALL SELECT 'schema', item_id, option, list_reverse({BYTES.format('"before"')}) FROM b),
p AS (SELECT kind, item, unnest(x) AS w, unnest(range(1, len(x) + 1)) AS i FROM s),
d AS (SELECT kind, item, min(i) - 1 AS first FROM (SELECT kind, item, i FROM p GROUP BY ALL HAVING min(w) <> max(w)) GROUP BY ALL),
n AS (SELECT kind, item, least(min(len(x)), coalesce(min(first), min(len(x)))) AS n FROM s LEFT JOIN d USING (kind, item) GROUP BY ALL)
SELECT kind, item, option::INTEGER AS option, (CASE kind WHEN 'schema' THEN len(x) - n ELSE n END)::INTEGER AS span_start, len(x)::INTEGER AS span_end FROM s JOIN n USING (kind, item)
UNION ALL SELECT 'language_modeling', item_id * 100 + option, 1, 1 + octet_length(encode(text)), 1 + octet_length(encode("after")) FROM b""")  # fmt: skip
def prompt_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the losses of an answer count: after a shared start, in a shared end, after a prompt."""
    b = docs(spark, sf_dir, "benchmark").join(docs(spark, sf_dir, "nation"), F.pmod("item_id", F.lit(5)) == F.col("n_regionkey"))
    after, before = F.concat_ws(" ", "text", "n_name"), F.concat_ws(" ", "n_name", "text")
    item, option = F.col("item_id").alias("item"), F.col("n_nationkey").cast("int").alias("option")
    choices = b.select(item, option, bpe.byte_ids(after, 256).alias("ids"))
    schemas = b.select(item, option, bpe.byte_ids(before, 256).alias("ids"))
    alone = (F.col("item_id") * 100 + F.col("n_nationkey")).alias("item")
    texts = b.select(alone, F.posexplode(F.array("text", after)).alias("option", "text")).select("item", "option", bpe.byte_ids(F.col("text"), 256).alias("ids"))
    kinds = {"multiple_choice": choices, "schema": schemas, "language_modeling": texts}
    first, *others = (X.prompt_spans(rows, kind).select(F.lit(kind).alias("kind"), "item", "option", "span_start", "span_end") for kind, rows in kinds.items())
    for more in others:
        first = first.unionByName(more)
    return first


@query("relative_advantage", "WITH r AS (SELECT o_custkey AS g, o_orderkey AS i, (o_orderstatus = 'F')::INTEGER AS reward FROM orders) SELECT i, reward, round(reward - avg(reward) OVER (PARTITION BY g), 9) AS advantage FROM r")
def relative_advantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = docs(spark, sf_dir, "orders").select(F.col("o_custkey").alias("g"), F.col("o_orderkey").alias("i"), (F.col("o_orderstatus") == "F").cast("int").alias("reward"))
    return X.advantages(r, "g", "reward").select("i", "reward", F.round("advantage", 9).alias("advantage"))


@query("mean_of_rank_means", "SELECT round(avg(m), 9) AS reward, round(avg(n), 9) AS length FROM (SELECT o_orderkey % 8 AS rank, avg((o_orderstatus = 'F')::INTEGER) AS m, avg(length(o_orderpriority)) AS n FROM orders GROUP BY 1)")
def mean_of_rank_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = docs(spark, sf_dir, "orders").groupBy(F.pmod("o_orderkey", F.lit(8)).alias("rank")).agg(F.avg((F.col("o_orderstatus") == "F").cast("int")).alias("m"), F.avg(F.length("o_orderpriority")).alias("n"))
    return ranks.agg(F.round(F.avg("m"), 9).alias("reward"), F.round(F.avg("n"), 9).alias("length"))


@query("valid_targets", "SELECT source, greatest(sum(CASE WHEN doc_id % 5 > 2 THEN 1 ELSE 0 END), 1)::BIGINT AS n FROM documents GROUP BY source")
def valid_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).groupBy("source").agg(F.greatest(F.count_if(F.col("doc_id") % 5 > 2), F.lit(1)).alias("n"))


@query("outcome_counters", "SELECT user_id % 10 AS category, count(*) FILTER (event_type IN ('view', 'click')) AS accepted, count(*) FILTER (event_type = 'purchase') AS rejected, count(*) FILTER (event_type IN ('error', 'signup')) AS errors FROM events GROUP BY 1")
def outcome_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_type")
    return docs(spark, sf_dir, "events").groupBy(F.pmod("user_id", F.lit(10)).alias("category")).agg(F.count_if(e.isin("view", "click")).alias("accepted"), F.count_if(e == "purchase").alias("rejected"), F.count_if(e.isin("error", "signup")).alias("errors"))


@query("error_streaks", """
WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'error' THEN 1 ELSE 0 END AS bad, sum(CASE event_type WHEN 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM events),
s AS (SELECT user_id, sum(bad) OVER (PARTITION BY user_id, island ORDER BY event_id) AS streak FROM e)
SELECT user_id, max(streak)::BIGINT AS longest, max(streak) >= 5 AS broken FROM s GROUP BY user_id""")  # fmt: skip
def error_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors since the last accept; a run breaks off at the fifth."""
    e = docs(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "error", "filter_error").when(F.col("event_type") == "purchase", "accepted").otherwise("rejected").alias("outcome"))
    return X.error_streaks(e, "event_id", "outcome", "user_id").groupBy("user_id").agg(F.max("streak").alias("longest"), (F.max("streak") >= 5).alias("broken"))


@query("smoothed_loss", """
WITH e AS (SELECT user_id, list(value ORDER BY event_id) AS v FROM events GROUP BY user_id)
SELECT user_id, round(list_sum(list_transform(range(1, len(v) + 1), lambda i: 0.1 * pow(0.9, len(v) - i) * v[i])) / (1 - pow(0.9, len(v))), 6) AS ema, round(list_min(v), 6) AS least FROM e""")  # fmt: skip
def smoothed_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bias-corrected mean of a user's values in order, and their least."""
    v = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "value"))), lambda x: x["value"])
    e = docs(spark, sf_dir, "events").groupBy("user_id").agg(v.alias("v"))
    return e.select("user_id", F.round(X.ema(F.col("v")), 6).alias("ema"), F.round(F.array_min("v"), 6).alias("least"))


@query("running_minimum", "SELECT event_id, min(value) OVER (PARTITION BY user_id ORDER BY event_id) AS best FROM events")
def running_minimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return docs(spark, sf_dir, "events").select("event_id", F.min("value").over(w).alias("best"))


GROUPS = [("wte", 12), ("value_embeds", 3), ("lm_head", 12), ("transformer_matrices", 85), ("scalars", 1)]


@query("parameter_counts", "SELECT * FROM (VALUES (113::BIGINT, 97::BIGINT, true)) t(total, effective, consistent)")
def parameter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters by group, the share that scales, and a check of the total."""
    g = spark.createDataFrame(GROUPS, "grp string, n long")
    return g.agg(F.sum("n").alias("total"), F.sum(F.when(F.col("grp").isin("lm_head", "transformer_matrices"), F.col("n"))).alias("effective"), (F.sum("n") == 113).alias("consistent"))


@query("flops_per_token", "SELECT d AS depth, (6 * (d * 1000 - 200) + sum(12 * 4 * 64 * CASE WHEN i % 4 = 3 THEN 2048 ELSE 512 END))::BIGINT AS flops FROM range(4, 13, 4) r(d), range(0, d) l(i) GROUP BY d")
def flops_per_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six a parameter, and attention over each layer's window."""
    layers = spark.range(4, 13, 4).select(F.col("id").alias("depth")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("depth") - 1)))
    window = F.when(F.pmod("i", F.lit(4)) == 3, 2048).otherwise(512)
    return layers.groupBy("depth").agg((6 * (F.first("depth") * 1000 - 200) + F.sum(12 * 4 * 64 * window)).alias("flops"))


@query("first_row_a_group", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1")
def first_row_a_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By a map-side minimum rather than a window."""
    return docs(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(F.struct("o_orderkey", "o_totalprice")).alias("r")).select("o_custkey", "r.o_orderkey", "r.o_totalprice")


SWEEP = [(c, n, b) for c in (1e18, 2e18, 5e18) for n, b in ((7.0, 1.02 - c / 1e20), (7.3, 0.95 - c / 1e20), (7.6, 0.93 - c / 1e20), (7.9, 0.96 - c / 1e20), (8.2, 1.05 - c / 1e20))] + [(1e19, 7.0, 1.0), (1e19, 7.5, 1.1), (1e19, 8.0, 0.9)]
SWEEP_SQL = "(VALUES " + ", ".join(f"({c!r}::DOUBLE, {n!r}::DOUBLE, {b!r}::DOUBLE)" for c, n, b in SWEEP) + ") t(c, x, y)"
FIT_SQL = f"""
m AS (SELECT *, x - avg(x) OVER (PARTITION BY c) AS u, avg(x) OVER (PARTITION BY c) AS mx FROM {SWEEP_SQL}),
s AS (SELECT c, any_value(mx) AS mx, count(*)::DOUBLE AS n, sum(u) AS s1, sum(u ** 2) AS s2, sum(u ** 3) AS s3, sum(u ** 4) AS s4, sum(y) AS t0, sum(y * u) AS t1, sum(y * u * u) AS t2, arg_min(x, y) AS raw FROM m GROUP BY c),
d AS (SELECT *, n * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS det FROM s),
f AS (SELECT c, mx, raw, (n * (s2 * t2 - s3 * t1) - s1 * (s1 * t2 - s3 * t0) + s2 * (s1 * t1 - s2 * t0)) / det AS a, (n * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - t1 * s2)) / det AS b FROM d),
v AS (SELECT c, a, CASE WHEN a > 0 THEN mx - b / (2 * a) ELSE raw END AS x_min FROM f)"""


def _sweep(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SWEEP, "c double, x double, y double")


@query("isoflop_minima", f"WITH {FIT_SQL} SELECT c, round(a, 6) AS a, round(x_min, 6) AS x_min FROM v")
def isoflop_minima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parabola a budget and its vertex; the best point where it opens downwards."""
    return X.quadratic_minimum(_sweep(spark), "c", "x", "y").select("c", F.round("a", 6).alias("a"), F.round("x_min", 6).alias("x_min"))


@query("isoflop_interpolated", f"""WITH {FIT_SQL},
    p AS (SELECT c, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM {SWEEP_SQL} WINDOW w AS (PARTITION BY c ORDER BY x))
    SELECT c, round(coalesce(max(CASE WHEN x_min >= x0 AND x_min < x1 THEN y0 + (y1 - y0) * (x_min - x0) / (x1 - x0) END), CASE WHEN any_value(x_min) < min(x0) THEN arg_min(y0, x0) ELSE arg_max(y0, x0) END), 6) AS value FROM p JOIN v USING (c) GROUP BY c""")  # fmt: skip
def isoflop_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = X.quadratic_minimum(_sweep(spark), "c", "x", "y")
    return X.interpolated(_sweep(spark), best, "c", "x", "y", "x_min").select("c", F.round("value", 6).alias("value"))


@query("power_law_fit", "SELECT round(regr_slope(ln(o_totalprice), ln(o_orderkey + 1)), 6) AS slope, round(regr_intercept(ln(o_totalprice), ln(o_orderkey + 1)), 6) AS icept, round(regr_r2(ln(o_totalprice), ln(o_orderkey + 1)), 6) AS r2, round(sqrt(min(o_totalprice) * max(o_totalprice)), 4) AS mid, round(stddev_samp(o_totalprice), 4) AS spread FROM orders")
def power_law_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line through logarithms, its fit, and the geometric middle of a range."""
    y, x = F.log("o_totalprice"), F.log(F.col("o_orderkey") + 1)
    p = F.col("o_totalprice")
    return docs(spark, sf_dir, "orders").agg(F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 6).alias("icept"), F.round(F.regr_r2(y, x), 6).alias("r2"), F.round(F.sqrt(F.min(p) * F.max(p)), 4).alias("mid"), F.round(F.stddev_samp(p), 4).alias("spread"))


@query("ridge_fit", """
WITH s AS (SELECT count(*)::DOUBLE AS n, sum(l_quantity) AS x, sum(l_quantity * l_quantity) AS xx, sum(l_extendedprice) AS y, sum(l_quantity * l_extendedprice) AS xy FROM lineitem)
SELECT round((y * (xx + 10) - x * xy) / (n * (xx + 10) - x * x), 2) AS icept, round((n * xy - x * y) / (n * (xx + 10) - x * x), 4) AS slope FROM s""")  # fmt: skip
def ridge_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = X.ridge(docs(spark, sf_dir, "lineitem"), ["l_quantity"], "l_extendedprice", 10.0)
    return spark.createDataFrame([(round(a, 2), round(b, 4))], "icept double, slope double")


@query("tokens_per_parameter", f"SELECT c, x, round(c / (6 * 10 ** x), 0) AS tokens, round(c / (6 * 10 ** x) / 10 ** x, 6) AS ratio FROM {SWEEP_SQL}")
def tokens_per_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.pow(F.lit(10.0), F.col("x"))
    return _sweep(spark).select("c", "x", F.round(F.col("c") / (6 * n), 0).alias("tokens"), F.round(F.col("c") / (6 * n) / n, 6).alias("ratio"))


@query("families_by_size", "SELECT s_name AS model, s_acctbal AS score, 'measured' AS kind FROM supplier UNION ALL SELECT c_name, c_acctbal, 'estimated' FROM customer")
def families_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two families of one schema in one table, in the order of their score."""
    a = docs(spark, sf_dir, "supplier").select(F.col("s_name").alias("model"), F.col("s_acctbal").alias("score"), F.lit("measured").alias("kind"))
    b = docs(spark, sf_dir, "customer").select(F.col("c_name").alias("model"), F.col("c_acctbal").alias("score"), F.lit("estimated").alias("kind"))
    return a.unionByName(b).orderBy("score")


@query("report_pivot", """
WITH r AS (SELECT CASE lang WHEN 'en' THEN 'CORE' WHEN 'fr' THEN 'ChatCORE' ELSE lang END AS metric, CASE doc_id % 4 WHEN 0 THEN 'base' WHEN 1 THEN 'sft' ELSE 'rl' END AS stage, count(*)::VARCHAR AS value FROM documents WHERE doc_id % 4 <> 1 OR lang <> 'de' GROUP BY 1, 2)
SELECT metric, coalesce(max(value) FILTER (stage = 'base'), '-') AS base, coalesce(max(value) FILTER (stage = 'sft'), '-') AS sft, coalesce(max(value) FILTER (stage = 'rl'), '-') AS rl, CASE metric WHEN 'CORE' THEN 0 WHEN 'ChatCORE' THEN 2 ELSE 1 END AS place FROM r GROUP BY metric""")  # fmt: skip
def report_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir).filter("doc_id % 4 <> 1 or lang <> 'de'")
    metric = F.when(F.col("lang") == "en", "CORE").when(F.col("lang") == "fr", "ChatCORE").otherwise(F.col("lang"))
    stage = F.when(F.col("doc_id") % 4 == 0, "base").when(F.col("doc_id") % 4 == 1, "sft").otherwise("rl")
    rows = d.groupBy(metric.alias("metric"), stage.alias("stage")).agg(F.count("*").cast("string").alias("value"))
    return X.report(rows, ["base", "sft", "rl"])


@query("wall_clock", "SELECT user_id, (epoch_us(max(ts)) - epoch_us(min(ts))) // 60000000 // 60 AS hours, (epoch_us(max(ts)) - epoch_us(min(ts))) // 60000000 % 60 AS minutes FROM events WHERE event_type <> 'signup' GROUP BY user_id")
def wall_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the first to the last stamp, without excluded sections."""
    span = F.floor((F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 60_000_000)
    return docs(spark, sf_dir, "events").filter("event_type <> 'signup'").groupBy("user_id").agg(span.alias("m")).select("user_id", F.floor(F.col("m") / 60).alias("hours"), F.pmod("m", F.lit(60)).alias("minutes"))


@query("throughput", "SELECT user_id, count(*) AS steps, round(sum(CASE WHEN n > 10 THEN value END), 6) AS seconds, round(count(*) FILTER (n > 10) * 1000 / sum(CASE WHEN n > 10 THEN value END), 6) AS rate FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) GROUP BY user_id")
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates without the first ten steps."""
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    warm = F.when(F.col("n") > 10, F.col("value"))
    return docs(spark, sf_dir, "events").withColumn("n", n).groupBy("user_id").agg(F.count("*").alias("steps"), F.round(F.sum(warm), 6).alias("seconds"), F.round(F.try_divide(F.count(warm) * 1000, F.sum(warm)), 6).alias("rate"))


@query("batch_plan", f"""
WITH t AS (SELECT d AS depth, d * d * d * 1e6 AS tokens, 1728e6 AS ref FROM range(4, 33, 4) r(d)),
b AS (SELECT *, pow(2, round_even(log2({H.BATCH_REF} * pow(tokens / ref, {H.BATCH_POWER})), 0))::BIGINT AS batch FROM t)
SELECT depth, batch, round(sqrt(batch / {H.BATCH_REF}), 9) AS rate_scale, round(sqrt(batch / {H.BATCH_REF}) * (ref / tokens), 9) AS decay_scale FROM b""")  # fmt: skip
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("id").cast("double")
    t = spark.range(4, 33, 4).select(F.col("id").alias("depth"), (d * d * d * 1e6).alias("tokens"), F.lit(1728e6).alias("ref"))
    b = t.withColumn("batch", H.batch_size(F.col("tokens"), F.col("ref")))
    return b.select("depth", "batch", F.round(H.rate_scale(F.col("batch")), 9).alias("rate_scale"), F.round(H.weight_decay_scale(F.col("batch"), F.col("tokens"), F.col("ref")), 9).alias("decay_scale"))


@query("schedules", f"""
SELECT i AS step, round(CASE WHEN i < 20 THEN (i + 1) / 20.0 WHEN i <= 500 THEN 1.0 ELSE (1000 - i) / 500.0 + (1 - (1000 - i) / 500.0) * 0.05 END, 9) AS rate,
    round(CASE WHEN i < 400 THEN (1 - i / 400.0) * 0.85 + i / 400.0 * 0.97 WHEN i >= 500 THEN 0.97 * (1 - (i - 500) / 500.0) + 0.90 * ((i - 500) / 500.0) ELSE 0.97 END, 9) AS momentum,
    round(0.2 * 0.5 * (1 + cos({math.pi!r} * i / 1000.0)), 9) AS decay FROM range(0, 1001, 10) r(i)""")  # fmt: skip
def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("id")
    return spark.range(0, 1001, 10).select(i.alias("step"), F.round(H.rate_multiplier(i, 1000, 20, 0.5, 0.05), 9).alias("rate"), F.round(H.momentum(i, 1000, 0.5), 9).alias("momentum"), F.round(H.weight_decay(i, 1000, 0.2), 9).alias("decay"))


@query("subject_accuracy", f"WITH {OUT} SELECT source AS subject, count(*) AS n, round(avg(toxic::DOUBLE), 9) AS accuracy FROM o GROUP BY source")
def subject_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir).groupBy(F.col("source").alias("subject")).agg(F.count("*").alias("n"), F.round(F.avg(F.col("toxic").cast("double")), 9).alias("accuracy"))


@query("top_logits", "SELECT vec_id, list_position(embedding, list_max(embedding))::INTEGER - 1 AS best, list_transform(list_reverse_sort(embedding)[1:5], lambda x: round(x::DOUBLE, 6)) AS top FROM embeddings")
def top_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greedy choice and the five largest logits."""
    e = F.col("embedding")
    top = F.transform(F.slice(F.sort_array(e, asc=False), 1, 5), lambda x: F.round(x.cast("double"), 6))
    return docs(spark, sf_dir, "embeddings").select("vec_id", (F.array_position(e, F.array_max(e)) - 1).cast("int").alias("best"), top.alias("top"))


@query("sampled_tokens", """
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS id FROM embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, id) AS place, max(v) OVER (PARTITION BY vec_id) AS most FROM e),
w AS (SELECT vec_id, id, place, exp((v - most) / 0.7) AS w FROM r WHERE place <= 5),
c AS (SELECT *, sum(w) OVER (PARTITION BY vec_id ORDER BY place) AS so_far, sum(w) OVER (PARTITION BY vec_id) AS total FROM w)
SELECT vec_id, min_by(id, place)::INTEGER AS token FROM c WHERE so_far >= total * ((vec_id * 7919 % 1000003) / 1000003.0::DOUBLE) GROUP BY vec_id""")  # fmt: skip
def sampled_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of the five largest logits, at temperature 0.7, by a draw that SQL can reproduce."""
    draw = F.pmod(F.col("vec_id") * 7919, F.lit(1000003)) / F.lit(1000003.0)
    return docs(spark, sf_dir, "embeddings").select("vec_id", X.sampled_token(F.col("embedding"), draw, 0.7, 5).alias("token"))


@query("report_numbers", "SELECT * FROM (VALUES (0.12345678::DOUBLE, '0.1235'), (12345.0, '12,345'), (9999.0, '9999'), (3.0, '3'), (1234567.0, '1,234,567')) t(value, shown)")
def report_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(0.12345678,), (12345.0,), (9999.0,), (3.0,), (1234567.0,)], "value double").select("value", X.shown(F.col("value")).alias("shown"))
