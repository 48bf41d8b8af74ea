"""Queries on conversations: assembly, validation, rendering, grading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import conversation as V
from ..functions import text as T
from ..functions.conversation import SPECIALS
from ..registry import query
from .corpus import docs


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.assemble(docs(spark, sf_dir, "conversations"))


M = "m AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS m FROM conversations GROUP BY conv_id)"
REST = "r AS (SELECT conv_id, m, CASE WHEN m[1].role = 'system' THEN m[2:] ELSE m END AS rest FROM m)"
TURNS = "len(list_filter(range(1, len({x}) + 1), lambda i: {x}[i].role <> CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END)) = 0"
FULL = "len(list_filter({x}, lambda y: trim(coalesce(y.content, '')) = '')) = 0"


@query("conversation_format", f"WITH {M} SELECT conv_id, array_to_string(list_transform(m, lambda x: '### ' || upper(x.role) || chr(10) || x.content), chr(10) || chr(10)) AS formatted FROM m")
def conversation_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select("conv_id", V.formatted(F.col("messages")).alias("formatted"))


@query("conversation_hash", f"""WITH {M} SELECT conv_id, sha256('[' || array_to_string(list_transform(m, lambda x: '{{"content": ' || to_json(x.content)::VARCHAR || ', "role": ' || to_json(x.role)::VARCHAR || '}}'), ', ') || ']') AS hash FROM m""")
def conversation_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select("conv_id", V.content_hash(F.col("messages")).alias("hash"))


@query("conversation_valid", f"WITH {M}, {REST} SELECT conv_id, len(m) = 2 AND {TURNS.format(x='m')} AND {FULL.format(x='m')} AS pair, len(m) >= 2 AND {TURNS.format(x='m')} AND {FULL.format(x='m')} AS turns, len(rest) >= 2 AND {TURNS.format(x='rest')} AS chat FROM r")
def conversation_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("messages")
    return chats(spark, sf_dir).select("conv_id", V.valid_pair(m).alias("pair"), V.valid_turns(m).alias("turns"), V.valid_chat(m).alias("chat"))


MERGED = """g AS (SELECT conv_id, CASE WHEN m[1].role = 'system' AND len(m) > 1
    THEN list_concat([{'role': m[2].role, 'content': m[1].content || chr(10) || chr(10) || m[2].content}], m[3:]) ELSE m END AS m FROM m)"""


@query("merged_system", f"WITH {M}, {MERGED} SELECT conv_id, len(m)::INTEGER AS n, m[1].role AS role, m[1].content AS content FROM g")
def merged_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = chats(spark, sf_dir).select("conv_id", V.merged_system(F.col("messages")).alias("m"))
    return merged.select("conv_id", F.size("m").alias("n"), F.col("m")[0]["role"].alias("role"), F.col("m")[0]["content"].alias("content"))


PIECES = """list_concat([{'text': '<|bos|>', 'mask': 0}], flatten(list_transform(M, lambda x: CASE WHEN x.role = 'user'
    THEN [{'text': '<|user_start|>', 'mask': 0}, {'text': x.content, 'mask': 0}, {'text': '<|user_end|>', 'mask': 0}]
    ELSE [{'text': '<|assistant_start|>', 'mask': 0}, {'text': x.content, 'mask': 1}, {'text': '<|assistant_end|>', 'mask': 1}] END)))"""


@query("render_segments", f"WITH {M}, {MERGED}, p AS (SELECT conv_id, {PIECES.replace('M,', 'm,', 1)} AS p FROM g) SELECT conv_id, i::INTEGER - 1 AS at, p[i].text AS text, p[i].mask AS mask FROM (SELECT conv_id, p, unnest(range(1, len(p) + 1)) AS i FROM p)")
def render_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select("conv_id", F.posexplode_outer(V.segments(F.col("messages"))).alias("at", "p")).select("conv_id", "at", "p.text", "p.mask")


@query("render_completion", f"""WITH {M}, d AS (SELECT conv_id, CASE WHEN m[len(m)].role = 'assistant' THEN m[1:len(m) - 1] ELSE m END AS m FROM m), {MERGED.replace("FROM m)", "FROM d)")},
    p AS (SELECT conv_id, list_append({PIECES.replace('M,', 'm,', 1)}, {{'text': '<|assistant_start|>', 'mask': 0}}) AS p FROM g)
    SELECT conv_id, len(p)::INTEGER AS n, md5(array_to_string(list_transform(p, lambda x: x.text || '(' || x.mask || ')'), '|')) AS digest FROM p""")  # fmt: skip
def render_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = chats(spark, sf_dir).select("conv_id", V.completion_segments(F.col("messages")).alias("p"))
    return p.select("conv_id", F.size("p").alias("n"), F.md5(V.mask_view(F.col("p"))).alias("digest"))


@query("render_byte_ids", f"""WITH {M}, {MERGED}, p AS (SELECT conv_id, {PIECES.replace('M,', 'm,', 1)} AS p FROM g),
    n AS (SELECT conv_id, list_transform(p, lambda x: CASE WHEN x.text LIKE '<|%|>' THEN 1 ELSE strlen(x.text) END) AS n, list_transform(p, lambda x: x.mask) AS k FROM p)
    SELECT conv_id, list_sum(n)::INTEGER AS n_ids, list_sum(list_transform(range(1, len(n) + 1), lambda i: n[i] * k[i]))::INTEGER AS n_trained FROM n""")  # fmt: skip
def render_byte_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = chats(spark, sf_dir).select("conv_id", V.byte_ids(V.segments(F.col("messages")), None).alias("ids"))
    return ids.select("conv_id", F.size("ids").alias("n_ids"), F.aggregate("ids", F.lit(0), lambda a, x: a + x["mask"]).alias("n_trained"))


@query("completion_ids", f"""WITH {M}, d AS (SELECT conv_id, CASE WHEN m[len(m)].role = 'assistant' THEN m[1:len(m) - 1] ELSE m END AS m FROM m), {MERGED.replace("FROM m)", "FROM d)")},
    p AS (SELECT conv_id, {PIECES.replace('M,', 'm,', 1)} AS p FROM g),
    h AS (SELECT conv_id, array_to_string(list_transform(p, lambda x: CASE WHEN list_contains([{", ".join(f"'{s}'" for s in SPECIALS)}], x.text) THEN printf('%04X', 255 + list_position([{", ".join(f"'{s}'" for s in SPECIALS)}], x.text)) ELSE regexp_replace(hex(encode(x.text)), '(..)', '00\\1', 'g') END), '') AS h FROM p)
    SELECT conv_id, md5(substr(h, 1, 4 * 150) || '{256 + SPECIALS.index("<|assistant_start|>"):04X}') AS digest, least(length(h) // 4, 150)::INTEGER + 1 AS n FROM h""")  # fmt: skip
def completion_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids before an answer, cut to 150, and then the marker."""
    ids = chats(spark, sf_dir).select("conv_id", V.completion_ids(F.col("messages"), 150).alias("ids"))
    return ids.select("conv_id", F.md5(F.array_join(F.transform("ids", lambda x: F.lpad(F.hex(x["id"]), 4, "0")), "")).alias("digest"), F.size("ids").alias("n"))


@query("chat_request_errors", f"""WITH {M} SELECT conv_id, CASE WHEN len(m) = 0 THEN 'empty' WHEN len(m) > 6 THEN 'too_many_messages' WHEN len(list_filter(m, lambda x: x.content = '')) > 0 THEN 'empty_message'
    WHEN len(list_filter(m, lambda x: length(x.content) > 200)) > 0 THEN 'message_too_long' WHEN list_sum(list_transform(m, lambda x: length(x.content))) > 500 THEN 'conversation_too_long'
    WHEN len(list_filter(m, lambda x: x.role NOT IN ('user', 'assistant'))) > 0 THEN 'bad_role' END AS error FROM m""")  # fmt: skip
def chat_request_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select("conv_id", V.request_error(F.col("messages"), 6, 200, 500).alias("error"))


REPLIES = [(1, "SAFE"), (2, "It is unsafe. Verdict: UNSAFE"), (3, "SAFE? no: UNSURE"), (4, "nothing"), (5, "unsafe then SAFE"), (6, "")]
VALUES = ", ".join(f"({i}, '{t}')" for i, t in REPLIES)


@query("verdicts", f"SELECT id, v AS verdict, v = 'SAFE' AS safe FROM (SELECT id, coalesce(list_last(regexp_extract_all(upper(reply), '\\b(UNSAFE|UNSURE|SAFE)\\b', 1)), 'UNSURE') AS v FROM (VALUES {VALUES}) t(id, reply))")
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.createDataFrame(REPLIES, "id int, reply string")
    return given.select("id", T.verdict(F.col("reply")).alias("verdict")).withColumn("safe", F.col("verdict") == "SAFE")


ANSWERS = [(1, "so #### -1,234.5", "#### -1234.5"), (2, "no marker", "#### 3"), (3, "none", "none"), (4, "#### 3", "work <<1+2=3>> #### 3"), (5, "#### 4", "#### 5")]
VALUES2 = ", ".join(f"({i}, '{a}', '{b}')" for i, a, b in ANSWERS)


@query("numeric_grades", rf"""WITH e AS (SELECT id, nullif(replace(regexp_extract(a, '#### (\-?[0-9\.\,]+)', 1), ',', ''), '') AS a, nullif(replace(regexp_extract(b, '#### (\-?[0-9\.\,]+)', 1), ',', ''), '') AS b FROM (VALUES {VALUES2}) t(id, a, b))
    SELECT id, a AS given, (a IS NOT DISTINCT FROM b)::INTEGER AS grade, coalesce(a = b, false)::INTEGER AS strict_grade FROM e""")  # fmt: skip
def numeric_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return spark.createDataFrame(ANSWERS, "id int, a string, b string").select("id", T.answer_number(a).alias("given"), T.same_answer(a, b).alias("grade"), T.same_answer(a, b, strict=True).alias("strict_grade"))


@query("multiple_choice_prompts", """
WITH q AS (SELECT doc_id, split_part(text, '.', 1) AS question, list_transform(range(0, 4), lambda i: lang || ' ' || (doc_id + i)) AS choices FROM documents)
SELECT doc_id, 'Multiple Choice question: ' || question || chr(10) || array_to_string(list_transform(range(1, 5), lambda i: '- ' || choices[i] || '=' || ['A', 'B', 'C', 'D'][i] || chr(10)), '')
    || chr(10) || 'Respond only with the letter of the correct answer.' AS prompt FROM q""")  # fmt: skip
def multiple_choice_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    choices = F.array(*(F.concat(F.col("lang"), F.lit(" "), (F.col("doc_id") + i).cast("string")) for i in range(4)))
    question = F.split_part("text", F.lit("."), F.lit(1))
    return docs(spark, sf_dir).select("doc_id", V.multiple_choice(question, F.array(*map(F.lit, "ABCD")), choices).alias("prompt"))


def _shots() -> Column:
    return F.array(F.lit("one? 1"), F.lit("two? 2"))


@query("few_shot_prompts", """
WITH b AS (SELECT item_id, split_part(text, '.', 1) AS q, split_part(text, '.', 2) AS c FROM benchmark),
s AS (SELECT 'one? 1' || chr(10) || chr(10) || 'two? 2' || chr(10) || chr(10) AS s)
SELECT item_id, 'choice' AS kind, i::INTEGER AS at, s || q || ' ' || [c, 'none'][i + 1] AS prompt FROM b, s, range(0, 2) r(i)
UNION ALL SELECT item_id, 'schema', i::INTEGER, s || [q, 'some'][i + 1] || ' ' || c FROM b, s, range(0, 2) r(i)
UNION ALL SELECT item_id, 'completion', i::INTEGER, CASE WHEN i = 0 THEN trim(s || trim(q) || ' ') ELSE s || trim(q) || ' ' || c END FROM b, s, range(0, 2) r(i)""")  # fmt: skip
def few_shot_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, c, gap = F.split_part("text", F.lit("."), F.lit(1)), F.split_part("text", F.lit("."), F.lit(2)), F.lit(" ")
    items = docs(spark, sf_dir, "benchmark").select("item_id", q.alias("q"), c.alias("c"))
    q, c = F.col("q"), F.col("c")
    kinds = {"choice": V.choice_prompts(q, F.array(c, F.lit("none")), gap, _shots()), "schema": V.schema_prompts(F.array(q, F.lit("some")), c, gap, _shots()), "completion": V.completion_prompts(q, c, gap, _shots())}
    out = None
    for kind, prompts in kinds.items():
        part = items.select("item_id", F.lit(kind).alias("kind"), F.posexplode(prompts).alias("at", "prompt"))
        out = part if out is None else out.unionByName(part)
    return out


@query("few_shot_choice", """
WITH p AS (SELECT a.item_id, b.item_id AS shot, row_number() OVER (PARTITION BY a.item_id ORDER BY md5('1234:' || a.item_id || ':' || b.item_id), b.item_id) AS n FROM benchmark a JOIN benchmark b ON a.item_id <> b.item_id)
SELECT item_id, n::INTEGER AS n, shot FROM p WHERE n <= 3""")  # fmt: skip
def few_shot_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples for each item, never itself; a stated set of items against all of one task."""
    from pyspark.sql import Window

    from ..operators.corpus import hash_order

    b = docs(spark, sf_dir, "benchmark").select("item_id")
    pairs = b.join(b.select(F.col("item_id").alias("shot")), F.col("item_id") != F.col("shot"))
    order = Window.partitionBy("item_id").orderBy(hash_order(1234, "item_id", "shot"), "shot")
    return pairs.withColumn("n", F.row_number().over(order)).filter("n <= 3").select("item_id", "n", "shot")


SUMS = [(1, "12/60 is <<12/60=0.2>>0.2 an hour"), (2, "<<a=b=c>>end"), (3, "no call"), (4, "<<x>>"), (5, "tail <<1+1=2>>")]


@query("calculator_parts", "SELECT * FROM (VALUES (1, 0, 'text', '12/60 is '), (1, 1, 'python', '12/60'), (1, 2, 'python_output', '0.2'), (1, 3, 'text', '0.2 an hour'), (2, 0, 'python', 'a=b'), (2, 1, 'python_output', 'c'), (2, 2, 'text', 'end'), (3, 0, 'text', 'no call'), (4, 0, 'python', 'x'), (4, 1, 'python_output', ''), (5, 0, 'text', 'tail '), (5, 1, 'python', '1+1'), (5, 2, 'python_output', '2')) t(id, \"at\", type, text)")
def calculator_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.createDataFrame(SUMS, "id int, answer string")
    return given.select("id", F.posexplode(V.calculator_parts(F.col("answer"))).alias("at", "p")).select("id", "at", "p.type", "p.text")


CODE = [(1, "import os\nfrom re import sub\n\n# note\nx = 1\nimport late"), (2, "say\n```python\nprint(1)\n```\nand\n```\nno\n```"), (3, "print(2)"), (4, "```\nplain\n```")]


@query("programs", "SELECT * FROM (VALUES (1, 'import os' || chr(10) || 'from re import sub', 'import os' || chr(10) || 'from re import sub' || chr(10) || chr(10) || '# note' || chr(10) || 'x = 1' || chr(10) || 'import late'), (2, '', 'print(1)'), (3, '', 'print(2)'), (4, '', 'plain')) t(id, imports, program)")
def programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(CODE, "id int, code string").select("id", T.imports(F.col("code")).alias("imports"), T.program(F.col("code")).alias("program"))


THOUGHTS = [(1, "<think>a\nb</think> yes "), (2, "plain"), (3, "<|channel|>analysis hm<|end|>final"), (4, '```json\n{"a": 1}\n```')]


@query("replies_stripped", "SELECT * FROM (VALUES (1, 'yes', 'yes'), (2, 'plain', 'plain'), (3, 'final', 'final'), (4, '```json' || chr(10) || '{\"a\": 1}' || chr(10) || '```', '{\"a\": 1}')) t(id, bare, body)")
def replies_stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = T.without_reasoning(F.col("reply"))
    return spark.createDataFrame(THOUGHTS, "id int, reply string").select("id", bare.alias("bare"), T.json_body(bare).alias("body"))


@query("spelling_traces", """
WITH w AS (SELECT DISTINCT lower(p_brand) AS word FROM part)
SELECT word, array_to_string(list_filter(string_split(word, ''), lambda c: c <> ''), ',') AS letters, (length(word) - length(replace(word, 'a', '')))::INTEGER AS n_a,
    array_to_string(list_transform(range(1, length(word) + 1), lambda i: i || ':' || word[i] || CASE WHEN word[i] = 'a' THEN ' hit ' || (i - length(replace(word[1:i], 'a', ''))) ELSE '' END), chr(10)) AS trace FROM w""")  # fmt: skip
def spelling_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters of a word, how often one occurs, and a step-by-step count."""
    w = F.col("word")

    def step(i: Column) -> Column:
        c = F.substring(w, i, F.lit(1))
        return F.concat(i.cast("string"), F.lit(":"), c, F.when(c == "a", F.concat(F.lit(" hit "), T.letter_count(F.substring(w, F.lit(1), i), F.lit("a")).cast("string"))).otherwise(F.lit("")))

    words = docs(spark, sf_dir, "part").select(F.lower("p_brand").alias("word")).distinct()
    return words.select("word", T.spelled(w).alias("letters"), T.letter_count(w, F.lit("a")).alias("n_a"), F.array_join(F.transform(F.sequence(F.lit(1), F.length(w)), step), "\n").alias("trace"))


@query("small_parsers", "SELECT * FROM (VALUES ('a:0.5,b:1', '0-1,4,6-7,1', [0, 1, 4, 6, 7], 'base-model-loss')) t(mix, gpus, ids, slug)")
def small_parsers(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = spark.createDataFrame([("a:0.5,b:1", "0-1,4,6-7,1", "Base model loss")], "mix string, gpus string, title string")
    return one.select("mix", "gpus", T.gpu_ranges(F.col("gpus")).alias("ids"), T.slug(F.col("title")).alias("slug"))


DEVICES = [("NVIDIA H100 80GB HBM3", 8), ("NVIDIA H100 PCIe", 1), ("NVIDIA A100-SXM4-40GB", 4), ("NVIDIA L4", 1), ("Tesla V100", 2), ("unknown", 1), ("NVIDIA GB200", 1)]


@query("device_tables", "SELECT * FROM (VALUES ('NVIDIA H100 80GB HBM3', 989e12::DOUBLE, 24.0::DOUBLE), ('NVIDIA H100 PCIe', 756e12, 3.0), ('NVIDIA A100-SXM4-40GB', 312e12, 7.16), ('NVIDIA L4', 121e12, 2.0), ('Tesla V100', 'inf'::DOUBLE, 1.1), ('unknown', 'inf'::DOUBLE, 2.0), ('NVIDIA GB200', 2.5e15, 2.0)) t(name, flops, hourly)")
def device_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.createDataFrame(DEVICES, "name string, n int")
    return d.select("name", T.peak_flops(F.col("name")).alias("flops"), T.hourly_cost(F.col("name"), F.col("n")).alias("hourly"))
