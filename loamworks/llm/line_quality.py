"""Operator 1: quality rules with cross-document line frequency, by DataFrame functions only.

Base measures come from the words of a text.  Then lines are normalised (case,
white space and digits), hashed, and counted over the distinct documents of
their host; a line in more than ``LINE_DOCUMENTS`` of them is removed, and a
document that loses more than ``DEPLETED_PERCENT`` of its words is rejected.

Frequent lines are few beside all lines: up to ``BROADCAST_LINES`` of them are
broadcast to the lines, more are joined by shuffle, where adaptive execution
splits a line of very many rows.

Defined results: a null text has no words and fails the base rules; documents
with a null host share one host; rows that repeat a doc_id are told apart by
their text, and rows that repeat both count once; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bound
from .shared import landed

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
LINE_DOCUMENTS = 10
DEPLETED_PERCENT = 50
#: Rows of two longs: 16 MB.
BROADCAST_LINES = 1_000_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda x: x != "")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _repeat_words(words: str, windows: str) -> Column:
    """Words inside windows that occur twice or more.

    When all hashes differ, so do all windows; else windows are compared as text.
    """
    def covered(w: Column) -> Column:
        last = F.size(w) - WINDOW
        return bound(F.sort_array(F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("w"), i.alias("p")))), marked)

    def marked(s: Column) -> Column:
        same = lambda k: F.coalesce(F.get(s, k - 1)["w"] == F.get(s, k)["w"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["w"] == F.get(s, k)["w"], F.lit(False))
        places = F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), F.size(s) - 1), same), lambda k: F.get(s, k)["p"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at"))
        return F.aggregate(places, start, lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["at"])).alias("n"), p.alias("at")), lambda a: a["n"])

    return F.when(F.size(F.array_distinct(F.col(windows))) == F.size(F.col(windows)), 0).otherwise(bound(F.col(words), covered))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base columns; ``text`` must not be null."""
    t = F.col(text)
    cut = docs.withColumns({"_words": words_of(t), "_lines": _lines(t)})
    no_windows = F.array().cast("array<bigint>")
    hashed = cut.withColumn(
        "_windows", bound(F.col("_words"), lambda w: F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))).otherwise(no_windows))
    )
    out = hashed.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.regexp_replace(t, SPACE, "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": _repeat_words("_words", "_windows").cast("long"),
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_words", "_lines", "_windows")


def normalised(line: Column) -> Column:
    """A line in lower case, digits as 0, white space single and none at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]+", "0"), SPACE, " "))


def _rows(docs: DataFrame, host: str) -> DataFrame:
    """``doc_id, text, host, digest``: null texts as empty, null hosts as one, hosts hashed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    where = F.xxhash64(F.coalesce(F.concat(F.lit("h"), F.col(host).cast("string")), F.lit("")))
    return docs.select("doc_id", text.alias("text"), where.alias("host")).withColumn("digest", F.xxhash64("text"))


def lines_of(rows: DataFrame) -> DataFrame:
    """``doc_id, digest, host, line, words``: a row for each line with a word."""
    each = rows.select("doc_id", "digest", "host", F.explode_outer(_lines(F.col("text"))).alias("raw")).filter("raw is not null")
    return each.select("doc_id", "digest", "host", F.xxhash64(normalised(F.col("raw"))).alias("line"), F.size(words_of(F.col("raw"))).cast("long").alias("words"))


def frequent_lines(lines: DataFrame, limit: int = LINE_DOCUMENTS) -> DataFrame:
    """``host, line, common`` of lines in more than ``limit`` distinct documents of the host, for a left join."""
    once = lines.select("host", "line", F.xxhash64("doc_id", "digest").alias("document")).distinct()
    common = landed(once.groupBy("host", "line").agg(F.count("*").alias("documents")).filter(F.col("documents") > limit).select("host", "line", F.lit(True).alias("common")), "lines")
    return F.broadcast(common) if common.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES else common


def judge(docs: DataFrame, host: str = "source", limit: int = LINE_DOCUMENTS) -> DataFrame:
    """Base measures, words lost with frequent lines, and the verdict of every row."""
    rows = _rows(docs, host)
    lines = lines_of(rows)
    common = frequent_lines(lines, limit)
    # Shares, not sums: rows that repeat a document leave them as they are.
    lost = (
        lines.join(common, ["host", "line"], "left")
        .groupBy("doc_id", "digest")
        .agg(F.sum("words").alias("all"), F.sum(F.when(F.col("common"), F.col("words")).otherwise(0)).alias("removed"))
        .filter("removed > 0")
        .select(F.col("doc_id").alias("id"), F.col("digest").alias("d"), (100 * F.col("removed") > DEPLETED_PERCENT * F.col("all")).alias("depleted"), (F.col("removed") / F.col("all")).alias("share"))
    )
    base = measures(rows).drop("text", "host")
    judged = base.join(lost, base["doc_id"].eqNullSafe(lost["id"]) & (base["digest"] == lost["d"]), "left")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce("depleted", F.lit(False))).alias("kept"),
        F.round(F.coalesce(F.col("share") * F.col("n_words"), F.lit(0.0))).cast("long").alias("n_removed_words"),
    )


def cleaned(docs: DataFrame, host: str = "source", limit: int = LINE_DOCUMENTS) -> DataFrame:
    """``doc_id, text`` of the documents that are kept, without their frequent lines.

    Lines keep their order.  Rows that repeat doc_id and text come once; a null
    doc_id is carried; a document that loses all its lines is depleted, so it
    isn't kept.
    """
    rows = _rows(docs, host).dropDuplicates(["doc_id", "digest", "host"])
    common = frequent_lines(lines_of(rows), limit)
    each = rows.select("doc_id", "digest", "host", F.posexplode(F.split("text", "\n")).alias("at", "raw")).withColumn("line", F.xxhash64(normalised(F.col("raw"))))
    # One document's lines come together: never more than its text.
    left = each.join(common, ["host", "line"], "left").groupBy("doc_id", "digest", "host").agg(
        F.array_sort(F.collect_list(F.when(F.col("common").isNull(), F.struct("at", "raw")))).alias("rows"),
        F.sum(F.size(words_of(F.col("raw")))).alias("all"), F.sum(F.when(F.col("common"), F.size(words_of(F.col("raw")))).otherwise(0)).alias("removed"),
    )
    whole = left.filter(100 * F.col("removed") <= DEPLETED_PERCENT * F.col("all")).select("doc_id", "digest", "host", F.array_join(F.transform("rows", lambda r: r["raw"]), "\n").alias("clean"))
    judged = measures(rows).filter("not base_failed").select(F.col("doc_id").alias("id"), F.col("digest").alias("d"), F.col("host").alias("h"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d")) & (F.col("host") == F.col("h"))
    return whole.join(judged, same, "left_semi").select("doc_id", F.col("clean").alias("text"))
