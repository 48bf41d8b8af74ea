"""Conversations in JSON lines, with string or typed contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conversation import MESSAGES, PART, valid_chat
from .books import or_empty

PLAIN = "array<struct<role:string,content:string>>"
TYPED = f"array<struct<role:string,content:array<{PART}>>>"


def parsed(lines: DataFrame, value: str = "value") -> DataFrame:
    """``line, messages, valid``; content may be a string or an array of parts in each message.

    The JSON type decides: a string stays text, whatever it spells.
    Lines that aren't a list of messages get null messages and aren't valid.
    """
    raw = "array<struct<role:string,content:variant>>"
    messages = F.from_json(value, raw, {"mode": "PERMISSIVE"})

    def one(m):
        plain = F.schema_of_variant(m["content"]) == "STRING"
        text = F.when(plain, F.try_variant_get(m["content"], "$", "string"))
        parts = F.when(~plain, F.from_json(F.to_json(m["content"]), f"array<{PART}>"))
        return F.struct(m["role"].alias("role"), text.alias("content"), parts.alias("parts"))

    rows = lines.filter(F.trim(value) != "").withColumn("messages", F.transform(messages, one).cast(MESSAGES))
    return rows.select(F.col(value).alias("line"), "messages", F.coalesce(valid_chat(F.col("messages")), F.lit(False)).alias("valid"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Conversations of JSON-lines files; none where the path isn't there."""
    return parsed(or_empty(spark, lambda: spark.read.text(path), "value string"))


def write(conversations: DataFrame, path: str) -> None:
    """Append ``messages`` as JSON lines."""
    conversations.select("messages").write.mode("append").json(path)
