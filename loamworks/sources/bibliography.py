"""Bibliographic XML (gzipped or not): year, title, abstract; and directory listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

CUTOFF, SHORTEST = 1985, 50
NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def untagged(xml: Column) -> Column:
    """All text below an element: comments and tags out, CDATA as it stands, named and numeric entities resolved."""
    pieces = F.regexp_extract_all(xml, F.lit(r"(?s)(<!\[CDATA\[.*?\]\]>|<!--.*?-->|<[^>]*>|&#?\w+;|[^<&]+|[<&])"), F.lit(1))

    def plain(p: Column) -> Column:
        code = F.coalesce(F.conv(F.nullif(F.regexp_extract(p, r"^&#x([0-9A-Fa-f]{1,6});$", 1), F.lit("")), 16, 10), F.nullif(F.regexp_extract(p, r"^&#([0-9]{1,7});$", 1), F.lit("")))
        named = p
        for entity, char in NAMED.items():
            named = F.when(p == entity, char).otherwise(named)
        character = F.decode(F.unhex(F.lpad(F.hex(code.cast("int")), 8, "0")), "utf-32")
        return (
            F.when(p.startswith("<![CDATA["), F.regexp_extract(p, r"(?s)^<!\[CDATA\[(.*)\]\]>$", 1))
            .when(p.rlike(r"(?s)^<.+>$"), "")
            .when(code.cast("int").between(1, 0x10FFFF), character)
            .otherwise(named)
        )

    return F.array_join(F.transform(pieces, plain), "")


def records(article: Column) -> list[Column]:
    """``year, title, abstract`` of an article's raw XML."""
    date = F.regexp_extract(article, r"(?s)<PubDate>(.*?)</PubDate>", 1)
    exact = F.regexp_extract(date, r"<Year>\s*(\d{4})\s*</Year>", 1)
    loose = F.regexp_extract(F.regexp_extract(date, r"(?s)<MedlineDate>(.*?)</MedlineDate>", 1), r"\b(1\d{3}|20\d{2})\b", 1)
    title = strip(untagged(F.regexp_extract(article, r"(?s)<ArticleTitle[^>]*>(.*?)</ArticleTitle>", 1)))
    parts = F.regexp_extract_all(article, F.lit(r"(?s)(<AbstractText[^>]*>.*?</AbstractText>)"), F.lit(1))

    def part(p: Column) -> Column:
        label = F.regexp_extract(p, r'^<AbstractText[^>]*\bLabel="([^"]*)"', 1)
        body = strip(untagged(p))
        return F.when((label != "") & (body != ""), F.concat(untagged(label), F.lit(": "), body)).otherwise(body)

    abstract = F.array_join(F.filter(F.transform(parts, part), lambda x: x != ""), "\n")
    return [F.coalesce(F.nullif(exact, F.lit("")), F.nullif(loose, F.lit(""))).try_cast("int").alias("year"), title.alias("title"), abstract.alias("abstract")]


def read(spark: SparkSession, path: str, tag: str = "PubmedArticle") -> DataFrame:
    """``year, title, abstract`` of XML files; files that can't be read are skipped.

    Text mode keeps an article's mixed content, which a struct schema would lose.
    """
    rows = spark.read.option("lineSep", f"</{tag}>").option("ignoreCorruptFiles", "true").text(path)
    articles = rows.filter(F.contains("value", F.lit(f"<{tag}")))
    return articles.select(*records(F.col("value")))


def texts(rows: DataFrame, cutoff: int = CUTOFF, shortest: int = SHORTEST) -> DataFrame:
    """``year, text`` before ``cutoff``: title, a blank line, abstract; short ones dropped."""
    text = strip(F.when(F.col("abstract") != "", F.concat_ws("\n\n", F.nullif("title", F.lit("")), "abstract")).otherwise(F.col("title")))
    return rows.filter(F.col("year") < cutoff).select("year", text.alias("text")).filter(F.length("text") >= shortest)


def listed(pages: DataFrame, html: str = "html", pattern: str = r'href="([^"/]+\.xml\.gz)"') -> DataFrame:
    """Distinct file names in directory listings."""
    return pages.select(F.explode_outer(F.regexp_extract_all(html, F.lit(pattern), F.lit(1))).alias("name")).filter("name is not null").distinct()
