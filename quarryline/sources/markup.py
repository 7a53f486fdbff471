"""Markdown and wikitext: sections, participants, tables and plain prose."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quarryline.functions import rules as K
from quarryline.functions.gates import sentence_like


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """file, text of whole text files."""
    return spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def lines(texts: DataFrame, key: str = "file") -> DataFrame:
    return texts.select(key, F.posexplode(F.split("text", "\r?\n")).alias("line", "content"))


def sections(texts: DataFrame, key: str = "file") -> DataFrame:
    """key, line, level, title, last (its section's last line), body of every heading.

    A section ends before the next heading of its level or above. The next such line is found by one
    window a level (at most six), in the text's own lines.
    """
    rows = lines(texts, key)
    level = F.length(F.regexp_extract("content", "^(#{1,6}) +", 1))
    rows = rows.withColumn("level", F.when(level > 0, level))
    after = Window.partitionBy(key).orderBy("line").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(key)
    ends = [F.min(F.when(F.col("level") <= k, F.col("line"))).over(after).alias(f"_e{k}") for k in range(1, 7)]
    rows = rows.select("*", *ends, F.max("line").over(whole).alias("_last"))
    end = F.coalesce(F.element_at(F.array(*[f"_e{k}" for k in range(1, 7)]), F.col("level")) - 1, F.col("_last"))
    heads = rows.where("level is not null").select(key, "line", "level", F.trim(F.regexp_replace("content", "^#+ +", "")).alias("title"), end.alias("last"))
    body = texts.select(F.col(key).alias("_k"), F.split("text", "\r?\n").alias("_all"))
    joined = heads.join(body, F.col(key).eqNullSafe(F.col("_k")))
    return joined.select(key, "line", "level", "title", "last", F.array_join(F.slice("_all", F.col("line") + 2, F.greatest(F.col("last") - F.col("line"), F.lit(0))), "\n").alias("body"))


def participants(sections_: DataFrame, key: str = "file") -> DataFrame:
    """key, line, span, reason of every bold span; a reason says why it is no name."""
    spans = sections_.select(key, "line", F.explode(F.regexp_extract_all("body", F.lit(r"\*\*([^*\n]+)\*\*"), F.lit(1))).alias("span"))
    return spans.withColumn("reason", sentence_like(F.col("span")))


def pipe_rows(texts: DataFrame, key: str = "file") -> DataFrame:
    """key, line, cells of every row of a pipe table; rules and headings' underlines are left out."""
    rows = lines(texts, key).where(F.col("content").rlike(r"^\s*\|.*\|\s*$") & ~F.col("content").rlike(r"^[\s|:\-]+$"))
    inner = F.regexp_replace(F.trim("content"), r"^\||\|$", "")
    return rows.select(key, "line", F.transform(F.split(inner, r"\|"), lambda cell: F.trim(cell)).alias("cells"))


def wiki_numbers(texts: DataFrame, key: str = "file") -> DataFrame:
    """key, name, value of wiki-table rows: a row's links with its numbers, one to one or all to the first.

    The largest value of a name stays; with eight names or more, what exceeds the median a thousandfold goes.
    """
    row = texts.select(key, F.explode(F.split("text", r"\n\|-")).alias("row"))
    links = F.regexp_extract_all("row", F.lit(r"\[\[(?:[^\]|]*\|)?([^\]|]+)\]\]"), F.lit(1))
    plain = F.regexp_replace("row", r"\[\[[^\]]*\]\]", " ")
    numbers = F.transform(F.regexp_extract_all(plain, F.lit(r"\d[\d,]*(?:\.\d+)?"), F.lit(0)), lambda x: F.regexp_replace(x, ",", "").cast("double"))
    row = row.select(key, links.alias("links"), numbers.alias("numbers")).where("size(links) > 0 and size(numbers) > 0")
    paired = F.when(F.size("links") == F.size("numbers"), F.arrays_zip("links", "numbers")).when(F.size("links") == 1, F.array(F.struct(F.col("links")[0].alias("links"), F.col("numbers")[0].alias("numbers"))))
    best = row.select(key, F.explode(paired).alias("p")).groupBy(key, F.trim("p.links").alias("name")).agg(F.max("p.numbers").alias("value"))
    w = Window.partitionBy(key)
    checked = best.withColumn("_m", F.percentile("value", F.lit(0.5)).over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
    return checked.where("_n < 8 or value <= 1000 * _m").select(key, "name", "value")


def strip_wikitext(c: Column, depth: int = 6) -> Column:
    """Prose of wikitext: comments, references, tables and templates off (nested ones up to ``depth``), links as their text."""
    c = F.regexp_replace(c, r"(?s)<!--.*?-->|<ref[^>]*/>|<ref[^>]*>.*?</ref>", "")
    for _ in range(depth):
        c = F.regexp_replace(c, r"\{\{[^{}]*\}\}", "")
    c = F.regexp_replace(c, r"(?s)\{\|.*?\|\}", "")
    c = F.regexp_replace(c, r"\[\[(?:File|Image|Category):[^\]]*\]\]", "")
    c = F.regexp_replace(c, r"\[\[(?:[^\]|]*\|)?([^\]|]*)\]\]", "$1")
    c = F.regexp_replace(c, r"\[https?://\S+ ([^\]]*)\]", "$1")
    c = F.regexp_replace(c, r"'{2,}|<[^>]+>", "")
    c = F.regexp_replace(c, r"(?m)^=+ *(.*?) *=+$", "$1")
    return F.trim(F.regexp_replace(c, r"[ \t]+", " "))


_LINK = re.compile(r"\[\[([^\]|#]{3,40})(?:\|[^\]]*)?\]\]")
_NOT_A_NAME = re.compile(K.NOT_A_NAME)
_PARAMETER = re.compile(K.PARAMETER)
_GRADED = ArrayType(StructType([StructField("name", StringType()), StructField("parameter", StringType()), StructField("grade", IntegerType())]))


def _names_before(text: str, at: int, window: int) -> list[str]:
    found = (m.group(1).strip() for m in _LINK.finditer(text[max(0, at - window) : at]))
    return [n for n in found if not _NOT_A_NAME.search(n)]


def ordinal_rows(texts: DataFrame, ladder: list[str], key: str = "file") -> DataFrame:
    """key, name, rank of the links that stand before a word of the ladder; a name's highest rank counts.

    The windows are positions in the text, so they are found in vectorised batches and grouped by Spark.
    """
    tiers = [re.compile(rf"\b{re.escape(t)}", re.I) for t in ladder]

    @pandas_udf(_GRADED)
    def ranked(texts: pd.Series) -> pd.Series:
        return pd.Series([[(n, ladder[k], k) for k, tier in enumerate(tiers) for m in tier.finditer(t or "") for n in _names_before(t, m.start(), K.TIER_WINDOW)] for t in texts])

    rows = texts.select(key, F.explode(ranked("text")).alias("g"))
    return rows.groupBy(key, F.col("g.name").alias("name")).agg(F.max("g.grade").alias("rank"))


def stand_rows(texts: DataFrame, key: str = "file") -> DataFrame:
    """key, name, mean of the graded parameters (E is 0, A is 4) of the nearest name before each; three of them make a block."""

    @pandas_udf(_GRADED)
    def graded(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            found = [(_names_before(t, m.start(), K.PARAMETER_WINDOW), m) for m in _PARAMETER.finditer(t or "")]
            out.append([(names[-1], m.group(1).lower(), "edcba".index(m.group(2).lower())) for names, m in found if names])
        return pd.Series(out)

    rows = texts.select(key, F.posexplode(graded("text")).alias("pos", "g"))
    last = rows.groupBy(key, "g.name", "g.parameter").agg(F.max_by("g.grade", "pos").alias("grade"))
    return last.groupBy(key, "name").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("grade"), 3).alias("mean")).where(F.col("n") >= K.PARAMETER_LEAST).select(key, "name", "mean")


def declared_counts(sections_: DataFrame, key: str = "file") -> DataFrame:
    """key, title, declared (a number in brackets at the title's end), parsed (list items of the body), agrees."""
    declared = F.regexp_extract("title", r"\(([0-9]+)\)\s*$", 1)
    parsed = F.regexp_count("body", F.lit(r"(?m)^\s*[-*] +\S")).cast("int")
    rows = sections_.where(declared != "").select(key, "title", declared.cast("int").alias("declared"), parsed.alias("parsed"))
    return rows.withColumn("agrees", F.col("declared") == F.col("parsed"))
