"""Rollups, ratios, inverted indexes and surprisal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def conditional_counts(df: DataFrame, keys: Sequence[str], states: Mapping[str, Column]) -> DataFrame:
    """Rows a key and how many of them meet each condition."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(name) for name, c in states.items()])


def ratio(part: Column, whole: Column) -> Column:
    """Null where nothing was measured."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def with_total(df: DataFrame, key: str, total: str = "TOTAL") -> DataFrame:
    """Counts by key and a grand-total row."""
    return df.rollup(key).agg(F.count(F.lit(1)).alias("n"), F.grouping(key).alias("_g")).select(F.when(F.col("_g") == 1, F.lit(total)).otherwise(F.col(key)).alias(key), "n")


def document_frequency(documents: DataFrame, keys: Column) -> DataFrame:
    """key, df, idf = ln(N / df) of each document's array of distinct keys; N is the number of documents that have keys.

    Each document adds a null to its keys, so that one aggregate counts keys and documents, and the input is read once.
    """
    counted = documents.select(keys.alias("k")).where("size(k) > 0").select(F.explode(F.concat("k", F.array(F.lit(None).cast("string")))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("df"))
    n = counted.where("key is null").select(F.col("df").alias("total"))
    return counted.where("key is not null").crossJoin(n).select("key", "df", F.log(F.col("total") / F.col("df")).alias("idf"))  # n is one row


def surprisal(pairs: DataFrame, name: str, token: str) -> DataFrame:
    """name, bits = sum of log2(N / df) over its distinct tokens."""
    pairs = pairs.select(name, token).distinct()
    n = pairs.agg(F.count_distinct(name).alias("total"))
    df = pairs.groupBy(token).agg(F.count(F.lit(1)).alias("df"))
    return pairs.join(df, token).crossJoin(n).groupBy(name).agg(F.sum(F.log2(F.col("total") / F.col("df"))).alias("bits"))


def inverted_index(df: DataFrame, key: Column, member: str) -> DataFrame:
    """key, spread (distinct members), attestations; empty keys are left out."""
    keyed = df.select(key.alias("key"), F.col(member).alias("member")).where(F.length("key") > 0)
    return keyed.groupBy("key").agg(F.count_distinct("member").alias("spread"), F.count(F.lit(1)).alias("attestations"))


def vote(df: DataFrame, group: str, choice: str, weight: str) -> DataFrame:
    """The choice of the largest summed weight; ties go to the first in order, null choices do not vote."""
    totals = df.where(F.col(choice).isNotNull()).groupBy(group, choice).agg(F.sum(weight).alias("votes"))
    best = Window.partitionBy(group).orderBy(F.desc("votes"), choice)
    share = F.col("votes") / F.sum("votes").over(Window.partitionBy(group))
    ranked = totals.select(group, choice, "votes", share.alias("share"), F.count(F.lit(1)).over(Window.partitionBy(group)).alias("contested"), F.row_number().over(best).alias("_r"))
    return ranked.where("_r = 1").drop("_r")


def violations(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row a check: how many rows break it."""
    out = None
    for label, rows in checks.items():
        one = rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(label).alias("check"), "violations")
        out = one if out is None else out.union(one)
    return out


def funnel(df: DataFrame, member: str, stages: Mapping[str, Column]) -> DataFrame:
    """Members that reach each stage, and that reach it and all before."""
    flags = df.groupBy(member).agg(*[F.bool_or(c).alias(name) for name, c in stages.items()])
    sums, so_far = [], F.lit(True)
    for k, name in enumerate(stages):
        so_far = so_far & F.col(name)
        sums.append(F.struct(F.lit(k).alias("step"), F.lit(name).alias("stage"), F.count_if(F.col(name)).alias("reached"), F.count_if(so_far).alias("nested")))
    return flags.agg(F.array(*sums).alias("rows")).select(F.inline("rows"))


def check_rules(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules (name, metric, op, low, high) against metrics (metric, value): ok, or null if the metric is missing (vacuous)."""
    v, lo, hi = F.col("value"), F.col("low"), F.col("high")
    ok = (
        F.when(F.col("op") == "exists", v.isNotNull())
        .when(v.isNull(), F.lit(None).cast("boolean"))
        .when(F.col("op") == "gte", v >= lo)
        .when(F.col("op") == "lte", v <= hi)
        .when(F.col("op") == "eq", v == lo)
        .when(F.col("op") == "ne", v != lo)
        .when(F.col("op") == "in_range", (v >= lo) & (v <= hi))
    )
    return rules.join(metrics, "metric", "left").select("name", "metric", "op", "value", ok.alias("ok"), v.isNull().alias("vacuous"))
