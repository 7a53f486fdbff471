"""Fuzzy matching of names."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from quarryline.functions.text import bigrams, dice, digits_differ, name_key, split_qualifier, token_overlap
from quarryline.operators.snapshots import snapshot

STRONG, WEAK = 0.90, 0.72


@pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; no built-in function computes it."""
    return pd.Series([SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b)])


def dice_pairs(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b) of all keys of ``left`` (a) and ``right`` (b) whose Dice coefficient reaches ``least``, and of equal keys; no others are compared.

    Prefix filter: bigrams are ordered from rare to frequent. Two keys of n and m bigrams that reach
    the coefficient t share n * t / (2 - t) of them at least, so they share one among the first
    n - n * t / (2 - t) + 1 of each. Pairs meet there and are then decided exactly.
    """
    keys = left.select(F.col("a").alias("k"), F.lit(0).alias("side")).union(right.select(F.col("b").alias("k"), F.lit(1).alias("side"))).distinct()
    each = keys.select("k", "side", F.explode(bigrams("k")).alias("gram"), F.size(bigrams("k")).alias("n"))
    each = each.join(each.groupBy("gram").agg(F.count(F.lit(1)).alias("df")), "gram")
    ordered = each.groupBy("k", "side", "n").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("grams"))  # a name's own bigrams
    length = F.col("n") - F.ceil(F.col("n") * (least / (2 - least)) - 1e-9) + 1
    prefix = ordered.select("k", "side", "n", F.explode(F.slice("grams", F.lit(1), length.cast("int"))["gram"]).alias("gram"))
    a = prefix.where("side = 0").select(F.col("k").alias("a"), "gram", F.col("n").alias("na"))
    b = prefix.where("side = 1").select(F.col("k").alias("b"), "gram", F.col("n").alias("nb"))
    near = F.least("na", "nb") >= F.greatest("na", "nb") * (least / (2 - least)) - 1e-9
    met = a.join(b, "gram").where(near).select("a", "b").distinct().where(dice("a", "b") >= least)
    equal = left.select("a").distinct().join(right.select("b").distinct(), F.col("a") == F.col("b")).select("a", "b")
    return met.union(equal).distinct()


def candidates(names: DataFrame, pool: DataFrame, least: float = WEAK) -> DataFrame:
    """name, match, score, reason of pool names that score at least ``least``.

    Equal keys score 1, and names of different digits or qualifiers do not match. Every pair whose Dice
    coefficient reaches ``least`` is found, wherever the names differ; the score is the larger of that
    and the sequence ratio, which only raises it: a pair that reaches ``least`` by the ratio alone is not
    looked for, as no index bounds the ratio.
    """
    side = lambda df, n: df.select(F.col("name").alias(n), name_key("name").alias(f"{n}_key"), split_qualifier("name")["qualifier"].alias(f"{n}_q")).distinct()
    a, b = side(names, "name"), side(pool, "match")
    pairs = dice_pairs(a.select(F.col("name_key").alias("a")), b.select(F.col("match_key").alias("b")), least)
    both = a.join(pairs, F.col("name_key") == F.col("a")).join(b, F.col("match_key") == F.col("b"))
    fits = F.col("name_q").isNull() | F.col("match_q").isNull() | (F.lower("name_q") == F.lower("match_q"))
    both = both.where(fits & ~digits_differ("name_key", "match_key"))
    equal = F.col("name_key") == F.col("match_key")
    score = F.when(equal, 1.0).otherwise(F.greatest(dice("name_key", "match_key"), sequence_ratio("name_key", "match_key")))
    scored = both.withColumn("score", score)
    reason = F.when(F.col("score") == 1.0, "equal").when(F.col("score") >= STRONG, "strong").otherwise("weak")
    return scored.select("name", "match", "score", reason.alias("reason"))


def overlap_pairs(left: DataFrame, right: DataFrame, least: float = 0.8) -> DataFrame:
    """a, b, score of all rows of ``left`` (a, tokens) and ``right`` (b, tokens) whose distinct tokens overlap by ``least`` of the smaller set or more.

    Prefix filter: of n tokens, the smaller set shares n * least at least, so one of its first n - n * least + 1, counted from
    rare to frequent, is among the other's. Each side's prefixes meet the other side's tokens of sets at least as
    large; a pair is then decided by the whole sets. Sets without tokens match nothing.
    """
    sides = [df.select(F.col(c).alias("id"), F.array_distinct(F.filter("tokens", lambda w: w.isNotNull())).alias("tokens")).where("size(tokens) > 0") for df, c in ((left, "a"), (right, "b"))]
    sets = snapshot(sides[0].withColumn("side", F.lit(0)).unionByName(sides[1].withColumn("side", F.lit(1))), "sets")
    each = sets.select("side", "id", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    frequency = each.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    ordered = each.join(frequency, "token").groupBy("side", "id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))  # a set's own tokens
    length = (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int")
    prefix = ordered.select("side", "id", "n", F.explode(F.slice("t", F.lit(1), length)["token"]).alias("token"))
    pick = lambda df, side, n: df.where(F.col("side") == side).select(F.col("id").alias("ab"[side]), F.col("n").alias(n), "token")
    met = pick(prefix, 0, "na").join(pick(each, 1, "nb"), "token").where("nb >= na").select("a", "b")
    met = met.union(pick(prefix, 1, "nb").join(pick(each, 0, "na"), "token").where("na > nb").select("a", "b")).distinct()
    whole = lambda side, name: sets.where(F.col("side") == side).select(F.col("id").alias("ab"[side]), F.col("tokens").alias(name))
    shared = met.join(whole(0, "x"), "a").join(whole(1, "y"), "b").withColumn("score", token_overlap(F.col("x"), F.col("y")))
    return shared.where(F.col("score") >= least - 1e-9).select("a", "b", "score")


def best_only(pairs: DataFrame, key: str, match: str, score: str) -> DataFrame:
    """key, match, score of each key's best match; a key whose best score several matches share is refused and left out."""
    top = pairs.groupBy(key).agg(F.max(score).alias("_top"))
    held = pairs.join(top, key).where(F.col(score) == F.col("_top")).groupBy(key).agg(F.min(match).alias(match), F.max(match).alias("_last"), F.max(score).alias(score))
    return held.where(F.col(match) == F.col("_last")).drop("_last")
