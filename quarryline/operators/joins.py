"""Joins: first-wins, cascades, overlaps, merges and pair weights.

Small sides are left to Spark's size-checked broadcast; nothing here forces one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row a key: the first in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def occurrence(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "occurrence") -> DataFrame:
    """Numbers the rows of each key from 1."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def stranded(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key ``right`` lacks."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def cascade(left: DataFrame, stages: Sequence[tuple[str, DataFrame]], key: str, result: str, default: str) -> DataFrame:
    """Resolves ``key`` by stages (name, candidates(key, result)): the first stage that has exactly one answer decides.

    A stage with several different answers decides for ``default`` (a tie is not broken); so does no answer at all.
    """
    out = left
    value, how = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, rows in stages:
        answers = rows.groupBy(key).agg(F.min(result).alias(f"_{name}"), (F.min(result) != F.max(result)).alias(f"_{name}_tie"))
        out = out.join(answers, key, "left")
        value = F.coalesce(value, F.when(F.col(f"_{name}_tie"), F.lit(default)).otherwise(F.col(f"_{name}")))
        how = F.coalesce(how, F.when(F.col(f"_{name}_tie"), F.lit("tie")).when(F.col(f"_{name}").isNotNull(), F.lit(name)))
    return out.select(*left.columns, F.coalesce(value, F.lit(default)).alias(result), F.coalesce(how, F.lit("none")).alias("how"))


def overlaps(df: DataFrame, group: str, ident: str, start: str, end: str, width: int) -> DataFrame:
    """Pairs (a < b) of one group whose intervals [start, end] meet.

    Intervals are cut into buckets of ``width``; two that meet share the bucket of the later start, so
    each pair is found once and only intervals of one bucket are compared.
    """
    cells = df.select(group, F.col(ident).alias("a"), F.col(start).alias("s"), F.col(end).alias("e"), F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))).alias("cell"))
    other = cells.select(group, F.col("a").alias("b"), F.col("s").alias("s2"), F.col("e").alias("e2"), "cell")
    both = cells.join(other, [group, "cell"]).where((F.col("a") < F.col("b")) & (F.col("s") <= F.col("e2")) & (F.col("s2") <= F.col("e")))
    return both.where(F.col("cell") == F.floor(F.greatest("s", "s2") / width)).select(group, "a", "b", (F.least("e", "e2") - F.greatest("s", "s2")).alias("shared"))


def three_way_merge(base: DataFrame, ours: DataFrame, theirs: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Field by field: ours if only we changed it, theirs if only they did or both agree, else ours, marked as conflict.

    A row deleted on one side and unchanged on the other is gone; a row that one side added stays.
    """
    sides = [d.select(*keys, F.struct(*fields).alias(n)) for d, n in ((base, "b"), (ours, "o"), (theirs, "t"))]
    rows = sides[0].join(sides[1], list(keys), "full_outer").join(sides[2], list(keys), "full_outer")
    b, o, t = F.col("b"), F.col("o"), F.col("t")
    gone = (o.isNull() & (t.eqNullSafe(b) | t.isNull())) | (t.isNull() & (o.eqNullSafe(b) | o.isNull()))
    rows = rows.where(~(gone & b.isNotNull()))
    merged, conflict = [], F.lit(False)
    for f in fields:
        x, y, z = b[f], F.when(o.isNotNull(), o[f]).otherwise(b[f]), F.when(t.isNotNull(), t[f]).otherwise(b[f])
        merged.append(F.when(y.eqNullSafe(x), z).otherwise(y).alias(f))
        conflict = conflict | (~y.eqNullSafe(x) & ~z.eqNullSafe(x) & ~y.eqNullSafe(z))
    return rows.select(*keys, *merged, conflict.alias("conflict"))


def latest_close(opened: DataFrame, closed: DataFrame, key: str, seen: str, at: str) -> DataFrame:
    """Open rows against the latest close of their key: ghost (not seen since), recurrence, or open."""
    last = closed.groupBy(key).agg(F.max(at).alias("closed_at"))
    state = F.when(F.col("closed_at").isNull(), "open").when(F.col(seen) < F.col("closed_at"), "ghost").otherwise("recurrence")
    return opened.join(last, key, "left").withColumn("state", state)


def pair_weights(occurrences: DataFrame, member: str, key: str, weight: str, most: int | None = None) -> DataFrame:
    """Member pairs (a < b) by the summed weight of shared keys.

    ``occurrences`` is (member, key, weight) without repeats. Keys that few members share make few
    pairs; members are the bounded side (sources), so a key makes at most members^2 / 2 pairs, which
    are added up map-side before the shuffle.
    """
    if most is not None:
        sizes = occurrences.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n").between(2, most))
        occurrences = occurrences.join(sizes.select(key), key, "left_semi")
    a = occurrences.select(F.col(member).alias("a"), key, weight)
    b = occurrences.select(F.col(member).alias("b"), key)
    return a.join(b, key).where("a < b").groupBy("a", "b").agg(F.sum(weight).alias("weight"), F.count(F.lit(1)).alias("shared"))
