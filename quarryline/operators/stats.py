"""Correlation, intervals, dominance, pairwise-comparison models and permutation nulls."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.operators.snapshots import snapshot
from quarryline.operators.windows import average_rank


#: Steps of the fixed sequence: the inverses of the plastic number and of its square (fixed values).
LATTICE = (0.7548776662466927, 0.5698402909980532)


def correlations(df: DataFrame, columns: Sequence[str], least: int = 4) -> DataFrame:
    """a, b, n, r of every pair of columns over the rows that have both, in one pass of moments.

    Null below ``least`` rows or without variance. Columns are centred on their means first, which
    keeps the sums from cancelling.
    """
    means = df.agg(*[F.avg(c).alias(f"_m{k}") for k, c in enumerate(columns)])
    centred = df.crossJoin(F.broadcast(means)).select(*[(F.col(c) - F.col(f"_m{k}")).alias(f"_c{k}") for k, c in enumerate(columns)])  # means is one row
    parts = []
    for a, b in combinations(range(len(columns)), 2):
        x, y = F.col(f"_c{a}"), F.col(f"_c{b}")
        both = x.isNotNull() & y.isNotNull()
        on = lambda v, both=both: F.sum(F.when(both, v))
        n = F.count_if(both)
        sxy, sxx, syy = on(x * y) - on(x) * on(y) / n, on(x * x) - on(x) * on(x) / n, on(y * y) - on(y) * on(y) / n
        r = F.when((n >= least) & (sxx > 1e-12) & (syy > 1e-12), sxy / F.sqrt(sxx * syy))
        parts.append(F.struct(F.lit(columns[a]).alias("a"), F.lit(columns[b]).alias("b"), n.alias("n"), r.alias("r")))
    return centred.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def spearman(df: DataFrame, group: Sequence[str], x: str, y: str, least: int = 4) -> DataFrame:
    """Rank correlation a group on average-tie ranks."""
    ranked = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*group, average_rank(F.col(x), group).alias("rx"), average_rank(F.col(y), group).alias("ry"))
    return ranked.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.corr("rx", "ry").alias("rho")).where(F.col("n") >= least)


def weighted_composite(scores: Sequence[tuple[Column, float]], sigma: Column, rho: float) -> tuple[Column, Column]:
    """(mean, half-width): weights over the scores present, and the 95 % interval of equally correlated errors."""
    total = sum((F.when(s.isNotNull(), F.lit(w)).otherwise(0.0) for s, w in scores), F.lit(0.0))
    mean = F.try_divide(sum((F.coalesce(s * w, F.lit(0.0)) for s, w in scores), F.lit(0.0)), total)
    squares = sum((F.when(s.isNotNull(), F.lit(w * w)).otherwise(0.0) for s, w in scores), F.lit(0.0))
    variance = sigma * sigma * (squares * (1 - rho) + total * total * rho)
    return mean, F.try_divide(1.96 * F.sqrt(variance), total)


def covering_interval(df: DataFrame, group: str, value: str) -> DataFrame:
    """mean, population deviation, and a half-width of 1.96 deviations widened until it covers every value."""
    rows = df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return rows.select(group, "n", "mean", "sd", F.greatest(1.96 * F.col("sd"), F.col("_hi") - F.col("mean"), F.col("mean") - F.col("_lo")).alias("half"))


def dominance(vectors: DataFrame, ident: str, columns: Sequence[str]) -> DataFrame:
    """For each vector of a bounded set: how many of the others it dominates, ties with, or is incomparable to.

    For sets of representatives (types, brands, regions): all pairs are compared.
    """
    a = vectors.select(F.col(ident).alias("a"), F.struct(*columns).alias("x"))
    b = vectors.select(F.col(ident).alias("b"), F.struct(*columns).alias("y"))
    pairs = a.join(b, F.col("a") != F.col("b"))
    ge = F.lit(True)
    le = F.lit(True)
    for c in columns:
        ge, le = ge & (F.col("x")[c] >= F.col("y")[c]), le & (F.col("x")[c] <= F.col("y")[c])
    return pairs.groupBy(F.col("a").alias(ident)).agg(F.count_if(ge & ~le).alias("dominates"), F.count_if(le & ~ge).alias("dominated"), F.count_if(ge & le).alias("tied"), F.count_if(~ge & ~le).alias("incomparable"))


def bradley_terry(contests: DataFrame, rounds: int = 2000, tolerance: float = 1e-10, prior: float = 0.0) -> DataFrame:
    """player, strength (mean log 0), error (its standard error by the Fisher information) from (winner, loser, n).

    Minorise-maximise steps, each a join and an aggregation over the distinct pairs; the driver sees one
    number. ``prior`` adds so many wins and losses of each player against one of strength 1. Without it pairs
    must connect, and every player must have won and lost, or strengths would diverge (refused).
    """
    pairs = contests.where("winner <> loser").groupBy("winner", "loser").agg(F.sum("n").alias("n"))
    both = snapshot(pairs.select(F.col("winner").alias("a"), F.col("loser").alias("b"), F.col("n").alias("won"), "n").union(pairs.select(F.col("loser").alias("a"), F.col("winner").alias("b"), F.lit(0).cast("long").alias("won"), "n")).groupBy("a", "b").agg(F.sum("won").alias("won"), F.sum("n").alias("n")))
    record = both.groupBy("a").agg(F.sum("won").alias("wins"), F.sum("n").alias("games"))
    if prior <= 0 and not record.where("wins = 0 or wins = games").isEmpty():
        raise ValueError("a player has won or lost every contest; no finite strengths exist")
    strength = snapshot(record.select(F.col("a").alias("player"), F.lit(1.0).alias("s")))
    with_both = lambda s: both.join(s.select(F.col("player").alias("a"), F.col("s").alias("sa")), "a").join(s.select(F.col("player").alias("b"), F.col("s").alias("sb")), "b")
    for _ in range(rounds):
        weight = F.sum(F.col("n") / (F.col("sa") + F.col("sb"))) + 2 * prior / (F.col("sa") + 1)
        new = with_both(strength).groupBy("a", "sa").agg(((F.sum("won") + prior) / weight).alias("raw"))
        scale = new.agg((F.exp(F.avg(F.log("raw"))) if prior <= 0 else F.max(F.lit(1.0))).alias("g"))
        new = snapshot(new.crossJoin(F.broadcast(scale)).select(F.col("a").alias("player"), (F.col("raw") / F.col("g")).alias("s"), F.abs(F.log(F.col("raw") / F.col("g")) - F.log("sa")).alias("moved")))  # scale is one row
        strength = new.select("player", "s")
        if new.agg(F.max("moved")).first()[0] < tolerance:
            break
    else:
        raise RuntimeError(f"strengths did not settle in {rounds} rounds")
    p = F.col("sa") / (F.col("sa") + F.col("sb"))
    q = F.col("sa") / (F.col("sa") + 1)
    information = F.sum(F.col("n") * p * (1 - p)) + 2 * prior * q * (1 - q)
    mean = strength.agg(F.avg(F.log("s")).alias("m"))
    rows = with_both(strength).groupBy("a", "sa").agg((1 / F.sqrt(information)).alias("error"))
    return rows.crossJoin(F.broadcast(mean)).select(F.col("a").alias("player"), (F.log("sa") - F.col("m")).alias("strength"), "error")  # mean is one row


def deviance(contests: DataFrame, strengths: DataFrame) -> DataFrame:
    """One row: deviance, twice the log-likelihood that the strengths lose against pairs' own shares, and pairs."""
    pairs = contests.where("winner <> loser").groupBy("winner", "loser").agg(F.sum("n").alias("n"))
    total = pairs.groupBy(F.least("winner", "loser").alias("lo"), F.greatest("winner", "loser").alias("hi")).agg(F.sum("n").alias("all"))
    rows = pairs.join(total, (F.least("winner", "loser") == F.col("lo")) & (F.greatest("winner", "loser") == F.col("hi")))
    side = lambda n, s: strengths.select(F.col("player").alias(n), F.col("strength").alias(s))
    rows = rows.join(side("winner", "x"), "winner").join(side("loser", "y"), "loser")
    fitted = 1 / (1 + F.exp(F.col("y") - F.col("x")))
    return rows.agg((2 * F.sum(F.col("n") * (F.log(F.col("n") / F.col("all")) - F.log(fitted)))).alias("deviance"), F.count_distinct("lo", "hi").alias("pairs"))


def gradient_share(edges: DataFrame, rounds: int = 2000, tolerance: float = 1e-9) -> DataFrame:
    """eta: the share of an antisymmetric flow (a, b, y) that a potential explains; the rest is cyclic.

    Least-squares potentials by damped Jacobi sweeps, each a join and an average.
    """
    both = snapshot(edges.select("a", "b", "y").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), -F.col("y"))))
    p = snapshot(both.select(F.col("a").alias("v")).distinct().withColumn("p", F.lit(0.0)))
    for _ in range(rounds):
        seen = both.join(p.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b").groupBy("a").agg(F.avg(F.col("pb") - F.col("y")).alias("want"))
        new = snapshot(seen.join(p, F.col("a") == F.col("v")).select("v", (0.3 * F.col("p") + 0.7 * F.col("want")).alias("p"), F.abs(0.7 * (F.col("want") - F.col("p"))).alias("moved")))
        p = new.select("v", "p")
        if new.agg(F.max("moved")).first()[0] < tolerance:
            break
    else:
        raise RuntimeError(f"potentials did not settle in {rounds} rounds")
    fitted = edges.join(p.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a").join(p.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b")
    explained, total = F.sum(F.pow(F.col("pb") - F.col("pa"), 2)), F.sum(F.col("y") * F.col("y"))
    return fitted.agg(F.count(F.lit(1)).alias("edges"), F.try_divide(explained, total).alias("eta"))


def _drawn_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """trial, a, b, w: the weights of the pairs of members (by place) that are drawn together, added up within each batch.

    Rows are (trial, n, w, h): a key's members are the ``n`` places with the least hashes ``h``. A trial's pairs are a product
    of matrices, rows by members, whose places without a common row are left out.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        trial, n, w = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        h = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        order = np.argsort(h, axis=1, kind="stable")
        drawn = np.zeros(h.shape, np.float64)
        np.put_along_axis(drawn, order, np.arange(h.shape[1])[None, :] < n[:, None], axis=1)
        for t in np.unique(trial):
            held, weight = drawn[trial == t], w[trial == t]
            a, b = np.nonzero(np.triu(held.T @ held, 1))
            if len(a):
                total = (held.T @ (held * weight[:, None]))[a, b]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), t), pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(total)], names=["trial", "a", "b", "w"])


def null_threshold(occurrences: DataFrame, member: str, key: str, weight: str, trials: int = 40, share: float = 0.999, seed: int = 20) -> DataFrame:
    """trial, threshold: what pair weights arise by chance, as the ``share`` quantile (nearest rank) of each trial.

    Every key keeps the number of its members and its weight, and its members are drawn anew without
    repeats: of all members, those with the least hashes of (trial, key, member). Members are the bounded
    side (sources), so a key's draw is one small sort; pairs are added up batch by batch and never listed by key. ``occurrences`` is (member, key, weight) without
    repeats; keys of one member make no pair and are left out. The median of the trials is the threshold.
    """
    every = occurrences.select(member).distinct().agg(F.sort_array(F.collect_set(member)).alias("every"))
    sizes = occurrences.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("n"), F.max(weight).cast("double").alias("w")).where("n > 1")
    rows = sizes.crossJoin(every).withColumn("trial", F.explode(F.sequence(F.lit(1), F.lit(trials))))  # every is one row of members
    rows = rows.select("trial", "n", "w", F.transform("every", lambda m: F.xxhash64(F.lit(seed), F.col("trial"), F.col(key), m)).alias("h"))
    totals = rows.mapInArrow(_drawn_pairs, "trial int, a int, b int, w double").groupBy("trial", "a", "b").agg(F.sum("w").alias("w"))
    by = Window.partitionBy("trial")
    ranked = totals.select("trial", "w", F.row_number().over(by.orderBy("w")).alias("r"), F.count(F.lit(1)).over(by).alias("n"))  # one row a pair of members
    return ranked.where(F.col("r") == F.least(F.col("n"), F.floor(F.col("n") * share) + 1)).select("trial", F.col("w").alias("threshold"))


def at_least_one(rates: DataFrame, key: str, log10_median: str, sigma: str, samples: int = 20_000) -> DataFrame:
    """key, mean, point: the Monte-Carlo mean of 1 - exp(-x) for each row's log-normal x, beside the value at its median.

    The deviates are a fixed sequence in two dimensions (multiples of two irrational numbers, Box and Muller), so
    that the result depends neither on a generator nor on how samples are partitioned. Sums are added up map-side.
    """
    i = F.col("_i") + 0.5
    radius, angle = (i * step - F.floor(i * step) for step in LATTICE)
    normal = F.sqrt(-2 * F.ln(F.greatest(radius, F.lit(1e-12)))) * F.cos(2 * math.pi * angle)
    x = F.pow(F.lit(10.0), F.col(log10_median) + normal * F.col(sigma))
    drawn = rates.select(key, log10_median, sigma, F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("_i"))
    point = (1 - F.exp(-F.pow(F.lit(10.0), F.first(log10_median)))).alias("point")
    return drawn.groupBy(key).agg(F.avg(1 - F.exp(-x)).alias("mean"), point)


def median_threshold(trials: DataFrame) -> DataFrame:
    """trials, threshold: the upper median of the trials' thresholds."""
    ordered = trials.agg(F.array_sort(F.collect_list("threshold")).alias("t"))  # one number a trial
    return ordered.select(F.size("t").alias("trials"), F.get("t", F.floor(F.size("t") / 2).cast("int")).alias("threshold"))
