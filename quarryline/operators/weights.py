"""Weights from pairwise comparisons, and strong components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.operators.snapshots import snapshot

#: Mean consistency index of random matrices by size (fixed values).
RANDOM_INDEX = [0.0, 0.0, 0.0, 0.58, 0.90, 1.12, 1.24, 1.32, 1.41, 1.45, 1.49]


def principal_weights(pairs: DataFrame, group: str) -> DataFrame:
    """group, i, principal, log_mean, consistency of reciprocal matrices given as (group, i, j, ratio).

    A matrix is a handful of criteria squared; each group is one small dense problem.
    """
    kind = pairs.schema[group].dataType.simpleString()

    def solve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(rows["i"]) | set(rows["j"]))
        at = {n: k for k, n in enumerate(names)}
        a = np.ones((len(names), len(names)))
        a[rows["i"].map(at), rows["j"].map(at)] = rows["ratio"]
        w = np.full(len(names), 1 / len(names))
        for _ in range(200):
            new = a @ w
            new /= new.sum()
            if np.abs(new - w).max() < 1e-14:
                break
            w = new
        largest = float((a @ w / w).mean())
        n = len(names)
        index = (largest - n) / (n - 1) if n > 1 else 0.0
        expected = RANDOM_INDEX[min(n, len(RANDOM_INDEX) - 1)]
        logs = np.exp(np.log(a).mean(axis=1))
        return pd.DataFrame({group: key[0], "i": names, "principal": w, "log_mean": logs / logs.sum(), "consistency": index / expected if expected else 0.0})

    return pairs.groupBy(group).applyInPandas(solve, f"{group} {kind}, i long, principal double, log_mean double, consistency double")


def strong_components(edges: DataFrame, rounds: int = 10_000) -> DataFrame:
    """node, component (its smallest member) over directed edges (a, b): forward and backward reachability by colour.

    Nodes without a way in or a way out are components of their own and leave first, round by round.
    Of the rest, every node takes the smallest node that reaches it as its colour; within a colour, what
    reaches the colour's own node is its component. Settled nodes leave, and the rest is coloured anew.
    """
    links = snapshot(edges.select("a", "b").distinct())
    left = snapshot(links.select(F.col("a").alias("node")).union(links.select("b")).distinct())
    links = snapshot(links.where("a <> b"))
    done = None
    for _ in range(rounds):
        within = links.select(F.col("a").alias("node")).intersect(links.select(F.col("b").alias("node")))
        lone = snapshot(left.join(within, "node", "left_anti"))
        part = lone.select("node", F.col("node").alias("component"))
        if lone.isEmpty():
            colour = _spread(links, left.select("node", F.col("node").alias("c")), "a", "b", rounds)
            inside = links.join(colour.select(F.col("node").alias("a"), F.col("c").alias("ca")), "a").join(colour.select(F.col("node").alias("b"), F.col("c").alias("cb")), "b").where("ca = cb").select("a", "b")
            part = _reach(inside, colour.where("node = c").select("node", "c"), rounds).select("node", F.col("c").alias("component"))
        done = snapshot(part if done is None else done.union(part))
        left = snapshot(left.join(part.select("node"), "node", "left_anti"))
        if left.isEmpty():
            return done
        links = snapshot(links.join(left.select(F.col("node").alias("a")), "a", "left_semi").join(left.select(F.col("node").alias("b")), "b", "left_semi"))
    raise RuntimeError(f"strong components did not settle in {rounds} rounds")


def _spread(links: DataFrame, start: DataFrame, source: str, target: str, rounds: int) -> DataFrame:
    state = snapshot(start)
    for _ in range(rounds):
        seen = links.join(state, F.col(source) == F.col("node")).groupBy(F.col(target).alias("node")).agg(F.min("c").alias("s"))
        new = snapshot(state.join(seen, "node", "left").select("node", F.least("c", F.coalesce("s", "c")).alias("c"), (F.col("s") < F.col("c")).alias("moved")))
        state = new.select("node", "c")
        if new.where("moved").isEmpty():
            return state
    raise RuntimeError(f"colours did not settle in {rounds} rounds")


def _reach(links: DataFrame, start: DataFrame, rounds: int) -> DataFrame:
    """Nodes that reach a start node, with the start's colour."""
    state = snapshot(start)
    for _ in range(rounds):
        more = snapshot(links.join(state, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "c").distinct().join(state.select("node"), "node", "left_anti"))
        if more.isEmpty():
            return state
        state = snapshot(state.union(more))
    raise RuntimeError(f"reachability did not settle in {rounds} rounds")
