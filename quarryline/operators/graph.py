"""Graphs as edge tables: components, distances, linkage, depth."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.operators.snapshots import snapshot


def both_ways(edges: DataFrame) -> DataFrame:
    """(a, b, w) in both directions, the largest weight of repeats."""
    one = edges.where("a <> b")
    return one.select("a", "b", "w").union(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")).groupBy("a", "b").agg(F.max("w").alias("w"))


def follow(edges: DataFrame) -> DataFrame:
    """node, end, hops of each node of ``edges`` (a, b: one way on at most): where its chain ends, and in how many steps.

    Each round doubles the stretch that is known. Chains that run into a ring have no end (null ``end`` and ``hops``):
    they are those that still move once the stretch exceeds the number of nodes.
    """
    way = snapshot(edges.select(F.col("a").alias("node"), F.col("b").alias("end"), F.lit(1).cast("long").alias("hops"), F.lit(True).alias("moves")), "way")
    n = way.count()
    for _ in range(n.bit_length() + 1):
        onward = way.select(F.col("node").alias("end"), F.col("end").alias("next"), F.col("hops").alias("more"))
        joined = way.join(onward, "end", "left")
        way = snapshot(joined.select("node", F.coalesce("next", "end").alias("end"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"), F.col("next").isNotNull().alias("moves")), "way")
        if way.where("moves").isEmpty():
            break
    settled = lambda c: F.when(~F.col("moves"), F.col(c)).alias(c)
    return way.select("node", settled("end"), settled("hops"))


def components(edges: DataFrame, threshold: float, rounds: int = 100) -> DataFrame:
    """node, component (its smallest member) over edges of at least ``threshold``; isolates are absent.

    Labels jump along labels (pointer doubling), so rounds grow with the logarithm of the diameter.
    """
    links = snapshot(both_ways(edges.where(F.col("w") >= threshold)).select("a", "b"))
    label = snapshot(links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")))
    for _ in range(rounds):
        near = links.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("seen"))
        hop = label.select(F.col("node").alias("c2"), F.col("component").alias("jump"))
        new = label.join(near, "node").withColumn("low", F.least("component", "seen")).join(hop, F.col("low") == F.col("c2"), "left")
        new = snapshot(new.select("node", F.least("low", F.coalesce("jump", "low")).alias("component"), (F.least("low", F.coalesce("jump", "low")) != F.col("component")).alias("changed")))
        label = new.select("node", "component")
        if new.where("changed").isEmpty():
            return label
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def distances(edges: DataFrame, start: DataFrame, rounds: int = 10_000) -> DataFrame:
    """node, origin, distance: least sum of 1 / w from each start node, by rounds of relaxation until none changes.

    There are as many rounds as the longest least path has edges; beyond ``rounds`` it is refused.
    """
    links = snapshot(both_ways(edges).select("a", "b", (1.0 / F.col("w")).alias("d")))
    best = snapshot(start.select(F.col("node"), F.col("node").alias("origin"), F.lit(0.0).alias("distance")))
    for _ in range(rounds):
        reach = best.join(links, F.col("node") == F.col("a")).select(F.col("b").alias("node"), "origin", (F.col("distance") + F.col("d")).alias("distance"))
        new = snapshot(best.select("*", F.col("distance").alias("old")).unionByName(reach.withColumn("old", F.lit(None).cast("double"))).groupBy("node", "origin").agg(F.min("distance").alias("distance"), F.min("old").alias("old")))
        best = new.select("node", "origin", "distance")
        if new.where("old is null or distance < old - 1e-12").isEmpty():
            return best
    raise RuntimeError(f"distances did not settle in {rounds} rounds")


def eccentricity(edges: DataFrame, rounds: int = 10_000) -> DataFrame:
    """node, eccentricity (most hops to any node it reaches), reached (how many), by multi-source search."""
    hops = both_ways(edges).select("a", "b", F.lit(1.0).alias("w"))
    nodes = hops.select(F.col("a").alias("node")).distinct()
    d = distances(hops, nodes, rounds)
    return d.groupBy(F.col("origin").alias("node")).agg(F.max("distance").cast("int").alias("eccentricity"), (F.count(F.lit(1)) - 1).alias("reached"))


def complete_linkage(edges: DataFrame, threshold: float, most: int = 5_000) -> DataFrame:
    """node, cluster: merges the pair of clusters whose weakest cross link is strongest, down to ``threshold``.

    Clusters never cross connected components. A component is one dense matrix, so one of more than
    ``most`` nodes is refused: the nodes are sources, a small dimension, and not rows.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be positive")
    strong = both_ways(edges.where(F.col("w") >= threshold))
    label = components(edges, threshold)
    largest = label.groupBy("component").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest > most:
        raise ValueError(f"a component has {largest} nodes, and linkage takes {most}; raise the threshold")
    grouped = strong.join(label.select(F.col("node").alias("a"), "component"), "a").where("a < b")
    kind = label.schema["node"].dataType.simpleString()

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        nodes = sorted(set(rows["a"]) | set(rows["b"]))
        at = {n: k for k, n in enumerate(nodes)}
        w = np.zeros((len(nodes), len(nodes)))
        w[rows["a"].map(at), rows["b"].map(at)] = rows["w"]
        w = np.maximum(w, w.T)
        np.fill_diagonal(w, -1)
        member = list(range(len(nodes)))
        alive = np.ones(len(nodes), bool)
        while alive.sum() > 1:
            live = np.flatnonzero(alive)
            sub = np.triu(w[np.ix_(live, live)], 1)
            k = int(np.argmax(sub))
            i, j = live[k // len(live)], live[k % len(live)]
            if w[i, j] < threshold:
                break
            w[i] = w[:, i] = np.minimum(w[i], w[j])
            w[i, i] = -1
            alive[j] = False
            member = [i if m == j else m for m in member]
        return pd.DataFrame({"node": nodes, "cluster": [nodes[m] for m in member]})

    return grouped.groupBy("component").applyInPandas(cluster, f"node {kind}, cluster {kind}")


def prefix_rollup(df: DataFrame, path: str, separator: str = " ") -> DataFrame:
    """prefix, depth, n: rows below every prefix of a path."""
    parts = F.split(path, separator)
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(F.array_join(F.slice(parts, F.lit(1), k), separator).alias("prefix"), k.alias("depth")))
    return df.select(F.explode(prefixes).alias("p")).groupBy("p.prefix", "p.depth").agg(F.count(F.lit(1)).alias("n"))


def report(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """nodes, edges, parts, largest (part), isolates, diameter (most hops between two that reach each other); of a small graph."""
    links = both_ways(edges)
    far = eccentricity(links)
    parts = components(links.withColumn("w", F.lit(1.0)), 1.0).groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    alone = nodes.select(F.col("node")).distinct().join(far.select("node"), "node", "left_anti")
    one = lambda df, *columns: df.agg(*columns)  # noqa: E731  each is one row
    out = one(nodes.select("node").distinct(), F.count(F.lit(1)).alias("nodes")).crossJoin(one(links.where("a < b"), F.count(F.lit(1)).alias("edges")))
    out = out.crossJoin(one(parts, F.count(F.lit(1)).alias("parts"), F.max("n").alias("largest"))).crossJoin(one(alone, F.count(F.lit(1)).alias("isolates")))
    return out.crossJoin(one(far, F.max("eccentricity").alias("diameter")))


def dependency_faults(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, fault of a directed graph (a needs b) that should have no cycle: dangling (needs a node that is not there), cycle (reaches itself)."""
    from quarryline.operators.weights import strong_components

    known = nodes.select("node").distinct()
    dangling = edges.join(known.withColumnRenamed("node", "b"), "b", "left_anti").select(F.col("a").alias("node"), F.lit("dangling").alias("fault")).distinct()
    strong = strong_components(edges)
    rings = strong.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component")
    loops = edges.where("a = b").select(F.col("a").alias("node"))
    cycle = strong.join(rings, "component", "left_semi").select("node").union(loops).distinct().withColumn("fault", F.lit("cycle"))
    return dangling.union(cycle)
