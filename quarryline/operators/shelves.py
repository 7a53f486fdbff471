"""Shelving: an affinity order of linked members, cut into a tree of bounded branching."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.operators.graph import both_ways


def _walk(names: list[str], w: np.ndarray) -> list[int]:
    """Starts at the best-linked member and goes on to the nearest one left; ties go to the later name."""
    left = np.ones(len(names), bool)
    at = int(np.argmax(w.sum(axis=1)))
    order = [at]
    left[at] = False
    while left.any():
        near = np.where(left, w[at], -1.0)
        at = int(len(near) - 1 - np.argmax(near[::-1]))
        order.append(at)
        left[at] = False
    return order


def _cut(bonds: np.ndarray, span: int) -> list[int]:
    """Up to ``span - 1`` gaps: the weakest within half a step of each even boundary, never above the median bond."""
    n = len(bonds) + 1
    parts = min(span, n)
    step = n / parts
    weak = bonds <= np.sort(bonds)[len(bonds) // 2]
    chosen: set[int] = set()
    for k in range(1, parts):
        middle = min(max(round(step * k), 1), n - 1) - 1
        near = [g for g in range(len(bonds)) if weak[g] and abs(g - middle) <= step / 2 and g not in chosen]
        if near:
            chosen.add(min(near, key=lambda g: (bonds[g], abs(g - middle))))
    return sorted(chosen)


def shelve(edges: DataFrame, members: DataFrame, group: str, span: int = 7, depth: int = 3, most: int = 5_000) -> DataFrame:
    """member, path (``depth`` branch numbers, each below ``span``) for the members of each group.

    ``members`` is (group, member); edges (a, b, w) count inside a group. The walk is sequential on a
    dense matrix, so a group of more than ``most`` members (sources, a small dimension) is refused.
    """
    largest = members.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest > most:
        raise ValueError(f"a group has {largest} members, and shelving takes {most}")
    kind = members.schema[group].dataType.simpleString()
    inside = both_ways(edges).join(members.select(F.col("member").alias("a"), group), "a").join(members.select(F.col("member").alias("b"), F.col(group).alias("_g")), "b").where(F.col(group).eqNullSafe(F.col("_g")))
    linked = inside.select(group, "a", "b", "w").unionByName(members.select(group, F.col("member").alias("a"), F.col("member").alias("b"), F.lit(0.0).alias("w")))

    def tree(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(rows["a"]))
        place = {n: k for k, n in enumerate(names)}
        w = np.zeros((len(names), len(names)))
        w[rows["a"].map(place), rows["b"].map(place)] = rows["w"]
        order = _walk(names, w)
        bonds = w[order[:-1], order[1:]]
        paths: list[list[int]] = [[] for _ in names]
        blocks = [(0, len(order))]
        for _ in range(depth):
            below = []
            for lo, hi in blocks:
                edge = [lo, *(lo + g + 1 for g in (_cut(bonds[lo : hi - 1], span) if hi - lo > 1 else [])), hi]
                for child, (a, b) in enumerate(zip(edge, edge[1:])):
                    for k in order[a:b]:
                        paths[k].append(child)
                    below.append((a, b))
            blocks = below
        return pd.DataFrame({group: key[0], "member": names, "path": paths})

    return linked.groupBy(group).applyInPandas(tree, f"{group} {kind}, member string, path array<int>")
