"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.shared import cut
from quarryline.operators.snapshots import discard

#: Edges that one task writes; fewer tasks than shuffle partitions where the graph is small.
TASK_EDGES = 10_000


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (its smallest reachable node) for each node of ``edges`` (a long, b long).

    Each round is two joins on nodes; the edge table is written to the shared folder after each
    round in place of the last one, in as many files as it needs, and the driver only reads its number of
    rows and a checksum.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = cut(edges, "edges")
    state = lambda: edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = state()
    for _ in range(max_rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(down.select("u", F.col("m").alias("v"))).distinct()
        last, edges = edges, cut(small.coalesce(1 + seen[0] // TASK_EDGES), "edges")
        discard(last)
        now = state()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(edges.groupBy(F.col("v").alias("node")).agg(F.min("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
