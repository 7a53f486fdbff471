"""Chat formatting with cumulative-snapshot collapse.

Logged conversations are often snapshots: each later one repeats the earlier turns and adds some.
A rolling hash over turn prefixes (bit_xor of hashes of position, role and text, in two lanes)
identifies them: a conversation is collapsed when its whole hash is that of a proper prefix of a
longer one. An anti-join keeps the maximal conversations, which are then rendered, one row each.

Turns are sorted into ranges, so that no conversation, and no turn number that many turns share, is
ranked or hashed in one task: a conversation's part in a range is a block, and block totals give each
block its starting position and hash. Texts are shuffled once for the order and once for rendering;
all between works on hashes. Only the rendered text itself is one value, as long as the conversation.

Defined cases: turns are ordered by (turn, role, text), nulls first; a null role renders as
"unknown", a null text as the empty string; a null ``conv_id`` is one conversation of its own; turns
that repeat are all kept; identical conversations of equal length are all kept, as neither is a
proper prefix; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.llm.shared import cut, shuffle_partitions

LANES = ("1", "2")


def _shown() -> list:
    return [F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit(""))]


def hashed_turns(turns: DataFrame, ranges: int | None = None) -> DataFrame:
    """conv_id, block, seq (increasing in turn order), t1, t2 (hashes of role and text) of every turn."""
    n = ranges or shuffle_partitions(turns.sparkSession)
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("tie", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "text", "tie"]  # the tie parts equal turns, in any order
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    role, text = _shown()
    light = ordered.select("conv_id", F.monotonically_increasing_id().alias("seq"), F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit("second"), text, role).alias("t2"))
    return cut(light.withColumn("block", F.shiftright("seq", 33).cast("int")), "turns")


def _with_starts(rows: DataFrame, **totals) -> DataFrame:
    """Adds to each row the total over its conversation's earlier blocks, by name: (aggregate of rows, aggregate of blocks)."""
    before = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(F.col("conv_id").alias("c"), F.col("block").alias("b")).agg(*[own.alias(name) for name, (own, _) in totals.items()])
    starts = blocks.select("c", "b", *[F.coalesce(over(name).over(before), F.lit(0)).cast("long").alias(name) for name, (_, over) in totals.items()])
    return rows.join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")


def positions(turns: DataFrame, ranges: int | None = None) -> DataFrame:
    """conv_id, block, pos (from 0 in the conversation), h1, h2 of every turn."""
    own = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("seq")) - 1
    placed = _with_starts(hashed_turns(turns, ranges), first=(F.count(F.lit(1)), F.sum)).withColumn("pos", own + F.col("first"))
    return cut(placed.select("conv_id", "block", "pos", *[F.xxhash64("pos", f"t{k}").alias(f"h{k}") for k in LANES]), "positions")


def prefixes(placed: DataFrame) -> DataFrame:
    """conv_id, length, p1, p2: the rolling hash of every turn prefix."""
    running = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    started = _with_starts(placed, **{f"x{k}": (F.bit_xor(f"h{k}"), F.bit_xor) for k in LANES})
    return started.select("conv_id", (F.col("pos") + 1).alias("length"), *[F.bit_xor(f"h{k}").over(running).bitwiseXOR(F.col(f"x{k}")).alias(f"p{k}") for k in LANES])


def maximal(turns: DataFrame, ranges: int | None = None) -> DataFrame:
    """conv_id, n_turns of each conversation that is no proper prefix of another."""
    placed = positions(turns, ranges)
    whole = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), *[F.bit_xor(f"h{k}").alias(f"p{k}") for k in LANES])
    longest = whole.select(F.col("conv_id").alias("c"), "n_turns")
    proper = prefixes(placed).join(longest, F.col("conv_id").eqNullSafe(F.col("c"))).where("length < n_turns").select("length", "p1", "p2").distinct()
    # copies of a conversation share one key; the join runs on the distinct keys first
    keys = whole.select("n_turns", "p1", "p2").distinct()
    kept = keys.join(proper, (keys["n_turns"] == proper["length"]) & (keys["p1"] == proper["p1"]) & (keys["p2"] == proper["p2"]), "left_anti")
    return whole.join(kept, ["n_turns", "p1", "p2"], "left_semi").select("conv_id", "n_turns")


def render(turns: DataFrame, ranges: int | None = None) -> DataFrame:
    """conv_id, n_turns, text of the maximal conversations, one line group per turn."""
    kept = cut(maximal(turns, ranges), "maximal").select(F.col("conv_id").alias("c"), "n_turns")
    wanted = turns.select("conv_id", "turn", "role", "text").join(kept, F.col("conv_id").eqNullSafe(F.col("c")))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))  # nulls first
    grouped = wanted.groupBy("conv_id", "n_turns").agg(ordered.alias("turns"))
    line = lambda t: F.concat(F.lit("<|"), F.coalesce(t["role"], F.lit("unknown")), F.lit("|>\n"), F.coalesce(t["text"], F.lit("")), F.lit("\n<|end|>"))
    return grouped.select("conv_id", "n_turns", F.array_join(F.transform("turns", line), "\n").alias("text"))
