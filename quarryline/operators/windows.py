"""Ranks, blocks, interleaving and movement."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.operators.snapshots import snapshot

#: Rows that one task packs at a time.
PIECE_ROWS = 50_000


def average_rank(value: Column, group: Sequence[str]) -> Column:
    """Rank from 1 in which ties share the mean of their places."""
    w = Window.partitionBy(*group).orderBy(value)
    peers = Window.partitionBy(*group, value)
    return F.rank().over(w) + (F.count(F.lit(1)).over(peers) - 1) / 2.0


def places(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str = "place") -> DataFrame:
    """Numbers the rows of each group from 1 in the given order; rows of equal order in any.

    All rows are sorted into ranges, so a group that holds most rows is numbered by many tasks: a row's
    place is its position in its range, counted from the group's first row there, after the group's rows in
    earlier ranges. For groups of bounded size a plain window is cheaper.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g).asc_nulls_first() for g in group] + [F.col(o) if isinstance(o, str) else o for o in order]
    rows = df.withColumn("_t", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(n, *keys, "_t").sortWithinPartitions(*keys, "_t").drop("_t")
    rows = snapshot(rows.withColumn("_seq", F.monotonically_increasing_id()), "places")
    part = F.shiftright("_seq", 33).alias("_part")
    firsts = rows.groupBy(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(group)], part).agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*[f"_g{k}" for k in range(len(group))]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    firsts = firsts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    on = F.shiftright(rows["_seq"], 33) == firsts["_part"]
    for k, g in enumerate(group):
        on = on & rows[g].eqNullSafe(firsts[f"_g{k}"])
    return rows.join(firsts, on).select(*df.columns, (F.col("_seq") - F.col("_first") + 1 + F.col("_before")).alias(name))


def blocks(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], size: int) -> DataFrame:
    """Blocks of ``size`` rows with their 1-based span."""
    return places(df, group, order, "n").withColumn("block", F.floor((F.col("n") - 1) / size)).groupBy(*group, "block").agg(F.min("n").alias("first"), F.max("n").alias("last"), F.count(F.lit(1)).alias("rows"))


def weave(df: DataFrame, lane: str, order: Sequence[Column | str], each: int, group: Sequence[str] = ()) -> DataFrame:
    """Interleaves lane 0 with ``each`` rows of lane 1 after every one of its own."""
    n = F.row_number().over(Window.partitionBy(*group, lane).orderBy(*order))
    key = F.when(F.col(lane) == 0, (F.col("_n") - 1).cast("double")).otherwise(F.floor((F.col("_n") - 1) / each) + 0.5)
    woven = df.withColumn("_n", n).withColumn("_k", key)
    return woven.withColumn("position", F.row_number().over(Window.partitionBy(*group).orderBy("_k", lane, "_n"))).drop("_n", "_k")


def movement(samples: DataFrame, key: str, at: str, value: str, window_s: int) -> DataFrame:
    """Each sample against the latest one at least ``window_s`` older: delta, reset (it fell) and stalled (it did not move)."""
    seconds = F.unix_timestamp(F.col(at).cast("timestamp"))
    older = Window.partitionBy(key).orderBy(seconds).rangeBetween(Window.unboundedPreceding, -window_s)
    before = F.max_by(F.struct(value), F.struct(seconds, F.col(value))).over(older)[value]
    return samples.withColumn("before", before).withColumn("delta", F.col(value) - F.col("before")).withColumn("reset", F.col("delta") < 0).withColumn("stalled", F.col("delta") == 0)


def pack_budget(df: DataFrame, group: str, order: str, size: str, budget: int, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Greedy blocks in order: a row starts a new block when it would exceed the budget; a larger row stands alone.

    The running total resets at each block, which no window frame expresses. Rows are sorted into
    ranges and cut into pieces of bounded size. A piece sums up what it does to any total that it is
    entered with: for each row that can be the first to start a block, the total and the blocks at its
    end. A group's pieces are then chained by their summaries, and each piece deals its own rows out.
    Rows of equal order are taken by size.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    keys = [group, order, size]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.select(*keys).withColumn("_t", F.monotonically_increasing_id()).repartitionByRange(n, *keys, "_t").sortWithinPartitions(*keys, "_t")
    rows = snapshot(ranged.select(*keys, F.monotonically_increasing_id().alias("_seq")), "ranged")
    place = F.row_number().over(Window.partitionBy(group, F.shiftright("_seq", 33)).orderBy("_seq")) - 1
    rows = snapshot(rows.withColumn("_piece", F.shiftright("_seq", 33) * 1_000_000 + F.floor(place / piece_rows)), "pieces")

    def starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums before each row, and for a block that starts at the row: the total and further blocks at the end."""
        before = np.r_[0, np.cumsum(sizes)]
        after = np.maximum(np.searchsorted(before[1:], before[:-1] + budget, "right"), np.arange(1, len(sizes) + 1))
        total, blocks = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for k in range(len(sizes) - 1, -1, -1):
            j = after[k]
            total[k], blocks[k] = (before[-1] - before[k], 0) if j == len(sizes) else (total[j], blocks[j] + 1)
        return before, total, blocks

    def summary(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        before, total, blocks = starts(part.sort_values("_seq")[size].to_numpy(np.int64))
        m = min(len(total), int(np.searchsorted(before[1:], budget, "right")) + 1)
        return pd.DataFrame({group: [key[0]], "_piece": [key[1]], "sums": [before[1 : m + 1]], "total": [total[:m]], "blocks": [blocks[:m]], "whole": [before[-1]], "first": [total[0]], "first_blocks": [blocks[0]]})

    def chain(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        held, block, out = 0, 0, []
        for r in part.sort_values("_piece").itertuples(index=False):
            out.append((key[0], r[1], held, block))
            if held == 0:  # rows of size 0 so far: the piece starts the block
                held, block = r.first, block + r.first_blocks
                continue
            k = int(np.searchsorted(r.sums, budget - held, "right"))
            held, block = (held + r.whole, block) if k >= len(r.sums) else (r.total[k], block + 1 + r.blocks[k])
        return pd.DataFrame(out, columns=[group, "_piece", "held", "block"])

    def deal(key: tuple, part: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_seq")
        held, block, out = int(state["held"].iloc[0]), int(state["block"].iloc[0]), []
        for n in part[size].tolist():
            if held and held + n > budget:
                block, held = block + 1, 0
            held += n
            out.append(block)
        return part[keys].assign(block=out)

    pieces = rows.groupBy(group, "_piece").applyInPandas(summary, f"{group} {kinds[group]}, _piece long, sums array<long>, total array<long>, blocks array<long>, whole long, first long, first_blocks long")
    state = pieces.groupBy(group).applyInPandas(chain, f"{group} {kinds[group]}, _piece long, held long, block long")
    dealt = rows.groupBy(group, "_piece").cogroup(state.groupBy(group, "_piece"))
    return dealt.applyInPandas(deal, f"{group} {kinds[group]}, {order} {kinds[order]}, {size} {kinds[size]}, block long")


def bin_pack(df: DataFrame, group: str, ident: str, size: str, bins: int) -> DataFrame:
    """Greedy longest-first balancing: each row, largest first, goes to the least loaded bin, the first of equals.

    Rows of one size are told apart only by their rank, so the walk is over a group's distinct sizes
    (whole numbers) with their counts, and the rows look their bin up by size and rank.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    sizes = df.groupBy(group, size).agg(F.count(F.lit(1)).alias("_n"))

    def deal(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """For each size: the bins of its first rows (``head``), and the order in which the bins go on to repeat."""
        loads = [0] * bins
        out = []
        for units, n in rows.sort_values(size, ascending=False)[[size, "_n"]].itertuples(index=False):
            head: list[int] = []
            least = lambda: min(range(bins), key=lambda b: (loads[b], b))
            while len(head) < n and (units == 0 or max(loads) - min(loads) >= units):
                head.append(least())
                loads[head[-1]] += units
                if units == 0:
                    break
            lap: list[int] = []
            if units and len(head) < n:  # level: from here on each lap gives every bin one row
                laps, rest = divmod(n - len(head), bins)
                level = list(loads)
                for _ in range(bins):
                    lap.append(min(range(bins), key=lambda b: (level[b], b)))
                    level[lap[-1]] += units
                for b in range(bins):
                    loads[b] += laps * units
                for b in lap[:rest]:
                    loads[b] += units
            out.append((key[0], units, head, lap or head))
        return pd.DataFrame(out, columns=[group, size, "head", "lap"])

    plan = sizes.groupBy(group).applyInPandas(deal, f"{group} {kinds[group]}, {size} {kinds[size]}, head array<int>, lap array<int>")
    rank = F.row_number().over(Window.partitionBy(group, size).orderBy(ident)) - 1
    placed = df.select(group, ident, size, rank.alias("_r")).join(plan, [group, size])
    late = F.get("lap", F.pmod(F.col("_r") - F.size("head"), F.size("lap")))
    return placed.select(group, ident, size, F.when(F.col("_r") < F.size("head"), F.get("head", F.col("_r"))).otherwise(late).alias("bin"))


def even_spread(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], want: int) -> DataFrame:
    """At most ``want`` rows a group, evenly spaced from first to last."""
    w = Window.partitionBy(*group)
    n, i = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy(*order)) - 1
    picks = F.transform(F.sequence(F.lit(0), F.lit(want - 1)), lambda k: F.floor(k * (F.col("_n") - 1) / F.lit(max(1, want - 1)) + 0.5))
    return df.withColumn("_n", n).withColumn("_i", i).where(F.array_contains(picks, F.col("_i"))).drop("_n", "_i")
