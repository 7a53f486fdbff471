"""Resharding by minimum-cost flow.

Old shards are cut into blocks; the sizes of old shards and the capacities of new ones make a
transportation network in which a byte that stays costs nothing and a byte that moves costs one.
The flow of least cost (all shortest paths of one cost at a time, through a hub that what moves
passes) says how many bytes go from which shard to which; blocks are then chosen that realise the flow, and the shards that gain or lose blocks are the
only ones to rewrite.

Only block totals reach the driver: at most ``blocks`` times the number of shards, and as many more
as there are old shards. A shard's blocks are in proportion to its bytes, so a shard that holds a
third of all rows is split into as many blocks as it needs; no task holds a whole shard.

Defined cases: a null text has the size of the row overhead; a null ``doc_id`` or source hashes like
a value of its own; repeated rows are dealt over the blocks like any others and placed each; an empty
table gives an empty result; columns other than those named are ignored. A plan depends on how the input
was partitioned, as rows are dealt by their place in it; it is written once, so that all jobs see the same.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.llm.shared import cut

ROW_BYTES = 16
#: Blocks that a new shard consists of, about.
BLOCKS = 256
#: Bytes of a shard that one task writes, about.
TASK_BYTES = 128 << 20


def sized(docs: DataFrame, old_shard: Column) -> DataFrame:
    """doc_id, size, text_crc32, old of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), old_shard.cast("int").alias("old"))


def capacities(total: int, n: int) -> list[int]:
    """Near-equal shares of ``total`` bytes."""
    return [total * (k + 1) // n - total * k // n for k in range(n)]


class Network:
    """Arcs with room and cost; every arc has a reverse arc beside it, at its number xor 1."""

    def __init__(self, n: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def _distances(self, source: int, potential: list[int]) -> list[int | None]:
        """Least cost to each node over arcs with room, less what the potentials account for."""
        far: list[int | None] = [None] * len(self.out)
        heap = [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if far[a] is None:
                far[a] = d
                for e in self.out[a]:
                    if self.room[e] and far[self.to[e]] is None:
                        heapq.heappush(heap, (d + self.cost[e] + potential[a] - potential[self.to[e]], self.to[e]))
        return far

    def _blocking(self, source: int, sink: int, potential: list[int]) -> bool:
        """Fills all shortest paths of least cost (fewest arcs first); False if there is none."""
        free = lambda a, e: self.room[e] and not self.cost[e] + potential[a] - potential[self.to[e]]
        level = {source: 0}
        queue = [source]
        for a in queue:
            for e in self.out[a]:
                if self.to[e] not in level and free(a, e):
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        if sink not in level:
            return False
        ahead = [0] * len(self.out)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                push = min(self.room[e] for e in path)
                for e in path:
                    self.room[e] -= push
                    self.room[e ^ 1] += push
                full = next(k for k, e in enumerate(path) if not self.room[e])
                at = self.to[path[full] ^ 1]
                del path[full:]
                continue
            while ahead[at] < len(self.out[at]):
                e = self.out[at][ahead[at]]
                if level.get(self.to[e]) == level[at] + 1 and free(at, e):
                    break
                ahead[at] += 1
            if ahead[at] < len(self.out[at]):
                path.append(e)
                at = self.to[e]
            elif path:
                at = self.to[path.pop() ^ 1]
                ahead[at] += 1
            else:
                return True

    def flow(self, source: int, sink: int) -> None:
        """A flow of most bytes and, of those, least cost: all paths of one cost at a time, by rising cost."""
        potential = [0] * len(self.out)
        while True:
            far = self._distances(source, potential)
            if far[sink] is None:
                return
            beyond = max(d for d in far if d is not None)
            potential = [p + (beyond if d is None else d) for p, d in zip(potential, far)]
            while self._blocking(source, sink, potential):
                pass


def min_cost_flow(supply: dict[int, int], capacity: list[int], kept: dict[int, int]) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard; ``kept`` names the new shard that an old one lives on as.

    Every byte that moves costs the same, so what moves passes one hub: old shards send to their own
    new shard for nothing and to the hub for one, and the hub sends to new shards for nothing. The graph has as many
    arcs as there are shards, not their product, and the same least cost; bytes in the hub are then dealt out in order.
    """
    olds = sorted(supply)
    hub, sink = len(olds) + 1, len(olds) + len(capacity) + 2
    net = Network(sink + 1)
    stay, leave, come = {}, {}, {}
    for k, i in enumerate(olds):
        net.arc(0, 1 + k, supply[i], 0)
        if i in kept:
            stay[i] = net.arc(1 + k, hub + 1 + kept[i], supply[i], 0)
        leave[i] = net.arc(1 + k, hub, supply[i], 1)
    for j, room in enumerate(capacity):
        come[j] = net.arc(hub, hub + 1 + j, room, 0)
        net.arc(hub + 1 + j, sink, room, 0)
    net.flow(0, sink)
    used = lambda e: net.room[e ^ 1]
    flow = {(i, kept[i]): used(e) for i, e in stay.items() if used(e)}
    wanting = [[j, used(e)] for j, e in come.items() if used(e)][::-1]
    for i, e in leave.items():
        left = used(e)
        while left:
            j, want = wanting[-1]
            part = min(left, want)
            flow[i, j] = flow.get((i, j), 0) + part
            left -= part
            wanting[-1][1] -= part
            if not wanting[-1][1]:
                wanting.pop()
    return flow


def block_moves(blocks: dict[int, list[tuple[int, int]]], flow: dict[tuple[int, int], int], capacity: list[int], kept: dict[int, int]) -> dict[tuple[int, int], int]:
    """New shard of each (old shard, block), following the flow as closely as whole blocks can.

    Blocks go largest first to the arc of their shard with the most bytes still to send; then single
    blocks move between the fullest and the emptiest shard while that brings them closer.
    """
    target: dict[tuple[int, int], int] = {}
    fill = [0] * len(capacity)
    leaving: dict[int, list[list]] = defaultdict(list)
    for (i, j), f in flow.items():
        leaving[i].append([-f, kept.get(i) != j, j])
    for i, own in sorted(blocks.items()):
        open_arcs = leaving[i]
        heapq.heapify(open_arcs)
        for size, b in sorted(own, key=lambda x: (-x[0], x[1])):
            best = heapq.heappop(open_arcs) if open_arcs else [0, True, min(range(len(capacity)), key=lambda j: fill[j] - capacity[j])]
            target[i, b] = best[2]
            fill[best[2]] += size
            best[0] += size
            heapq.heappush(open_arcs, best)
    sizes = {(i, b): size for i, own in blocks.items() for size, b in own}
    members: dict[int, list[tuple[int, tuple[int, int]]]] = defaultdict(list)
    for key, j in target.items():
        members[j].append((sizes[key], key))
    over = lambda j: fill[j] - capacity[j]
    # the fullest and the emptiest shard; entries that a move has made untrue are passed over
    full, empty = [(-over(j), j) for j in range(len(capacity))], [(over(j), j) for j in range(len(capacity))]
    heapq.heapify(full)
    heapq.heapify(empty)
    for _ in range(20 * len(capacity)):
        while -full[0][0] != over(full[0][1]):
            heapq.heappop(full)
        while empty[0][0] != over(empty[0][1]):
            heapq.heappop(empty)
        high, low = full[0][1], empty[0][1]
        gap = over(high) - over(low)
        # a block of about half the gap, or the best exchange of two blocks
        single = min((m for m in members[high] if m[0] < gap), key=lambda m: abs(2 * m[0] - gap), default=None)
        if single is None:
            break
        best, swap = abs(2 * single[0] - gap), None
        few = sorted(members[low])[:: max(1, len(members[low]) // 64)]
        for a in members[high][:: max(1, len(members[high]) // 64)]:
            for b in few:
                if 0 < a[0] - b[0] < gap and abs(2 * (a[0] - b[0]) - gap) < best:
                    best, swap = abs(2 * (a[0] - b[0]) - gap), (a, b)
        if best >= gap:
            break
        out, back = swap if swap else (single, None)
        for m, a, b in ((out, high, low), (back, low, high)):
            if m is not None:
                members[a].remove(m)
                members[b].append(m)
                target[m[1]] = b
                fill[a] -= m[0]
                fill[b] += m[0]
        for j in (high, low):
            heapq.heappush(full, (-over(j), j))
            heapq.heappush(empty, (over(j), j))
    return target


def reshard(docs: DataFrame, old_shard: Column, n_new: int, kept: dict[int, int] | None = None, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, size, text_crc32, old, shard, slot, moved of every row of ``docs``.

    ``kept`` maps an old shard to the new one that takes over its files (by default the one of the
    same number). ``slot`` counts from 0 in each shard without gaps.
    """
    spark = docs.sparkSession
    rows = cut(sized(docs, old_shard).withColumn("row", F.monotonically_increasing_id()), "sized")
    old_bytes = {r.old: r.b for r in rows.groupBy("old").agg(F.sum("size").alias("b")).collect()}
    schema = "old int, block int, shard int, before long"
    if not old_bytes:
        return _placed(rows.withColumn("block", F.lit(0)), spark.createDataFrame([], schema), kept)
    total = sum(old_bytes.values())
    kept = kept if kept is not None else {i: i for i in old_bytes if i is not None and 0 <= i < n_new}
    per_block = max(1, total // (n_new * blocks))
    counts = spark.createDataFrame([(i, max(1, -(-b // per_block))) for i, b in old_bytes.items()], "old int, n long")
    rows = rows.join(F.broadcast(counts), rows["old"].eqNullSafe(counts["old"])).drop(counts["old"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32", "row"), "n").cast("int")).drop("n")
    totals = rows.groupBy("old", "block").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    capacity = capacities(total, n_new)
    own: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for r in totals:
        own[-1 if r.old is None else r.old].append((r.b, r.block))
    flow = min_cost_flow({-1 if i is None else i: b for i, b in old_bytes.items()}, capacity, kept)
    target = block_moves(own, flow, capacity, kept)
    placed, before = [], [0] * n_new
    for r in sorted(totals, key=lambda r: (r.old is None, r.old or 0, r.block)):
        j = target[-1 if r.old is None else r.old, r.block]
        placed.append((r.old, r.block, j, before[j]))
        before[j] += r.n
    return _placed(rows, spark.createDataFrame(placed, schema), kept)


def _placed(rows: DataFrame, places: DataFrame, kept: dict[int, int] | None) -> DataFrame:
    own = Window.partitionBy("old", "block").orderBy("doc_id", "text_crc32", "row")
    rows = rows.withColumn("own", F.row_number().over(own) - 1)
    both = rows.join(F.broadcast(places), rows["old"].eqNullSafe(places["old"]) & (rows["block"] == places["block"])).drop(places["old"]).drop(places["block"])
    stays = F.lit(False)
    for i, j in (kept or {}).items():
        stays = stays | (F.col("old").eqNullSafe(i) & (F.col("shard") == j))
    return both.select("doc_id", "size", "text_crc32", "old", "shard", (F.col("before") + F.col("own")).cast("long").alias("slot"), (~stays).alias("moved"))


def affected(plan: DataFrame) -> list[int]:
    """New shards whose files change: those that gain rows or lose them. Bounded by the number of shards."""
    gains = plan.where("moved").select(F.col("shard").alias("k"))
    losses = plan.where("moved").select(F.col("old").alias("k"))
    return sorted(r.k for r in gains.union(losses).where("k is not null").distinct().collect())


def rewrite(docs: DataFrame, old_shard: Column, plan: DataFrame, folder: str, task_bytes: int = TASK_BYTES) -> list[int]:
    """Writes the affected shards of ``folder``, one folder ``shard=N`` each, and returns their numbers.

    The files of all other shards stay as they are, and shards that end empty are emptied. ``plan`` is
    what ``reshard`` gave for these ``docs`` and ``old_shard``. Each row of ``docs`` is written at most
    once: rows of equal id, text and old shard share the places that the plan has for them. ``docs`` may
    be read from ``folder`` itself; a column ``shard`` of its own is replaced by the new number.
    """
    spark = docs.sparkSession
    plan = cut(plan.select("doc_id", "text_crc32", "old", "shard", "moved", "size"), "plan")
    changed = affected(plan)
    if not changed:
        return changed
    kept = [c for c in docs.columns if c != "shard"]
    names = ["id", "crc", "from", "to", "task", "place", "before"]
    while any(n in docs.columns for n in names):
        names = [f"_{n}" for n in names]
    id_, crc, old, to, task, place, before = names
    # a key's places: for each shard the number of its last row; at most one entry a shard
    each = plan.groupBy(F.col("doc_id").alias(id_), F.col("text_crc32").alias(crc), F.col("old").alias(old), "shard").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(id_, crc, old).orderBy("shard"))
    places = each.select(id_, crc, old, "shard", upto.alias("upto")).groupBy(id_, crc, old).agg(F.sort_array(F.collect_list(F.struct("upto", "shard"))).alias(to))
    places = places.where(F.exists(to, lambda x: x["shard"].isin(changed)))
    keyed = docs.withColumns({id_: F.col("doc_id"), crc: F.crc32(F.coalesce(F.col("text"), F.lit(""))), old: old_shard.cast("int")}).drop("shard")
    on = keyed[id_].eqNullSafe(places[id_]) & (keyed[crc] == places[crc]) & keyed[old].eqNullSafe(places[old])
    joined = keyed.join(places, on).select(*[keyed[c] for c in [*kept, *names[:3]]], to)
    one = joined.where(F.size(to) == 1).select(*kept, F.col(to)[0]["shard"].alias("shard"))
    # rows that repeat and part are numbered: by task first, so that no key is numbered in one place
    several = cut(joined.where(F.size(to) > 1).withColumn(task, F.spark_partition_id()), "several")
    counts = several.groupBy(id_, crc, old, task).agg(F.count(F.lit(1)).alias("n"))
    by_task = Window.partitionBy(id_, crc, old).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(id_, crc, old, task, F.coalesce(F.sum("n").over(by_task), F.lit(0)).alias(before))
    numbered = several.withColumn(place, F.row_number().over(Window.partitionBy(id_, crc, old, task).orderBy(F.lit(1))))
    on = numbered[id_].eqNullSafe(counts[id_]) & (numbered[crc] == counts[crc]) & numbered[old].eqNullSafe(counts[old]) & (numbered[task] == counts[task])
    number = F.col(place) + F.col(before)
    dealt = numbered.join(counts, on).select(*[numbered[c] for c in kept], F.filter(to, lambda x: x["upto"] >= number)[0]["shard"].alias("shard"))
    rows = cut(one.unionByName(dealt).where(F.col("shard").isin(changed)), "rows")
    full = [r.shard for r in rows.select("shard").distinct().collect()]
    # as many tasks a shard as its bytes need; one row a shard that changes
    tasks = plan.where(F.col("shard").isin(full)).groupBy(F.col("shard").alias(to)).agg(F.ceil(F.sum("size") / F.lit(task_bytes)).cast("int").alias(task))
    sized = rows.join(F.broadcast(tasks), rows["shard"] == tasks[to])
    spread = F.pmod(F.xxhash64("doc_id", F.col("text")), F.col(task))
    sized.repartition("shard", spread).drop(to, task).write.partitionBy("shard").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(folder)
    for k in sorted(set(changed) - set(full)):
        spark.createDataFrame([], rows.drop("shard").schema).write.mode("overwrite").parquet(f"{folder}/shard={k}")
    return changed
