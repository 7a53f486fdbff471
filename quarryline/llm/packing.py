"""Packing by cutting-stock column generation.

Each document's token ids are cut into full sequences and a remainder; the remainder is cut at half
a sequence and into a multiple of ``UNIT`` tokens and a short tail, so that the histogram of piece
lengths has few classes and patterns can fill a sequence to the last token. A linear program over patterns
(Gilmore and Gomory, 1961) covers the histogram: the simplex method prices new patterns by a knapsack
dynamic program until none helps; pattern counts are rounded down and the few pieces left over are
packed by best fit decreasing. Pieces are ranked within their class, and a rank names the piece's
sequence and place.

Only the histogram (at most ``capacity`` / UNIT + UNIT + 1 rows) and per-range counts' totals reach the driver;
pieces are ranked in ranges of documents, so a class that holds most rows is no single task.

Defined cases: a null text is empty and still has the end token; rows that repeat an id are packed
each; a null ``doc_id`` stays null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.llm.shared import bounded, cut, release, shuffle_partitions, sliced
from quarryline.llm.tokens import encoder

CAPACITY = 2048
UNIT = 16
END_ID = 1
#: Pieces that one ranking range should hold.
RANGE_PIECES = 100_000

_PIECES = "doc_id {kind}, start long, length int, ids_crc32 long, doc_tokens long, salt int"


def cuts(n: int, capacity: int = CAPACITY, unit: int = UNIT) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    full, rest = divmod(n, capacity)
    out = [(k * capacity, capacity) for k in range(full)]
    main = rest - rest % unit
    half = capacity // 2
    if main > half:  # two pieces over half could not share a sequence
        out.append((full * capacity, half))
        out.append((full * capacity + half, main - half))
    elif main:
        out.append((full * capacity, main))
    if rest > main:
        out.append((full * capacity + main, rest - main))
    return out


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, salt of every piece."""
    n_salts = max(shuffle_partitions(docs.sparkSession), -(-3 * docs.count() // RANGE_PIECES))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        row = 0
        for batch in sliced(batches, 1):
            owner, start, length, crc, total, salt = [], [], [], [], [], []
            for k, (doc_id, text) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                row += 1
                ids = np.array([*encode(text or ""), END_ID], "<u4").tobytes()
                n = len(ids) // 4
                for s, m in cuts(n, capacity, unit):
                    owner.append(k)
                    start.append(s)
                    length.append(m)
                    crc.append(zlib.crc32(ids[4 * s : 4 * (s + m)]))
                    total.append(n)
                    salt.append(zlib.crc32(f"{doc_id} {row} {s}".encode()) % n_salts)  # copies are spread too
            columns = [batch.column(0).take(pa.array(owner, pa.int32())), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64()), pa.array(total, pa.int64()), pa.array(salt, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"])
        release()

    return bounded(docs).select("doc_id", "text").mapInArrow(run, _PIECES.format(kind=kind))


def price(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: an unbounded knapsack by dynamic programming over the capacity."""
    useful = np.flatnonzero(values > 1e-12)
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    w, v = lengths[useful], values[useful]
    by = np.argsort(w)
    w, v, useful = w[by], v[by], useful[by]
    for c in range(1, capacity + 1):
        best[c], took[c] = best[c - 1], -1
        m = np.searchsorted(w, c, "right")
        if m:
            reach = best[c - w[:m]] + v[:m]
            k = int(np.argmax(reach))
            if reach[k] > best[c] + 1e-12:
                best[c], took[c] = reach[k], k
    pattern = np.zeros(len(lengths), np.int64)
    c = capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[useful[took[c]]] += 1
            c -= w[took[c]]
    return float(best[capacity]), pattern


def cutting_stock(lengths: np.ndarray, demand: np.ndarray, capacity: int, max_rounds: int = 3000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often the linear program uses each."""
    m = len(lengths)
    patterns = np.diag(capacity // lengths)
    for _ in range(max_rounds):
        basis = patterns.T.astype(float)
        x = np.linalg.solve(basis, demand.astype(float))
        duals = np.linalg.solve(basis.T, np.ones(m))
        value, column = price(duals, lengths, capacity)
        if value <= 1 + 1e-9:
            break
        direction = np.linalg.solve(basis, column.astype(float))
        ratio = np.where(direction > 1e-9, np.maximum(x, 0) / np.where(direction > 1e-9, direction, 1), np.inf)
        patterns[int(np.argmin(ratio))] = column
    return patterns, np.maximum(x, 0)


def best_fit(left: np.ndarray, lengths: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns for the pieces left over, longest first, each to the fullest sequence that takes it."""
    rooms: list[int] = []
    out: list[np.ndarray] = []
    for k in np.argsort(-lengths):
        for _ in range(int(left[k])):
            fit = [(r, i) for i, r in enumerate(rooms) if r >= lengths[k]]
            if fit:
                i = min(fit)[1]
            else:
                rooms.append(capacity)
                out.append(np.zeros(len(lengths), np.int64))
                i = len(rooms) - 1
            rooms[i] -= int(lengths[k])
            out[i][k] += 1
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, pieces a sequence, first sequence, offset) of each class in each pattern."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[int(n)] for n in lengths], np.int64)
    patterns, use = cutting_stock(lengths, demand, capacity)
    counts = np.floor(use + 1e-9).astype(np.int64)
    left = demand - patterns.T @ counts
    while (left < 0).any():  # rounding noise took a piece too many
        k = int(np.argmin(left))
        p = int(np.argmax(np.where(patterns[:, k] > 0, counts, -1)))
        counts[p] -= 1
        left = demand - patterns.T @ counts
    chosen = [(p, int(n)) for p, n in zip(patterns, counts) if n] + [(p, 1) for p in best_fit(left, lengths, capacity)]
    rows, ranks, sequence = [], np.zeros(len(lengths), np.int64), 0
    for pattern, times in chosen:
        offset = 0
        for k in np.flatnonzero(pattern)[::-1]:
            a = int(pattern[k])
            rows.append((int(lengths[k]), int(ranks[k]), int(ranks[k]) + a * times, a, sequence, offset))
            ranks[k] += a * times
            offset += a * int(lengths[k])
        sequence += times
    return rows


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    cut_up = cut(pieces(docs, tokenizer_path, capacity, unit), "pieces")
    counts = cut_up.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.createDataFrame(plan(histogram, capacity), "length int, low long, high long, each long, first long, at int")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = cut_up.withColumn("own", F.row_number().over(own) - 1).join(offsets, ["length", "salt"]).withColumn("rank", F.col("own") + F.col("before"))
    # the plan has at most (classes + patterns) * classes rows, whatever the input
    placed = ranked.join(F.broadcast(places), (ranked["length"] == places["length"]) & F.col("rank").between(F.col("low"), F.col("high") - 1)).drop(places["length"])
    k = F.col("rank") - F.col("low")
    return placed.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("first") + F.floor(k / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (k % F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )
