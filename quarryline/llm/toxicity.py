"""Toxicity: a character n-gram linear classifier with naive Bayes log-count ratios (NB-SVM style).

Features are the presence of hashed character n-grams of the whole lower-cased text. Counts of
n-grams by label are added up in Spark and give the log-count ratio of each feature. Every feature
whose ratio differs from zero by ``SIGNIFICANT`` standard errors takes part, scaled by its ratio, in a logistic
regression; the others carry nothing but noise. Its loss and gradient are added up in Spark tasks over
the sample's feature sets, and the driver takes L-BFGS steps. Scoring reads each text once, with
numpy on code points inside Arrow batches.

The classifier is fitted on a bounded sample of labelled rows (at most ``PER_CLASS`` ids of each label,
chosen by a hash of the id); the held-out fold is never read for it. Defined cases: a null or empty text
has no features and gets the intercept's score; a null ``doc_id`` is scored and not held out; labels
that are null or without a document are left out; a document labelled twice counts as toxic if any
label says so; an id counts once in the sample, however many rows repeat it, and of its texts that of the
least hash stands for it; with no usable labels every score is 0; further columns are ignored.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quarryline.llm.shared import bounded, cut, release, sliced

#: Labelled ids of each class that the classifier is fitted on, at most.
PER_CLASS = 8_000
SIZES = (3, 4, 5, 6)
BITS = 20
#: Standard errors by which a feature's log-count ratio differs from zero.
SIGNIFICANT = 3.0
#: Tasks that a step of the fit runs in, and the steps at most.
FIT_TASKS = 6
STEPS = 40
#: Characters worked on at a time.
PIECE = 1 << 20
HELD_OUT = 5
RIDGE = 1e-3


@dataclass
class Model:
    """Sorted feature numbers, their weights (log-count ratio times coefficient), and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, present: np.ndarray) -> float:
        z = self.intercept + float(self.weights[present].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _points(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, words parted by one space, with a space at either end."""
    joined = " " + " ".join((text or "").lower().split()) + " "
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)


def _grams(points: np.ndarray) -> Iterator[np.ndarray]:
    """Feature numbers of the n-grams, size by size."""
    h = np.zeros(len(points) + 1, np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(points) < n:
            return
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :] + np.uint64(n)
        if n in SIZES:
            x = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield (x >> np.uint64(64 - BITS)).astype(np.int32)


def present(text: str | None, place: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Distinct feature numbers of a text; with ``place`` (positions, and which there are), the distinct positions in the model instead."""
    points = _points(text)
    found = []
    for at in range(0, len(points), PIECE):
        for grams in _grams(points[at : at + PIECE + max(SIZES) - 1]):
            if place is not None:
                grams = place[0][grams[place[1][grams]]]  # the mask fits a core's cache, the places do not
            found.append(grams)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


def _places(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.full(1 << BITS, -1, np.int32)
    place[features] = np.arange(len(features))
    return place, place >= 0


def in_fold(doc_id: str = "doc_id"):
    """True for the rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    """text, y of the sample: one row an id, and at most ``per_class`` ids of each class, so the id list may be broadcast.

    An id's rows are brought to one before the shuffle, however many there are.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~in_fold())
    usable = usable.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    there = usable.join(docs.select("doc_id").distinct(), "doc_id").withColumn("h", F.xxhash64("doc_id"))
    no, yes = (there.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_class).select("doc_id", "y") for y in (0, 1))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(no.union(yes)), "doc_id")
    one = rows.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first"))
    return one.select("first.text", "y")


def _log_ratios(rows: DataFrame, totals: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The features that stand out and their naive Bayes log-count ratios; at most 2 ** BITS."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << BITS), np.int64)
        for batch in sliced(batches, 0):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[y, present(text)] += 1
        used = np.flatnonzero(sums.any(axis=0))
        for at in range(0, len(used), 1 << 16):
            part = used[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(sums[0, part]), pa.array(sums[1, part])], names=["feature", "no", "yes"])

    n0, n1 = totals
    counted = rows.mapInArrow(count, "feature int, no long, yes long").groupBy("feature").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    p, q = (F.col("yes") + 1) / F.lit(n1 + 2.0), (F.col("no") + 1) / F.lit(n0 + 2.0)
    ratio = F.log(p) - F.log(q)
    spread = F.sqrt(1 / (F.col("yes") + 1.0) + 1 / (F.col("no") + 1.0))
    stands_out = counted.select("feature", ratio.alias("r")).where(F.abs(ratio / spread) >= SIGNIFICANT)
    got = stands_out.orderBy("feature").toArrow()
    return got.column("feature").to_numpy().astype(np.int64), got.column("r").to_numpy()


def _loss(sets: DataFrame, w: np.ndarray, b: float, weights: tuple[float, float]) -> tuple[float, np.ndarray]:
    """The weighted logistic loss summed over the sample, and its gradient by ``w`` and ``b`` (the last entry)."""
    sent = sets.sparkSession.sparkContext.broadcast((w, b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = sent.value
        loss, gradient = 0.0, np.zeros(len(w) + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(1).to_numpy().astype(float)
            found = [np.frombuffer(x, np.int32) for x in batch.column(0).to_pylist()]
            size = np.array([len(x) for x in found])
            feature, at = np.concatenate(found), np.repeat(np.arange(len(found)), size)
            z = np.bincount(at, w[feature], len(found)) + b
            cost = np.where(y == 1, weights[1], weights[0])
            loss += float(cost @ (np.logaddexp(0, z) - y * z))
            error = cost * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
            gradient[:-1] += np.bincount(feature, error[at], len(w))
            gradient[-1] += error.sum()
        yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([gradient.tobytes()], pa.binary())], names=["loss", "gradient"])

    rows = sets.mapInArrow(run, "loss double, gradient binary").collect()  # one row a task
    sent.destroy()
    return sum(r.loss for r in rows), reduce(np.add, (np.frombuffer(r.gradient) for r in rows), np.zeros(len(w) + 1))


def _fit(sets: DataFrame, totals: tuple[int, int], ratios: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Coefficients of the scaled features and the intercept, by L-BFGS steps.

    The rarer class weighs more, by the square root of the classes' ratio.
    """
    n = sum(totals)
    weights = np.array([1.0, (totals[0] / totals[1]) ** 0.5])
    weights *= n / (weights @ totals)

    def value(v: np.ndarray) -> tuple[float, np.ndarray]:
        loss, gradient = _loss(sets, ratios * v[:-1], v[-1], (weights[0], weights[1]))
        gradient = gradient / n
        gradient[:-1] = gradient[:-1] * ratios + ridge * v[:-1]
        return loss / n + ridge / 2 * float(v[:-1] @ v[:-1]), gradient

    v = np.zeros(len(ratios) + 1)
    v[-1] = np.log(weights[1] * totals[1] / (weights[0] * totals[0]))
    loss, gradient = value(v)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []  # of the last steps: the step and the gradient's change
    for _ in range(STEPS):
        way = gradient.copy()
        used = []
        for s, y in reversed(pairs):
            used.append((s @ way) / (s @ y))
            way -= used[-1] * y
        way *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1e-12, float(np.linalg.norm(gradient)))
        for (s, y), a in zip(pairs, reversed(used)):
            way += (a - (y @ way) / (s @ y)) * s
        length = 1.0
        while True:
            new = v - length * way
            new_loss, new_gradient = value(new)
            if new_loss <= loss - 1e-4 * length * float(gradient @ way) or length < 1e-6:
                break
            length /= 2
        if (new_gradient - gradient) @ (new - v) > 1e-12:
            pairs = [*pairs[-9:], (new - v, new_gradient - gradient)]
        small = loss - new_loss < 1e-3 * max(loss, 1e-2)
        v, loss, gradient = new, new_loss, new_gradient
        if small:
            break
    else:
        warnings.warn(f"the fit has not settled after {STEPS} steps; its last coefficients are used", stacklevel=2)
    return v[:-1], float(v[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    rows = training_rows(bounded(docs), labels, label, per_class)
    totals = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0 if totals.get(1) else -50.0)
    features, ratios = _log_ratios(rows, (totals[0], totals[1]))
    place = _places(features)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 0):
            sets = [present(t, place).astype(np.int32) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([s.tobytes() for s in sets], pa.binary()), batch.column(1)], names=["set", "y"])

    sets = cut(rows.mapInArrow(chosen, "set binary, y int").repartition(FIT_TASKS), "sets")
    w, b = _fit(sets, (totals[0], totals[1]), ratios)
    return Model(features, w * ratios, b)


def score_column(docs: DataFrame) -> str:
    name = "toxicity"
    while name in docs.columns:
        name += "_"
    return name


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` and ``toxicity`` (0 to 1), with ``_`` appended to the name while it clashes."""
    name = score_column(docs)
    at = docs.columns.index("text")
    place = docs.sparkSession.sparkContext.broadcast((model, None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = place.value[0]
        table = _places(held.features)
        for batch in sliced(batches, at):
            scores = [held.score(present(t, table)) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])
        release()

    return bounded(docs).mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    scored = score(docs, train(docs, labels))
    return scored.where(F.col(score_column(docs)) < threshold).select(*docs.columns)
