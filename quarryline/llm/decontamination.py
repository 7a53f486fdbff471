"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A short test item inside a long document has a tiny Jaccard similarity to it, so documents are
searched in pieces of the items' own size (the domain partitioning of LSH Ensemble, Zhu et al.,
2016, turned on the long side): items are partitioned by their number of shingles into classes
[2**k, 2**(k+1)), and for each class a document is cut into pieces of 2**(k+2) shingles that overlap
by half, so that an item lies whole in some piece and its Jaccard similarity with it is bounded from
below. A piece and an item are compared by one-permutation MinHash: a piece is a candidate when it
agrees with the item in at least one bin's minimum. There are four times as many bins as a piece has
shingles, so that each shared shingle is its bin's minimum with a probability of 0.88, and an item
of 16 shingles or more of which 80 % are present is missed with a probability below 1e-12; the
classes of smaller items have 2**32 bins, where each shingle is a minimum. Candidates are
verified by exact containment of the item's shingle strings in the whole document.

Words are runs of letters, digits and all non-ASCII characters of the lower-cased text; a shingle is
five words. The items are read in slices of bounded size, each of which is sent to the tasks; the
documents are never shuffled or sent to the driver.

Defined cases: null texts count as empty; an item without words is never found; an item of fewer
than five words has one shingle, all its words, which only a document of the same words has; null
ids are kept as null; repeated rows are reported each; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.rolling import PUNCTUATION, shingle_hashes
from quarryline.llm.shared import bounded, cut, sliced

WIDTH = 5
THRESHOLD = 0.8
#: UTF-8 bytes of items that one slice may hold.
SLICE_BYTES = 8 << 20
#: Documents' bytes hashed at a time.
BATCH_BYTES = 2 << 20
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles(text: str | None, width: int = WIDTH) -> set[str]:
    w = words(text)
    if len(w) < width:
        return {" ".join(w)} if w else set()
    return {" ".join(w[k : k + width]) for k in range(len(w) - width + 1)}


def _hashes(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    return shingle_hashes([(t or "").lower().encode() for t in texts], width, PUNCTUATION)


class SizeClass:
    """Items with [2**k, 2**(k+1)) shingles: for each bin the items' minima, sorted for search."""

    def __init__(self, k: int, items: list[tuple[int, np.ndarray]]) -> None:
        self.step = 2 << k
        self.bins = 16 << k if k >= 4 else 1 << 32
        rows = [(key, i) for i, hashes in items for key in self.minima(hashes)]
        self.keys = np.array([r[0] for r in rows], np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.items = np.array([r[1] for r in rows], np.int64)[order]
        #: A bitmap over 20 bits of the keys spares most binary searches.
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def bin_of(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(0xFFFFFFFF)) % np.uint64(self.bins)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        """The least hash of each bin that has one; a hash tells its bin, so the value alone is the key."""
        order = np.lexsort((hashes, self.bin_of(hashes)))
        ranked = self.bin_of(hashes)[order]
        return hashes[order][np.r_[True, ranked[1:] != ranked[:-1]]] if len(order) else hashes

    def candidates(self, hashes: np.ndarray, document: np.ndarray, position: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) for each piece that shares a minimum with an item.

        Only values that are some item's minimum can agree; for those the piece's own minima of the
        bin are computed.
        """
        maybe = np.flatnonzero(self.seen[(hashes >> np.uint64(44)).astype(np.int64)])
        maybe = maybe[np.isin(hashes[maybe], self.keys)]
        found = set()
        bins = self.bin_of(hashes)
        starts = np.searchsorted(document, document[maybe])
        ends = np.searchsorted(document, document[maybe], "right")
        for at, start, end in zip(maybe.tolist(), starts.tolist(), ends.tolist()):
            piece = int(position[at]) // self.step
            for first in {max(0, piece - 1), piece}:  # pieces of two steps
                lo, hi = start + first * self.step, min(end, start + (first + 2) * self.step)
                if hashes[at] == hashes[lo:hi][bins[lo:hi] == bins[at]].min():
                    k = int(np.searchsorted(self.keys, hashes[at]))
                    while k < len(self.keys) and self.keys[k] == hashes[at]:
                        found.add((int(document[at]), int(self.items[k])))
                        k += 1
                    break
        return found


class Searcher:
    """A slice of items, ready to be sent to tasks."""

    def __init__(self, items: list[tuple[int | None, str | None]], width: int, threshold: float) -> None:
        self.width, self.threshold = width, threshold
        self.ids = [i for i, _ in items]
        self.sets = [shingles(t, width) for _, t in items]
        hashes, offsets = _hashes([t for _, t in items], width)
        classes: dict[int, list[tuple[int, np.ndarray]]] = {}
        for k in range(len(items)):
            own = np.unique(hashes[offsets[k] : offsets[k + 1]])
            if len(own):
                classes.setdefault(len(own).bit_length() - 1, []).append((k, own))
        self.classes = [SizeClass(k, group) for k, group in sorted(classes.items())]

    def search(self, ids: list, texts: list[str | None]) -> list[tuple]:
        hashes, offsets = _hashes(texts, self.width)
        document = np.repeat(np.arange(len(texts)), np.diff(offsets))
        position = np.arange(len(hashes)) - offsets[:-1][document]
        pairs = set().union(*(c.candidates(hashes, document, position) for c in self.classes))
        out, last, own = [], -1, set()
        for d, i in sorted(pairs):
            if d != last:
                last, own = d, shingles(texts[d], self.width)
            shared = len(self.sets[i] & own)
            if shared >= self.threshold * len(self.sets[i]):
                out.append((ids[d], self.ids[i], shared, len(self.sets[i]), shared / len(self.sets[i])))
        return out


_COLUMNS = ["doc_id", "item_id", "n_shared", "n_item", "containment"]


def _slices(items: DataFrame, slice_bytes: int) -> Iterator[tuple[list[tuple], bool]]:
    """Item slices of bounded size, and whether there are several; only one is on the driver at a time."""
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-total // slice_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        rows = [(r.item_id, r.text) for r in part.select("item_id", "text").collect()]
        if rows:
            yield rows, n > 1


def contained(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment for each item held by a document to at least ``threshold``."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind[0]}, item_id {kind[1]}, n_shared long, n_item long, containment double"
    out = None
    for rows, several in _slices(items, slice_bytes):
        sent = spark.sparkContext.broadcast(Searcher(rows, width, threshold))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            searcher = sent.value
            for batch in sliced(batches, 1, BATCH_BYTES):
                yield rows_of(searcher.search(batch.column(0).to_pylist(), batch.column(1).to_pylist()))

        def rows_of(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [[]] * 5
            kinds = [types[0], types[1], pa.int64(), pa.int64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=_COLUMNS)

        types = [pa.string() if k == "string" else pa.int32() if k == "int" else pa.int64() for k in kind]
        part = bounded(docs).select("doc_id", "text").mapInArrow(run, schema)
        if several:  # one slice's index is alive at a time
            part = cut(part, "contained")
            sent.destroy()
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], schema)


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``docs``, unchanged, that hold no item; tasks filter their own rows, nothing is shuffled."""
    at = docs.columns.index("text")
    for rows, several in _slices(items, slice_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(Searcher(rows, width, threshold))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            searcher = sent.value
            for batch in sliced(batches, at, BATCH_BYTES):
                texts = batch.column(at).to_pylist()
                leaks = {d for d, *_ in searcher.search(range(len(texts)), texts)}
                yield batch.filter(pa.array([k not in leaks for k in range(len(texts))], pa.bool_())) if leaks else batch

        docs = bounded(docs).mapInArrow(run, docs.schema)
        if several:
            docs = cut(docs, "clean")
            sent.destroy()
    return docs
