"""Substring dedup: Rabin-Karp hashes of every fixed-length token window, counted in Spark.

Every window of ``length`` words of every text is hashed. A task first counts its own windows:
of equal ones only the earliest goes on, so a passage that a third of all rows share costs one row
per task, and the others are marked at once. The survivors are shuffled by their anchor, the least
hash among the shorter word runs inside the window: equal windows have equal anchors, and some seven
neighbouring windows share one, so that their document and position are sent once for all of them,
however many ranges there are. In each range of anchors, windows whose hash also starts in an
earlier document are marked. Marked windows go back by document, where they merge into maximal
removal intervals.

An anchor that many windows share in different contexts (a common run of words with a low hash)
would fill its range. A sample of the documents tells the anchors that make up more than half of a range;
their windows are dealt by their own hash instead. That only says where windows meet: equal ones
still meet, so results do not depend on the sample.

Windows are equal if their 64-bit hash and their range are; anchors are hashed independently, so with a
range for each million windows some 87 bits tell the windows of 100 TB apart, and less than one pair of
different windows is expected to be taken for equal.

Order: smaller ``doc_id`` first. Defined cases: a null text is empty; a null ``doc_id`` comes after
all others; rows that repeat id and text are one document (each gets its result); rows with one id
and different texts are ordered by a hash of their text; texts shorter than a window lose nothing;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.rolling import anchors, window_hashes, word_hashes
from quarryline.llm.shared import bounded, release, shuffle_partitions, sliced, text_bytes

LENGTH = 20
#: Words of the runs that anchors are taken from.
ANCHOR = 6
#: Words that a task counts by itself, and windows that one range should hold.
FLUSH_WORDS = 1_000_000
RANGE_WINDOWS = 1_000_000
#: Text bytes that the sample for dense anchors should have, and its least share of all.
SAMPLE_BYTES, SAMPLE_SHARE = 64 << 20, 1 / 4096
_NULL_ID = 2**63 - 1
_PACKED = "bucket int, marked boolean, hashes binary, ids binary, tags binary, counts binary, positions binary"
_NAMES = [c.split()[0] for c in _PACKED.split(", ")]
_KINDS = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]


def _named(docs: DataFrame) -> DataFrame:
    """Adds the key of a document: its id (nulls last) and a checksum of its text."""
    tag = F.coalesce(F.crc32("text"), F.lit(0))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), tag.alias("tag"), F.col("doc_id"), "text")


def _pack(bucket: int, hashes: np.ndarray | None, keys: np.ndarray, document: np.ndarray, position: np.ndarray) -> list:
    """One row of windows given by document and position.

    Runs of windows at neighbouring positions are sent as (step from the last run's end, length).
    """
    new = np.r_[True, document[1:] != document[:-1]]
    run = np.flatnonzero(new | np.r_[True, position[1:] != position[:-1] + 1])
    length = np.diff(np.r_[run, len(document)])
    end = position[run] + length
    step = position[run] - np.r_[0, end[:-1]]
    first = new[run]
    step[first] = position[run][first]
    edge = np.flatnonzero(first)
    owners = document[run][edge]
    counts = np.diff(np.r_[edge, len(run)])
    pairs = np.stack([step, length], axis=1)
    narrow = pairs.max(initial=0) < 1 << 16
    sent = b"" if hashes is None else hashes.tobytes()
    return [bucket, hashes is None, sent, keys[owners, 0].tobytes(), keys[owners, 1].astype(np.uint32).tobytes(), counts.astype(np.uint32).tobytes(), (b"\x02" if narrow else b"\x04") + pairs.astype(np.uint16 if narrow else np.uint32).tobytes()]


def _unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hashes, keys (id, tag), document of each window, position of each window."""
    keys = np.stack([np.frombuffer(row.ids, np.int64), np.frombuffer(row.tags, np.uint32).astype(np.int64)], axis=1)
    counts = np.frombuffer(row.counts, np.uint32).astype(np.int64)
    pairs = np.frombuffer(row.positions[1:], np.uint16 if row.positions[:1] == b"\x02" else np.uint32).astype(np.int64).reshape(-1, 2)
    upto = np.cumsum(pairs.sum(axis=1))
    edge = np.cumsum(counts) - counts
    start = upto - pairs[:, 1] - np.repeat(upto[edge] - pairs[edge].sum(axis=1), counts)
    length = pairs[:, 1]
    position = np.repeat((start - (np.cumsum(length) - length)).astype(np.int32), length) + np.arange(int(length.sum()), dtype=np.int32)
    document = np.repeat(np.repeat(np.arange(len(keys), dtype=np.int32), counts), length)
    return np.frombuffer(row.hashes, np.uint64), keys, document, position


def _table(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)


def _scatter(n_buckets: int, bucket: np.ndarray, hashes: np.ndarray | None, keys: np.ndarray, document: np.ndarray, position: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows for each bucket; windows are given in order of document and position, which stays within a bucket."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(edges)):
        at = order[edges[b] : edges[b + 1]]
        rows.append(_pack(int(b), None if hashes is None else hashes[at], keys, document[at], position[at]))
        if len(rows) == 256:
            yield _table(rows)
            rows = []
    if rows:
        yield _table(rows)


def _document_bucket(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    h = (keys[:, 0] ^ (keys[:, 1] << 20)).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int32)


def dense_anchors(docs: DataFrame, length: int, n_buckets: int, total_bytes: int) -> np.ndarray:
    """The anchors that more than half a range's windows share, by a sample of the documents; at most two a range."""
    share = max(SAMPLE_SHARE, min(1.0, SAMPLE_BYTES / max(1, total_bytes)))
    spread = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    sample = bounded(docs).where(spread & F.col("text").isNotNull()) if share < 1 else bounded(docs).where(F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 0):
            words, offsets = word_hashes([t.encode() for t in batch.column(0).to_pylist()])
            found, n = np.unique(anchors(words, offsets, length, min(ANCHOR, length)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], names=["anchor", "n"])

    counted = sample.select("text").mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    counted = counted.crossJoin(counted.agg(F.sum("n").alias("all")))  # one row
    rows = counted.where(F.col("n") > F.greatest(F.lit(64), F.col("all") / (2 * n_buckets))).select("anchor").toArrow()
    return np.sort(rows.column("anchor").to_numpy().astype(np.uint32))


def _windows(docs: DataFrame, length: int, n_buckets: int, flush_words: int, dense: np.ndarray) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(dense)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple[int, int]] = []
        texts: list[bytes] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            unique = dict(zip(keys, texts))
            order = sorted(unique)
            names = np.array(order, np.int64).reshape(-1, 2)
            words, offsets = word_hashes([unique[k] for k in order])
            value, document, position = window_hashes(words, offsets, length)
            anchor = anchors(words, offsets, length, min(ANCHOR, length))
            by = np.argsort(value, kind="stable")  # equal windows stay in order of document and position
            first = np.empty(len(by), bool)
            ranked = value[by]
            first[:1] = True
            first[1:] = ranked[1:] != ranked[:-1]
            earliest = np.empty(len(by), bool)
            earliest[by] = first
            go, stop = np.flatnonzero(earliest), np.flatnonzero(~earliest)
            spread = (anchor[go] * np.uint32(0xC2B2AE35)).astype(np.uint64)  # anchors are minima, so mostly small
            held = sent.value
            if len(held):
                near = np.minimum(np.searchsorted(held, anchor[go]), len(held) - 1)
                spread = np.where(held[near] == anchor[go], value[go] >> np.uint64(32), spread)
            bucket = (spread * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int32)
            yield from _scatter(n_buckets, bucket, value[go], names, document[go], position[go])
            if len(stop):
                yield from _scatter(n_buckets, _document_bucket(names, n_buckets)[document[stop]], None, names, document[stop], position[stop])

        for batch in sliced(batches, 2):
            for key, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = (text or "").encode()
                keys.append((key, tag))
                texts.append(raw)
                held += len(raw)
                if held >= flush_words * 6:
                    yield from flush()
                    keys, texts, held = [], [], 0
                    release()
        if keys:
            yield from flush()
        release()

    return _named(bounded(docs)).select("id", "tag", "text").mapInArrow(run, _PACKED)


def _earlier(n_buckets: int):
    """For one range of anchors: marks each window that an earlier document also has; marked rows pass through."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = rows[rows["marked"]].values.tolist()
        parts = [_unpack(r) for r in rows[~rows["marked"]].itertuples(index=False)]
        if parts:
            value = np.concatenate([p[0] for p in parts])
            sizes = np.cumsum([0, *(len(p[1]) for p in parts)])
            names, document = np.unique(np.concatenate([p[1] for p in parts]), axis=0, return_inverse=True)
            document = document.reshape(-1).astype(np.int32)[np.concatenate([p[2] + np.int32(s) for p, s in zip(parts, sizes)])]
            position = np.concatenate([p[3] for p in parts])
            del parts
            by = np.lexsort((document, value))
            ranked = value[by]
            start = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
            least = np.repeat(document[by][start], np.diff(np.r_[start, len(by)]))
            late = by[document[by] != least]
            late = late[np.lexsort((position[late], document[late]))]
            bucket = _document_bucket(names, n_buckets)[document[late]]
            for table in _scatter(n_buckets, bucket, None, names, document[late], position[late]):
                out += zip(*(c.to_pylist() for c in table.columns))
            del value, document, position, by, ranked, least, late
        release()
        return pd.DataFrame(out, columns=_NAMES)

    return run


def _intervals(length: int):
    """For one bucket of documents: the maximal intervals [start, end) of words that marked windows cover."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(r) for r in rows.itertuples(index=False)]
        sizes = np.cumsum([0, *(len(p[1]) for p in parts)])
        names, inverse = np.unique(np.concatenate([p[1] for p in parts]), axis=0, return_inverse=True)
        document = inverse.reshape(-1)[np.concatenate([p[2] + s for p, s in zip(parts, sizes)])]
        position = np.concatenate([p[3] for p in parts])
        by = np.lexsort((position, document))
        document, position = document[by], position[by]
        start = np.flatnonzero(np.r_[True, (document[1:] != document[:-1]) | (position[1:] > position[:-1] + length)])
        end = np.r_[start[1:], len(document)] - 1
        spans = np.stack([position[start], position[end] + length], axis=1).astype(np.int32)
        owner = document[start]
        edge = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        return pd.DataFrame({"id": names[owner[edge], 0], "tag": names[owner[edge], 1], "spans": [s.tobytes() for s in np.split(spans, edge[1:])]})

    return run


def repeated_intervals(docs: DataFrame, length: int = LENGTH, flush_words: int = FLUSH_WORDS, range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """id, tag, spans (pairs of int32 word offsets) of each document with something to remove."""
    total = text_bytes(docs)
    n_buckets = max(shuffle_partitions(docs.sparkSession), -(-total // (6 * range_windows)))
    windows = _windows(docs, length, n_buckets, flush_words, dense_anchors(docs, length, n_buckets, total))
    marked = windows.groupBy("bucket").applyInPandas(_earlier(n_buckets), _PACKED)
    # a row that passes through or leaves a range names the document bucket in its own column
    return marked.groupBy("bucket").applyInPandas(_intervals(length), "id long, tag long, spans binary")


def kept_words(raw: bytes, spans: bytes | None) -> tuple[list[bytes], int]:
    words = raw.split()
    if not spans:
        return words, len(words)
    kept, at = [], 0
    for start, end in np.frombuffer(spans, np.int32).reshape(-1, 2).tolist():
        kept += words[at:start]
        at = end
    return kept + words[at:], len(words)


def remove_repeats(docs: DataFrame, length: int = LENGTH, **sizes) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space) for every row of ``docs``."""
    spans = repeated_intervals(docs, length, **sizes)
    joined = _named(docs).join(spans, ["id", "tag"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            counts, removed, texts = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept, n = kept_words((text or "").encode(), found)
                counts.append(n)
                removed.append(n - len(kept))
                texts.append(b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])
        release()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded(joined).mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_text string")
