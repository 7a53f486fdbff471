"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators.snapshots import snapshot


try:  # glibc only
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim
except (OSError, AttributeError):
    _libc = None

#: Bytes of an Arrow batch on its way to Python, where the session leaves Spark's default.
BATCH_BYTES = 4 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """``df``, after its session's Arrow batches are bounded: whole texts at 64 MB a batch would hold several times that in each task."""
    spark = df.sparkSession
    if spark.conf.get(_BATCHES) == "67108864b":
        spark.conf.set(_BATCHES, str(BATCH_BYTES))
    return df


def cut(df: DataFrame, name: str) -> DataFrame:
    """A snapshot of ``df`` in the shared folder."""
    return snapshot(df, name)


def sliced(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of about ``size`` text bytes (one row at least), without copying.

    Python objects and results then exist for a slice at a time, whatever Spark's batch size is.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        step = np.cumsum(lengths + 64) // size
        edge = np.flatnonzero(np.r_[True, step[1:] != step[:-1]]) if len(step) else np.zeros(0, np.int64)
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(step)]):
            yield batch.slice(a, b - a)


def release() -> None:
    """Gives freed memory back to the system: workers are used again by later stages, and would keep it until then."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column over all rows."""
    return docs.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0
