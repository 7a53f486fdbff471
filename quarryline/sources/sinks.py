"""Sinks with a check: compare-and-swap tables, append logs, verified snapshots, content-addressed blobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Changed(RuntimeError):
    """The target is not what the writer read."""


def digest(df: DataFrame) -> str:
    """Order-free digest of a table: number of rows and two sums of row hashes."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    two = [F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)]
    row = df.agg(F.count(F.lit(1)), *[F.sum(h.cast("decimal(38,0)")) for h in two]).first()
    return "-".join(str(v or 0) for v in row)


def _current(spark: SparkSession, folder: str) -> str | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_versions")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(path))
    return names[-1] if names else None


def read_current(spark: SparkSession, folder: str) -> DataFrame | None:
    """The table's current version, or None."""
    name = _current(spark, folder)
    return None if name is None else spark.read.parquet(f"{folder}/_versions/{name}")


def replace_if_unchanged(df: DataFrame, folder: str, expected: str | None) -> str:
    """Writes a new version if the current one still has the digest that the caller read (None: no version yet).

    The new version is written beside the old and then renamed; readers see one or the other. Returns its digest.
    """
    spark = df.sparkSession
    now = read_current(spark, folder)
    if (None if now is None else digest(now)) != expected:
        raise Changed(folder)
    number = 0 if now is None else int(_current(spark, folder)) + 1
    staged = f"{folder}/_staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jvm.Path(f"{folder}/_versions"))
    target = jvm.Path(f"{folder}/_versions/{number:012d}")
    if fs.exists(target) or not fs.rename(jvm.Path(staged), target):
        fs.delete(jvm.Path(staged), True)
        raise Changed(folder)
    return digest(spark.read.parquet(str(target)))


def append_lines(df: DataFrame, folder: str) -> None:
    """Appends rows as JSON lines."""
    df.write.mode("append").json(folder)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify(before: DataFrame, after: DataFrame) -> DataFrame:
    """path, state (missing, added, changed) of what differs between two manifests."""
    a, b = before.select("path", F.col("sha256").alias("x")), after.select("path", F.col("sha256").alias("y"))
    state = F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "added").otherwise("changed")
    return a.join(b, "path", "full_outer").where(~F.col("x").eqNullSafe(F.col("y"))).select("path", state.alias("state"))


def store_blobs(texts: DataFrame, column: str, folder: str) -> DataFrame:
    """Content-addressed store: key (first 32 hex digits of the digest), text; equal texts are stored once. Returns the keys."""
    keyed = texts.select(F.left(F.sha2(F.col(column), 256), F.lit(32)).alias("key"), F.col(column).alias("text")).where("text is not null")
    keyed.dropDuplicates(["key"]).write.mode("append").option("compression", "zstd").parquet(folder)
    return keyed.select("key")


def broken_blobs(spark: SparkSession, folder: str) -> DataFrame:
    """Stored blobs whose content is not that of their key."""
    return spark.read.parquet(folder).where(F.left(F.sha2("text", 256), F.lit(32)) != F.col("key")).select("key")
