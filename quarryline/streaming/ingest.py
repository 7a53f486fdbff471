"""Incremental ingest: new files of a folder become deltas of a table that is merged by key when it is read.

Deltas are folders by batch. Compaction puts what they hold into the base table in one commit that also notes
the last batch it took in; deltas up to that batch no longer count and are removed, so what a read costs depends on the
table and on the batches since. Files that vanish are buried: their rows, up to the batch of the burial, no longer
count, and a key falls back to what another file says of it; the next compaction drops them for good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.sources.tableset import Commit, TableSet

_BATCH, _FILE = "_batch", "_file"


def _latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key: that of the largest ``order``, ties by the later batch, then by the row itself; added up map-side."""
    row = F.struct(*[F.col(c) for c in rows.columns])
    best = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(row, F.struct(F.col(order), F.col(_BATCH), row)).alias("r"))
    return best.select("r.*")


def merge_batch(folder: str, keys: list[str], order: str):
    """A ``foreachBatch`` function that writes only the batch's own latest rows of each file, as the delta of its number.

    A batch that Spark repeats after a failure overwrites its own delta, so it changes nothing.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        named = batch if _FILE in batch.columns else batch.withColumn(_FILE, F.lit(None).cast("string"))
        rows = _latest(named.withColumn(_BATCH, F.lit(batch_id).cast("long")), [*keys, _FILE], order)
        rows.drop(_BATCH).write.mode("overwrite").parquet(f"{folder}/_deltas/{_BATCH}={batch_id}")

    return merge


def _batches(spark: SparkSession, folder: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_deltas")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.split("=")[1]) for n in found if n.startswith(f"{_BATCH}="))


def _rows(spark: SparkSession, folder: str, tables: TableSet, now: Commit) -> DataFrame | None:
    """All rows that count: the base, the deltas since, and of neither what is buried."""
    rows = tables.read("base", now)
    since = [b for b in _batches(spark, folder) if b > now.notes.get("through", -1)]
    if since:
        read = spark.read.option("basePath", f"{folder}/_deltas").parquet(*[f"{folder}/_deltas/{_BATCH}={b}" for b in since])
        deltas = read.withColumn(_BATCH, F.col(_BATCH).cast("long"))
        rows = deltas if rows is None else rows.unionByName(deltas)
    buried = tables.read("buried", now)
    if rows is None or buried is None:
        return rows
    upto = buried.groupBy(F.col("file").alias("_gone")).agg(F.max("through").alias("_upto"))
    return rows.join(upto, (F.col(_FILE) == F.col("_gone")) & (F.col(_BATCH) <= F.col("_upto")), "left_anti")


def latest(spark: SparkSession, folder: str, keys: list[str], order: str) -> DataFrame | None:
    """The table as of now, one row a key."""
    tables = TableSet(spark, folder)
    rows = _rows(spark, folder, tables, tables.current())
    return None if rows is None else _latest(rows, keys, order).drop(_BATCH, _FILE)


def compact(spark: SparkSession, folder: str, keys: list[str], order: str) -> None:
    """Takes all deltas into the base, drops what is buried, and removes the deltas, unless somebody else committed meanwhile.

    The base keeps a key's latest row of each file, so that a later burial can fall back on another file.
    """
    tables = TableSet(spark, folder)
    now, held = tables.current(), _batches(spark, folder)
    rows = _rows(spark, folder, tables, now)
    if rows is None:
        return
    through = max([now.notes.get("through", -1), *held])
    tables.commit({"base": _latest(rows, [*keys, _FILE], order), "buried": spark.createDataFrame([], "file string, through long")}, now, notes={"through": through})
    path = spark._jvm.org.apache.hadoop.fs.Path
    for b in held:
        if b <= through:
            path(f"{folder}/_deltas").getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(f"{folder}/_deltas/{_BATCH}={b}"), True)
    tables.vacuum()


def bury(spark: SparkSession, folder: str, source: str) -> int:
    """Buries the files of the table that ``source`` no longer lists; returns their number. A source that cannot be listed raises."""
    tables = TableSet(spark, folder)
    now = tables.current()
    rows = _rows(spark, folder, tables, now)
    if rows is None:
        return 0
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).select(F.col("path").alias("file"))
    gone = rows.select(F.col(_FILE).alias("file")).where("file is not null").distinct().join(listed, "file", "left_anti")
    n = gone.count()
    if n:
        through = max([now.notes.get("through", -1), *_batches(spark, folder)])
        tables.commit({"buried": gone.withColumn("through", F.lit(through).cast("long"))}, now, append=("buried",))
    return n


def ingest(spark: SparkSession, source: str, schema: str, folder: str, checkpoint: str, keys: list[str], order: str, files_a_batch: int = 1000):
    """Starts the query over what has arrived so far and returns it; the checkpoint remembers the files seen."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).json(source)
    stream = stream.withColumn(_FILE, F.col("_metadata.file_path"))
    return stream.writeStream.foreachBatch(merge_batch(folder, keys, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
