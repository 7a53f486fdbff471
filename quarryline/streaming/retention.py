"""Histories that keep a span of time and a number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.sources.tableset import TableSet


def retained(rows: DataFrame, at: str, hours: int, most: int, tie: str) -> DataFrame:
    """The rows of the last ``hours`` before the newest one, the newest ``most`` of them; ties go to the larger ``tie``."""
    now = rows.agg(F.max(at).alias("_now"))
    recent = rows.crossJoin(now).where(F.col(at) > F.col("_now") - F.expr(f"interval {hours} hours")).drop("_now")  # now is one row
    return recent.orderBy(F.desc(at), F.desc(tie)).limit(most)


class History:
    """A stream's history table in a folder: each batch is merged and evicted in one commit, which also notes the batch.

    Used with ``writeStream.foreachBatch(History(...).merge)``. The table is in the folder, not in this object, so a
    query that stops and starts again goes on with it; a batch that Spark repeats after a failure changes nothing. The table is
    never larger than ``most`` rows, and only the last two states of it are kept.
    """

    def __init__(self, folder: str, at: str, tie: str, hours: int = 24, most: int = 2000) -> None:
        self.folder, self.at, self.tie, self.hours, self.most = folder, at, tie, hours, most

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        tables = TableSet(batch.sparkSession, self.folder)
        now = tables.current()
        if now.notes.get("batch", -1) >= batch_id:
            return
        held = tables.read("history", now)
        rows = batch if held is None else held.unionByName(batch)
        kept = retained(rows.dropDuplicates([self.tie]), self.at, self.hours, self.most, self.tie)
        tables.commit({"history": kept}, now, notes={"batch": batch_id})
        tables.vacuum()

    def table(self, spark: SparkSession) -> DataFrame | None:
        return TableSet(spark, self.folder).read("history")
