"""A table extracted from files, brought up to date by reading only the files that changed.

State is one row a file: when it was modified, its length, and which generation of rows it has. An update lists
the files, reads the new and changed ones in slices, and forgets those that are gone; each slice is one commit of both tables,
so a run that dies is continued by the next. Rows of older generations are dead the moment the file's row names another.
The state also has the digest of the recipe: under another recipe every file is read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators.snapshots import snapshot
from quarryline.sources.tableset import Commit, TableSet

_FILES = "file string, modified timestamp, length long, home string"
#: Files that one slice reads; their paths pass through the driver.
SLICE_FILES = 10_000


class FileTable:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.tables = spark, TableSet(spark, folder)

    def _files(self, commit: Commit) -> DataFrame:
        files = self.tables.read("files", commit)
        return self.spark.createDataFrame([], _FILES) if files is None else files

    def rows(self) -> DataFrame | None:
        """The rows of all known files, with ``file``."""
        now = self.tables.current()
        rows = self.tables.read("rows", now)
        return None if rows is None else rows.join(self._files(now).select("file", "home"), ["file", "home"], "left_semi").drop("home")

    def update(self, source: str, recipe: str, extract: Callable[[list[str]], DataFrame], slice_files: int = SLICE_FILES) -> dict[str, int]:
        """``extract`` gives the rows of some files, with a column ``file`` (the path as Spark lists it). Returns files read and removed.

        A source that cannot be listed raises, and what is known of it stays as it is.
        """
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
        listed = snapshot(found.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"), "length"), "listed")
        now = self.tables.current()
        known = self._files(now) if now.notes.get("recipe") == recipe else self.spark.createDataFrame([], _FILES)
        changed = snapshot(listed.join(known, ["file", "modified", "length"], "left_anti"), "changed")
        kept = known.join(listed, ["file", "modified", "length"], "left_semi")
        removed = self._files(now).join(listed, "file", "left_anti").count()
        n = changed.count()
        slices = -(-n // slice_files)
        if not slices and (removed or now.notes.get("recipe") != recipe):
            self.tables.commit({"files": kept}, now, notes={"recipe": recipe})
        for k in range(slices):
            part = changed.where(F.pmod(F.xxhash64("file"), F.lit(slices)) == k)
            paths = [r.file for r in part.select("file").collect()]  # about slice_files of them
            if not paths:
                continue
            home = uuid.uuid4().hex
            kept = snapshot(kept.select("file", "modified", "length", "home").unionByName(part.withColumn("home", F.lit(home))), "files")
            rows = extract(paths).withColumn("home", F.lit(home))
            now = self.tables.commit({"files": kept, "rows": rows}, now, append=("rows",), notes={"recipe": recipe})
        return {"read": n, "removed": removed}

    def compact(self) -> None:
        """Writes the live rows alone, so that reading no longer depends on how many updates there were."""
        now = self.tables.current()
        rows = self.tables.read("rows", now)
        if rows is not None:
            self.tables.commit({"rows": rows.join(self._files(now).select("file", "home"), ["file", "home"], "left_semi")}, now)
            self.tables.vacuum()
