"""Several tables that change in one commit.

A commit writes its tables beside the old ones and then creates one pointer, a small numbered file that
names every table's paths. Readers follow the newest whole pointer, so they see all tables of one commit or
all of the one before; a writer that dies in between leaves files that no pointer names. A pointer's number can be
taken once, so of two writers that started from the same commit the second is refused.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators.snapshots import snapshot
from quarryline.sources.sinks import Changed

#: Seconds after which a pointer that is still unfinished is nobody's; writing one takes milliseconds.
STALE_S = 3600


@dataclass(frozen=True)
class Commit:
    """One state of the set: its number (-1: none yet), the paths of each table, the schemas, and what the writer noted."""

    number: int = -1
    paths: dict[str, list[str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


class TableSet:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.folder}/_pointers")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted((int(n) for n in names if n.isdigit()), reverse=True)

    def current(self) -> Commit:
        """The newest whole commit; a pointer whose writer died while writing it counts as none."""
        return next((c for c in map(self._load, self._numbers()) if c), Commit())

    def _load(self, number: int) -> Commit | None:
        text = self.spark.read.option("wholetext", True).text(f"{self.folder}/_pointers/{number:012d}").first()
        try:
            return Commit(number, **json.loads(text.value))
        except (json.JSONDecodeError, AttributeError):
            return None

    def read(self, table: str, commit: Commit | None = None) -> DataFrame | None:
        """A table as of a commit (by default the newest); None where there is no such table."""
        commit = commit or self.current()
        if table not in commit.schemas:
            return None
        paths = commit.paths[table]
        reader = self.spark.read.schema(commit.schemas[table])
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], commit.schemas[table])

    def commit(self, tables: dict[str, DataFrame], since: Commit | None = None, append: tuple[str, ...] = (), notes: dict | None = None) -> Commit:
        """Puts the tables into the set (those in ``append`` beside what they have) if nobody has committed ``since``; the others stay.

        Returns the new commit. A refused writer's files are removed.
        """
        base = since if since is not None else self.current()
        home = f"{self.folder}/_sets/{uuid.uuid4().hex}"
        paths, schemas = dict(base.paths), dict(base.schemas)
        for name, df in tables.items():
            df.write.parquet(f"{home}/{name}")
            paths[name] = [*(base.paths.get(name, []) if name in append else []), f"{home}/{name}"]
            schemas[name] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        number = max(self._numbers(), default=-1) + 1
        if self._taken_since(base) or not self._point(number, {"paths": paths, "schemas": schemas, "notes": base.notes | (notes or {})}):
            self._fs.delete(self._path(home), True)
            raise Changed(self.folder)
        return Commit(number, paths, schemas, base.notes | (notes or {}))

    def _taken_since(self, base: Commit) -> bool:
        """Whether anybody has, or is about to have, a later commit; a pointer that stayed unfinished for ``STALE_S`` has no living writer."""
        for number in (n for n in self._numbers() if n > base.number):
            age = time.time() - self._fs.getFileStatus(self._path(f"{self.folder}/_pointers/{number:012d}")).getModificationTime() / 1000
            if age < STALE_S or self._load(number):
                return True
        return False

    def _point(self, number: int, content: dict) -> bool:
        """Creates the pointer; False if its number is taken."""
        try:
            out = self._fs.create(self._path(f"{self.folder}/_pointers/{number:012d}"), False)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                return False
            raise
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        return True

    def vacuum(self, keep: int = 2) -> int:
        """Removes the files that the newest ``keep`` commits do not name, and older pointers; returns how many folders went."""
        kept = [c for c in (self._load(n) for n in self._numbers()) if c][:keep]
        named = {p for c in kept for paths in c.paths.values() for p in paths}
        for number in self._numbers():
            if kept and number < kept[-1].number:
                self._fs.delete(self._path(f"{self.folder}/_pointers/{number:012d}"), False)
        gone, sets = 0, self._path(f"{self.folder}/_sets")
        for home in self._fs.listStatus(sets) if self._fs.exists(sets) else []:
            for table in self._fs.listStatus(home.getPath()):
                if not any(table.getPath().toString().endswith(p.split("/_sets/")[1]) for p in named):
                    self._fs.delete(table.getPath(), True)
                    gone += 1
        return gone


class Shrunk(RuntimeError):
    """A replacement that would lose too much of what is there."""


def replace_guarded(tables: TableSet, name: str, df: DataFrame, by: str, floor: float = 0.5) -> Commit:
    """Replaces a table unless a category (``by``) would keep less than ``floor`` of its rows, or somebody else committed meanwhile.

    The check and the commit start from one state, so that a writer cannot pass the check against a table that another
    has replaced. An empty replacement of a table with rows is refused like any other loss.
    """
    now = tables.current()
    new = snapshot(df, name)
    held = tables.read(name, now)
    if held is not None:
        counts = lambda rows, c: rows.groupBy(F.col(by).alias("_by")).agg(F.count(F.lit(1)).alias(c))
        old, left = counts(held, "old"), counts(new, "new").withColumnRenamed("_by", "_new")
        lost = old.join(left, F.col("_by").eqNullSafe(F.col("_new")), "left").where(F.coalesce("new", F.lit(0)) < floor * F.col("old"))
        worst = lost.orderBy(F.desc("old")).limit(5).collect()
        if worst:
            raise Shrunk("; ".join(f"{r['_by']}: {r['new'] or 0} of {r['old']}" for r in worst))
    return tables.commit({name: new}, now)
