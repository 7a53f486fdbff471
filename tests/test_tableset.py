"""Several tables in one commit: crashes, races, and what readers see."""

import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import DataFrameWriter

from quarryline.sources import records, tableset
from quarryline.sources.sinks import Changed
from quarryline.sources.tableset import Shrunk, TableSet, replace_guarded


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def held(tables, name, commit=None):
    df = tables.read(name, commit)
    return None if df is None else sorted(r.v for r in df.collect())


def test_commits_carry_and_append(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    assert tables.current().number == -1 and tables.read("a") is None
    first = tables.commit({"a": rows(spark, 1), "b": rows(spark)}, notes={"through": 4})
    second = tables.commit({"a": rows(spark, 2)}, append=("a",))
    assert held(tables, "a") == [1, 2] and held(tables, "b") == [] and tables.current().notes == {"through": 4}
    assert held(tables, "a", first) == [1]  # a reader of the first commit still has it
    third = tables.commit({"a": rows(spark, 9)}, since=second)
    assert held(tables, "a") == [9] and third.number == 2
    assert tables.vacuum(keep=1) == 2 and held(tables, "a") == [9] and held(tables, "b") == []


def test_a_writer_that_dies_between_tables_changes_nothing(spark, tmp_path, monkeypatch):
    tables = TableSet(spark, str(tmp_path))
    tables.commit({"a": rows(spark, 1), "b": rows(spark, 1), "c": rows(spark, 1)})
    written, write = [], DataFrameWriter.parquet

    def dies(self, path, *args, **kwargs):
        if len(written) == 2:
            raise OSError("killed")
        written.append(path)
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", dies)
    with pytest.raises(OSError):
        tables.commit({"a": rows(spark, 2), "b": rows(spark, 2), "c": rows(spark, 2)})
    monkeypatch.undo()
    assert [held(tables, t) for t in "abc"] == [[1], [1], [1]] and len(written) == 2
    assert tables.vacuum() == 2  # what it left behind
    assert [held(tables, t) for t in "abc"] == [[1], [1], [1]]


def test_one_of_two_writers_is_refused(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    base = tables.commit({"a": rows(spark, 1)})
    tables.commit({"a": rows(spark, 2)}, since=base)
    with pytest.raises(Changed):
        tables.commit({"a": rows(spark, 3)}, since=base)
    assert held(tables, "a") == [2] and tables.vacuum(keep=2) == 0  # the refused files are gone already


def test_an_unfinished_pointer(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    base = tables.commit({"a": rows(spark, 1)})
    pointer = tmp_path / "_pointers" / f"{1:012d}"
    pointer.write_text(json.dumps({"paths": {}})[:5])
    assert tables.current() == base and held(tables, "a") == [1]
    with pytest.raises(Changed):  # its writer may still live
        tables.commit({"a": rows(spark, 2)}, since=base)
    old = time.time() - tableset.STALE_S - 60
    os.utime(pointer, (old, old))
    assert tables.commit({"a": rows(spark, 2)}, since=base).number == 2 and held(tables, "a") == [2]


def test_rebuild_is_one_commit(spark, tmp_path, monkeypatch):
    record = lambda name, source, n: (tmp_path / "records" / name).write_text(json.dumps({"source": source, "entries": [{"name": f"e{k}"} for k in range(n)]}))
    (tmp_path / "records").mkdir()
    record("a.json", "A", 2)
    folder = str(tmp_path / "out")
    assert records.rebuild(spark, str(tmp_path / "records"), [], folder) == {"source": 1, "entry": 2, "evidence": 0, "meta": 0}
    record("b.json", "B", 3)
    write, written = DataFrameWriter.parquet, []

    def dies(self, path, *args, **kwargs):
        if written:
            raise OSError("killed")
        written.append(path)
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", dies)
    with pytest.raises(OSError):
        records.rebuild(spark, str(tmp_path / "records"), [], folder)
    monkeypatch.undo()
    tables = TableSet(spark, folder)
    assert {r.source for r in tables.read("source").collect()} == {"A"} and tables.read("entry").count() == 2  # the new source table is there, and nobody sees it
    assert records.rebuild(spark, str(tmp_path / "records"), [], folder)["entry"] == 5
    assert {r.source for r in tables.read("source").collect()} == {"A", "B"}


def test_a_replacement_must_not_shrink_a_category(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    frame = lambda **n: spark.createDataFrame([(c if c != "none" else None, k) for c, m in n.items() for k in range(m)], "c string, v long")
    sizes = lambda: {r.c: r.n for r in tables.read("t").groupBy("c").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    replace_guarded(tables, "t", frame(a=10, b=4, none=2), "c")
    with pytest.raises(Shrunk, match="b: 1 of 4"):
        replace_guarded(tables, "t", frame(a=50, b=1, none=2), "c")
    with pytest.raises(Shrunk, match="None: 0 of 2"):
        replace_guarded(tables, "t", frame(a=50, b=4), "c")
    with pytest.raises(Shrunk):
        replace_guarded(tables, "t", frame(), "c")
    assert sizes() == {"a": 10, "b": 4, None: 2}
    replace_guarded(tables, "t", frame(a=5, b=4, none=1, d=1), "c")
    assert sizes() == {"a": 5, "b": 4, None: 1, "d": 1}


def test_concurrent_writers(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    replace_guarded(tables, "t", rows(spark, 1, 1), "v")

    def write(k):
        try:
            replace_guarded(TableSet(spark, str(tmp_path)), "t", rows(spark, 1, 1, *range(10 * k, 10 * k + 5)), "v")
            return k
        except Changed:
            return None

    with ThreadPoolExecutor(4) as pool:
        won = [k for k in pool.map(write, range(1, 5)) if k]
    # each that was not refused committed on top of what it had read: the table is the last one's, and no two took one number
    numbers = sorted(int(f.name) for f in (tmp_path / "_pointers").iterdir() if f.name.isdigit())
    assert won and numbers == list(range(len(won) + 1))
    assert held(tables, "t")[2:] in [list(range(10 * k, 10 * k + 5)) for k in won]
