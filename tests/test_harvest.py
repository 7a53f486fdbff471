"""Spans, name automata, contests and incremental extraction against plain versions."""

import json
import os
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarryline.functions.spans import outermost, spans_of
from quarryline.operators import harvest
from quarryline.operators.matching import best_only, overlap_pairs
from quarryline.sources.filetable import FileTable

TELLING = harvest.Telling(won=r"\b(?:defeated|beat)\b", lost=r"\b(?:lost to|was (?:defeated|beaten) by)\b")


def test_spans_and_outermost(spark):
    texts = ["so very, very well", "", None, "very", "xx very very", "a so-so so"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    both = F.concat(spans_of(F.col("t"), r"very", "v"), spans_of(F.col("t"), r"\bso\b", "s"), spans_of(F.col("t"), r"very,? very", "vv"))
    got = {r.k: ([tuple(x) for x in r.a], [tuple(x) for x in r.o]) for r in rows.select("k", both.alias("a"), outermost(both).alias("o")).collect()}
    for k, t in enumerate(texts):
        want = [(m.start(), m.end(), name, m.group(0)) for name, p in (("v", r"very"), ("s", r"\bso\b"), ("vv", r"very,? very")) for m in re.finditer(p, t or "")]
        assert sorted(got[k][0]) == sorted(want)
        assert got[k][1] == [s for s in sorted(want) if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in want)]


def test_outermost_equals_brute_force(spark):
    import random

    random.seed(4)
    cases = [[(a := random.randrange(12), a + random.randrange(1, 6), random.choice("ab"), "f") for _ in range(random.randrange(9))] for _ in range(80)]
    rows = spark.createDataFrame(list(enumerate(cases)), "k int, s array<struct<start:int,end:int,kind:string,found:string>>")
    got = {r.k: [tuple(x) for x in r.o] for r in rows.select("k", outermost(F.col("s")).alias("o")).collect()}
    for k, spans in enumerate(cases):
        inside = lambda s, o: o[0] <= s[0] and s[1] <= o[1] and ((o[0], o[1]) != (s[0], s[1]) or o < s)
        assert got[k] == sorted({s for s in spans if not any(inside(s, o) for o in spans)}), spans


def brute_mentions(text, names):
    spans = [(m.start(), m.start() + len(n), k) for n, k in names for m in re.finditer(f"(?={re.escape(n)})", text)]
    spans = [s for s in spans if not (s[0] and text[s[0] - 1].isalnum()) and not text[s[1] : s[1] + 1].isalnum()]
    return sorted(s for s in spans if not any(o[0] <= s[0] and s[1] <= o[1] and o != s for o in spans))


@pytest.mark.parametrize("slice_bytes", [harvest.SLICE_BYTES, 150])
def test_mentions_equal_brute_force(spark, slice_bytes):
    names = [("goku", "1"), ("son goku", "2"), ("vegeta", "3"), ("vegeta jr", "4"), ("go", "5"), ("élan", "6"), ("x-ray", "7")]
    texts = ["son goku beat vegeta", "gokus go", "vegeta jr, vegeta; x-ray élan", "", "goku goku", "sonson goku", "an x-rayed élans"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    got = {r.id: [tuple(s) for s in r.spans] for r in harvest.mentions(rows, spark.createDataFrame(names, "name string, key string"), slice_bytes).collect()}
    assert got == {k: brute_mentions(t, names) for k, t in enumerate(texts)}
    assert harvest.mentions(rows, spark.createDataFrame([], "name string, key string")).where("size(spans) > 0").count() == 0


def test_contests(spark):
    names = spark.createDataFrame([("Goku", "g"), ("Vegeta", "v"), ("Son Goku", "g"), ("Frieza", "f")], "name string, key string")
    said = ["Son Goku defeated Vegeta and Frieza", "Goku was defeated by Frieza", "Frieza lost to Goku", "he beat Vegeta", "Vegeta beat him", "they beat them", "Goku beat Son Goku", "Goku walked", "Son Goku defeated Vegeta and Frieza"]
    rows = spark.createDataFrame([("e", t) for t in said], "entity string, text string")
    found = harvest.contests(rows, names, TELLING)
    assert {tuple(r) for r in harvest.edges(found).collect()} == {("g", "v", 1), ("f", "g", 1), ("g", "f", 1)}
    assert {tuple(r) for r in harvest.sides(found).collect()} == {("resolved", 3), ("no winner", 1), ("no loser", 1), ("neither", 1), ("self", 1)}


def extractor(spark, seen):
    def extract(paths):
        seen.append(sorted(os.path.basename(p) for p in paths))
        docs = spark.read.schema("entity string, feats array<string>").option("multiLine", True).json(paths)
        return docs.select(F.col("_metadata.file_path").alias("file"), "entity", F.explode("feats").alias("text"))

    return extract


def test_only_changed_files_are_read(spark, tmp_path):
    def put(name, *feats, at=None):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(json.dumps({"entity": name, "feats": feats}))
        if at:
            os.utime(tmp_path / "in" / name, (at, at))

    table, seen = FileTable(spark, str(tmp_path / "table")), []
    update = lambda recipe="r1", n=100: table.update(str(tmp_path / "in"), recipe, extractor(spark, seen), n)
    texts = lambda: sorted(r.text for r in table.rows().collect())
    put("a.json", "a1", "a2", at=1_000_000)
    put("b.json", "b1", at=1_000_000)
    assert update() == {"read": 2, "removed": 0} and texts() == ["a1", "a2", "b1"]
    assert update() == {"read": 0, "removed": 0} and len(seen) == 1  # nothing is opened again
    put("b.json", "b2", at=2_000_000)
    put("c.json", "c1", at=1_000_000)
    assert update() == {"read": 2, "removed": 0} and seen[-1] == ["b.json", "c.json"] and texts() == ["a1", "a2", "b2", "c1"]
    os.remove(tmp_path / "in" / "a.json")
    assert update() == {"read": 0, "removed": 1} and texts() == ["b2", "c1"]
    assert update("r2", 1) == {"read": 2, "removed": 0} and texts() == ["b2", "c1"]  # another recipe reads all again, in slices
    before = table.tables.current()
    table.compact()
    assert texts() == ["b2", "c1"] and len(table.tables.current().paths["rows"]) == 1 < len(before.paths["rows"])
    os.rename(tmp_path / "in", tmp_path / "away")
    with pytest.raises(Exception):  # noqa: B017  a source that cannot be listed
        update("r2")
    assert texts() == ["b2", "c1"]


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="ab c", max_size=30))
def test_automaton_finds_all(text):
    found = harvest._automaton([("ab", "1"), ("b c", "2"), ("a", "3")])
    got = sorted((e + 1 - n, e + 1, k) for e, (n, k) in found.iter(text)) if text else []
    assert got == sorted((m.start(), m.start() + len(n), k) for n, k in (("ab", "1"), ("b c", "2"), ("a", "3")) for m in re.finditer(f"(?={re.escape(n)})", text))


def test_overlap_pairs_equal_brute_force(spark):
    import random

    random.seed(9)
    vocabulary = [f"w{k}" for k in range(12)]
    sets = lambda n: [(k, [random.choice(vocabulary) for _ in range(random.randrange(9))]) for k in range(n)]
    left, right = [*sets(60), (999, [])], [*sets(60), (888, ["zz"])]
    frame = lambda rows, c: spark.createDataFrame(rows, f"{c} long, tokens array<string>")
    for least in (0.5, 0.8, 1.0):
        got = {(r.a, r.b): round(r.score, 9) for r in overlap_pairs(frame(left, "a"), frame(right, "b"), least).collect()}
        want = {}
        for a, x in left:
            for b, y in right:
                x_, y_ = set(x), set(y)
                if x_ and y_ and len(x_ & y_) / min(len(x_), len(y_)) >= least - 1e-9:
                    want[a, b] = round(len(x_ & y_) / min(len(x_), len(y_)), 9)
        assert got == want
    pairs = spark.createDataFrame([(1, 5, 0.9), (1, 6, 0.9), (2, 5, 0.8), (2, 6, 0.9), (3, 7, 1.0)], "a long, b long, score double")
    assert sorted(tuple(r) for r in best_only(pairs, "a", "b", "score").collect()) == [(2, 6, 0.9), (3, 7, 1.0)]


def test_entity_is_found_in_time_in_proportion_to_the_text(spark):
    import random
    import time

    from quarryline.functions.spans import after_first_sentence

    random.seed(11)
    texts = ["".join(random.choice(["Bob", "Al", "New", "York", "mcDon", "x", ".", "!", "? ", ". ", " ", "  ", "\n", "-"]) for _ in range(random.randrange(2, 30))) for _ in range(600)]
    for name in (r"[A-Z][a-z]{2,}", r"[A-Z][a-z]{2,}(?:[ -][A-Z][a-z]{2,})*"):
        plain = [m.group(1) if (m := re.search(rf"[^.!?]*[.!?]\s+(?:[^.!?]*\b)?({name})", t)) else "" for t in texts]
        rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", F.regexp_extract("t", after_first_sentence(name), 1).alias("n")).collect()
        assert {r.k: r.n for r in rows} == dict(enumerate(plain)) and len(set(plain)) > 3
    start = time.perf_counter()
    long = spark.createDataFrame([("lower words " * 60_000 + ". and no name",)], "t string").select(F.regexp_extract("t", after_first_sentence("[A-Z][a-z]{2,}"), 1).alias("n")).first()
    assert long.n == "" and time.perf_counter() - start < 20


def test_outermost_rows_equal_column_expressions(spark):
    import time

    from quarryline.functions.spans import outermost_rows

    told = [("v", r"very"), ("s", r"\bso\b"), ("vv", r"very,? very"), ("w", r"[a-z]+ry")]
    texts = ["so very, very well", "", None, "very", "xx very very", "a so-so so", "every so very, very fury"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    want = rows.select("k", F.explode(outermost(F.concat(*[spans_of(F.col("t"), p, n) for n, p in told]))).alias("s")).select("k", "s.kind", "s.start", "s.end").collect()
    assert sorted(map(tuple, outermost_rows(rows, "k", "t", told).collect())) == sorted(map(tuple, want))
    start = time.perf_counter()
    long = spark.createDataFrame([(1, "so very " * 60_000)], "k int, t string")
    assert outermost_rows(long, "k", "t", told).count() == 120_000 and time.perf_counter() - start < 20  # grown one by one, an array of them took minutes
