"""The reference operators: parity with SQL, must-reject cases, sources, sinks and streams."""

import json
import math
import re
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from quarryline.functions import gates, numeric
from quarryline.functions import text as T
from quarryline.operators import graph, joins, matching, stats
from quarryline.operators import windows as W
from quarryline.plans import base, registry
from quarryline.sources import markup, records, sinks
from quarryline.streaming.windows import stalls, windowed_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in base.TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _rows(table, columns):
    def one(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        if isinstance(v, float):
            return f"{v:.8g}"
        if isinstance(v, datetime):
            return v.replace(tzinfo=None).isoformat()
        return str(v)

    return sorted(tuple(one(r[c]) for c in sorted(columns)) for r in table)


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_parity(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    expected = duck.sql(registry.oracles()[name]).arrow().read_all() if hasattr(duck.sql("select 1").arrow(), "read_all") else duck.sql(registry.oracles()[name]).arrow()
    assert sorted(got.columns) == sorted(expected.column_names)
    assert _rows([r.asDict() for r in got.collect()], got.columns) == _rows(expected.to_pylist(), got.columns)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracles())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).collect() is not None


def values(spark, rows, expression):
    return [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k int, x string").orderBy("k").select(expression).collect()]


def test_evidence_gate(spark):
    cases = {
        "He destroyed two planets": None,
        "It was destroyed on a planet": "passive",
        "planets consumed by it": "passive",
        "They call it rumoured to have razed a city": "reputation",
        "3d6 damage and a razed city": "mechanics",
        "It weighs 40 tons": None,
        "Nothing happened here": "no deed",
        "tiny": "short",
        "destroyed " + "x" * 80 + " planet": "no deed",
        "a planet that he destroyed": None,
    }
    assert values(spark, list(cases), gates.evidence_reason(F.col("x"))) == list(cases.values())


def slow_well_formed(n):
    v = "aeiouy"
    ok = 4 <= len(n) <= 11 and sum(c in v for c in n) >= 2
    ok &= all(sum(n[j : j + 3] == n[i : i + 3] for j in range(len(n) - 2)) == 1 for i in range(len(n) - 2))
    ok &= all(n[i : i + 2] != n[i + 2 : i + 4] for i in range(len(n) - 3))
    runs = re.findall(f"[{v}]+|[^{v}]+", n)
    return ok and all(len(r) < 3 for r in runs) and all(n.count(c) <= 2 for c in set(n) - set(v))


def test_well_formed(spark):
    names = ["amastes", "khakak", "shessasha", "goggoktok", "zgra", "aeeinna", "zgournazhun", "ab", "valeornus", "banana", "ananas", "toto", "aaab", "kalelalo", "shiashiathasha"]
    assert values(spark, names, gates.well_formed(F.col("x"))) == [bool(slow_well_formed(n)) for n in names]


def test_text_functions(spark):
    assert values(spark, ["Thór (Earth-616)", "A-B c"], T.name_key("x")) == ["thor", "abc"]
    assert values(spark, ["night", "aaaa", ""], T.dice(F.col("x"), F.lit("nacht"))) == [0.25, 0.0, 0.0]
    assert values(spark, ["aaaa"], T.dice(F.col("x"), F.lit("aaa"))) == [0.8]
    assert values(spark, ["abab", "", None], T.entropy("x")) == [1.0, None, None]
    assert values(spark, ["One. Two!\nThree  "], T.sentences("x")) == [["One.", "Two!", "Three"]]
    assert values(spark, ["cities", "boxes", "glass", "cats", "bus"], T.singular("x")) == ["city", "box", "glass", "cat", "bus"]
    assert values(spark, ["<p>a &amp; b</p><script>x()</script>"], T.html_text("x")) == ["a & b"]
    assert values(spark, ["m10", " M3 ", "M11", None], gates.clean_band(F.col("x"))) == ["M10", "M3", "unassayed", "unassayed"]
    assert values(spark, ["set", "kingdom", None], gates.promoted(F.col("x"), F.lit(500))) == ["set", "series", "series"]


def test_numbers(spark):
    row = spark.range(1).select(
        gates.axis_score(F.lit(1e99), F.lit("M10"), "ruin"), gates.axis_score(F.lit(1.0), F.lit("M10"), "ruin"), gates.axis_score(F.lit(-1.0), F.lit("M3"), "ruin"),
        gates.axis_score(F.lit(1e4), F.lit("M0"), "ruin"), numeric.band(F.lit(5.0), [1.0, 5.0, 9.0]), numeric.pack_bits([(F.lit(300), 8)]), numeric.nearest_rank(F.array(*map(F.lit, range(100))), 0.95),
    ).first()
    assert tuple(row) == (9.9, 0.0, None, 4.0, 1, None, 95)


def test_cascade_refuses_ties(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    rows = spark.createDataFrame([("a", "X"), ("b", "X"), ("b", "Y")], "k string, code string")
    got = joins.cascade(left, [("exact", rows), ("later", spark.createDataFrame([("b", "Z")], "k string, code string"))], "k", "code", "UNASSIGNED")
    assert sorted(map(tuple, got.collect())) == [("a", "X", "exact"), ("b", "UNASSIGNED", "tie"), ("c", "UNASSIGNED", "none")]


def test_three_way_merge(spark):
    frame = lambda *rows: spark.createDataFrame(rows, "k int, v string")
    base_, ours, theirs = frame((1, "a"), (2, "a"), (3, "a"), (4, "a"), (5, "a")), frame((1, "b"), (2, "a"), (3, "b"), (5, "a"), (6, "n")), frame((1, "a"), (2, "c"), (3, "c"), (4, "a"), (7, "m"))
    got = {r.k: (r.v, r.conflict) for r in joins.three_way_merge(base_, ours, theirs, ["k"], ["v"]).collect()}
    assert got == {1: ("b", False), 2: ("c", False), 3: ("b", True), 6: ("n", False), 7: ("m", False)}


def test_overlaps_brute(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.randrange(3), k, s := rng.randrange(100), s + rng.randrange(30)) for k in range(80)]
    got = {(r.g, r.a, r.b) for r in joins.overlaps(spark.createDataFrame(rows, "g int, id int, s long, e long"), "g", "id", "s", "e", 7).collect()}
    assert got == {(g, a, b) for g, a, s, e in rows for h, b, u, v in rows if g == h and a < b and s <= v and u <= e}


def test_graph(spark):
    edges = spark.createDataFrame([("a", "b", 5.0), ("b", "c", 5.0), ("a", "c", 1.0), ("d", "e", 4.0), ("e", "d", 2.0), ("x", "y", 0.5)], "a string, b string, w double")
    assert {r.node: r.component for r in graph.components(edges, 1).collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"}
    assert {r.node: r.cluster for r in graph.complete_linkage(edges, 1.5).collect()} == {"a": "a", "b": "a", "c": "c", "d": "d", "e": "d"}
    d = {r.node: r.distance for r in graph.distances(edges, spark.createDataFrame([("a",)], "node string")).collect()}
    assert d == pytest.approx({"a": 0.0, "b": 0.2, "c": 0.4})
    with pytest.raises(ValueError):
        graph.complete_linkage(edges, 0)


def test_bradley_terry(spark):
    contests = spark.createDataFrame([("a", "b", 6), ("b", "a", 2), ("b", "c", 6), ("c", "b", 2), ("a", "c", 9), ("c", "a", 1)], "winner string, loser string, n long")
    got = {r.player: r.strength for r in stats.bradley_terry(contests).collect()}
    assert got["a"] - got["b"] == pytest.approx(math.log(3), abs=0.1) and abs(sum(got.values())) < 1e-6
    with pytest.raises(ValueError):
        stats.bradley_terry(contests.where("winner <> 'c'"))


def test_gradient_share(spark):
    flow = lambda *rows: stats.gradient_share(spark.createDataFrame(rows, "a string, b string, y double")).first().eta
    assert flow(("a", "b", 1.0), ("b", "c", 1.0), ("a", "c", 2.0)) == pytest.approx(1.0)
    assert flow(("a", "b", 1.0), ("b", "c", 1.0), ("c", "a", 1.0)) == pytest.approx(0.0, abs=1e-6)


def test_matching(spark):
    frame = lambda *rows: spark.createDataFrame([(r,) for r in rows], "name string")
    got = {(r.name, r.match): r.reason for r in matching.candidates(frame("Spiderman 2", "Thor (Earth-616)"), frame("Spider-Man 2", "Spiderman 3", "Thor (Earth-1610)", "Thor")).collect()}
    assert got == {("Spiderman 2", "Spider-Man 2"): "equal", ("Thor (Earth-616)", "Thor"): "equal"}


def test_pack_budget(spark):
    rows = spark.createDataFrame([("g", k, n) for k, n in enumerate([5, 5, 3, 20, 4, 6, 1])], "g string, k int, n long")
    got = [r.block for r in W.pack_budget(rows, "g", "k", "n", 10).orderBy("k").collect()]
    assert got == [0, 0, 1, 2, 3, 3, 4]


def test_records(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"source": "A", "entries": [{"name": "x", "type": "T", "catalogued": True, "description": "abc"}, None]}))
    (tmp_path / "b.json").write_text(json.dumps({"source": "A", "entries": [{"name": "x"}]}))
    (tmp_path / "c.json").write_text("{ not json")
    docs = records.read_json(spark, str(tmp_path), records.RECORD)
    assert [r.file for r in records.unreadable(docs).collect()] == ["c.json"]
    assert sorted((r.source, r.name, r.description_chars) for r in records.entries(docs).collect()) == [("A", "x", 0), ("A", "x", 3)]
    assert [(r.source, r.files) for r in records.sources(docs).collect()] == [("A", 2)]


def test_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<r><element name='A' type='Spell'><d>one</d></element><element name='B' type='Item'><d>two</d></element></r>")
    rows = records.read_xml(spark, str(tmp_path), "element").select("_name", "_type", "d").collect()
    assert sorted(map(tuple, rows)) == [("A", "Spell", "one"), ("B", "Item", "two")]


def test_markup(spark):
    text = "# Age\nintro\n## One\n**Bob** met **a long thing that says very many words at once**\n### Sub\nx\n## Two\n| a | b |\n|---|---|\n| 1 | 2 |"
    docs = spark.createDataFrame([("f", text)], "file string, text string")
    s = {r.title: (r.level, r.line, r.last) for r in markup.sections(docs).collect()}
    assert s == {"Age": (1, 0, 9), "One": (2, 2, 5), "Sub": (3, 4, 5), "Two": (2, 6, 9)}
    spans = {r.span: r.reason for r in markup.participants(markup.sections(docs).where("level = 2")).collect()}
    assert spans == {"Bob": None, "a long thing that says very many words at once": "long"}
    assert [r.cells for r in markup.pipe_rows(docs).orderBy("line").collect()] == [["a", "b"], ["1", "2"]]
    wiki = spark.createDataFrame([("w", "{|\n|-\n| [[Goku|Son Goku]] || 9,000\n|-\n| [[Krillin]] || 75\n|-\n| [[Krillin]] || 206\n|}")], "file string, text string")
    assert {r.name: r.value for r in markup.wiki_numbers(wiki).collect()} == {"Son Goku": 9000.0, "Krillin": 206.0}
    assert values(spark, ["'''Bold''' [[a|b]] {{t|{{u}}}} <ref>r</ref>== H =="], markup.strip_wikitext(F.col("x"))) == ["Bold b == H =="]


def test_sinks(spark, tmp_path):
    folder = str(tmp_path / "t")
    one = sinks.replace_if_unchanged(spark.range(3), folder, None)
    two = sinks.replace_if_unchanged(spark.range(4), folder, one)
    assert sinks.read_current(spark, folder).count() == 4 and one != two
    with pytest.raises(sinks.Changed):
        sinks.replace_if_unchanged(spark.range(9), folder, one)
    blobs = str(tmp_path / "b")
    sinks.store_blobs(spark.createDataFrame([("x",), ("x",), (None,)], "t string"), "t", blobs)
    assert spark.read.parquet(blobs).count() == 1 and sinks.broken_blobs(spark, blobs).isEmpty()
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "f").write_text("1")
    before = spark.createDataFrame(sinks.manifest(spark, str(tmp_path / "m")).collect())
    (tmp_path / "m" / "f").write_text("2")
    assert [r.state for r in sinks.verify(before, sinks.manifest(spark, str(tmp_path / "m"))).collect()] == ["changed"]


def test_stream_counts_match_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), "1 day", late="60 days")
    query = stream.writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, windowed_counts(events, "1 day").collect()))


def test_stream_stalls(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    rows = [("j", t0 + timedelta(minutes=m), d) for m, d in ((0, 1), (10, 2), (20, 2), (45, 2), (50, 0))]
    spark.createDataFrame(rows, "job string, ts timestamp, done long").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = stalls(spark.readStream.schema("job string, ts timestamp, done long").parquet(str(tmp_path / "in")), 1800)
    query = stream.writeStream.format("memory").queryName("stalls").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert [r.verdict for r in spark.table("stalls").orderBy("at").collect()] == ["advancing", "advancing", "waiting", "stalled", "reset"]


def test_entry_without_llm(spark, monkeypatch):
    import builtins
    import importlib
    import sys

    real = builtins.__import__

    def missing(name, *args, **kwargs):
        if name == "corpus_pipeline" or name.startswith("quarryline.llm"):
            raise ModuleNotFoundError(name=name if name == "corpus_pipeline" else "quarryline.llm")
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", missing)
    sys.modules.pop("__spark_entry__", None)
    entry = importlib.import_module("__spark_entry__")
    assert "q01_coverage_by_source" in entry.queries() and not any(n.startswith("op") for n in entry.queries())
    assert entry.entry(spark).columns
    sys.modules.pop("__spark_entry__", None)


def test_shelves(spark):
    from quarryline.operators.shelves import shelve

    rows = [(f"m{i}", f"m{j}", 10.0 if i // 5 == j // 5 else 0.1) for i in range(20) for j in range(i)]
    members = spark.createDataFrame([("g", f"m{i}") for i in range(20)] + [("h", "solo")], "g string, member string")
    got = {r.member: r.path for r in shelve(spark.createDataFrame(rows, "a string, b string, w double"), members, "g", span=4, depth=2).collect()}
    assert got["solo"] == [0, 0] and all(len(p) == 2 and max(p) < 4 for p in got.values())
    assert all(len({got[f"m{i}"][0] for i in range(5 * k, 5 * k + 5)}) == 1 for k in range(4)) and len({got[f"m{i}"][0] for i in range(20)}) == 4


def test_ingest_merges_new_files(spark, tmp_path):
    from quarryline.streaming.ingest import bury, compact, ingest, latest

    source, folder, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")
    schema = "k long, v string, at long"
    held = lambda: {r.k: r.v for r in latest(spark, folder, ["k"], "at").collect()}
    deltas = lambda: len(list((tmp_path / "out" / "_deltas").glob("_batch=*")))
    files = []

    def arrive(*rows):
        before = set((tmp_path / "in").glob("*.json")) if (tmp_path / "in").exists() else set()
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        files.append((set((tmp_path / "in").glob("*.json")) - before).pop())
        ingest(spark, source, schema, folder, state, ["k"], "at").awaitTermination(120)

    assert latest(spark, folder, ["k"], "at") is None
    arrive((1, "a", 1), (2, "b", 1))
    assert held() == {1: "a", 2: "b"}
    arrive((1, "c", 2), (2, "old", 0), (3, "d", 1))
    assert held() == {1: "c", 2: "b", 3: "d"} and deltas() == 2  # each batch wrote its own rows only
    compact(spark, folder, ["k"], "at")
    assert held() == {1: "c", 2: "b", 3: "d"} and deltas() == 0  # deltas are retired with the commit that took them in
    read = latest(spark, folder, ["k"], "at").inputFiles()
    for k in range(3):  # history leaves nothing behind that a read would open
        arrive((3, f"d{k}", 2 + k))
        compact(spark, folder, ["k"], "at")
    assert held() == {1: "c", 2: "b", 3: "d2"} and len(latest(spark, folder, ["k"], "at").inputFiles()) <= len(read) + 3 and deltas() == 0
    arrive((4, "e", 1))
    assert bury(spark, folder, source) == 0
    files[1].unlink()  # the file of c, old and d
    files[-1].unlink()
    assert bury(spark, folder, source) == 2 and held() == {1: "a", 2: "b", 3: "d2"}  # a key falls back on another file
    assert bury(spark, folder, source) == 0
    compact(spark, folder, ["k"], "at")
    assert held() == {1: "a", 2: "b", 3: "d2"}
    arrive((1, "z", 9))
    assert held() == {1: "z", 2: "b", 3: "d2"}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    from quarryline.streaming.ingest import compact, latest, merge_batch

    folder, merge = str(tmp_path / "out"), merge_batch(str(tmp_path / "out"), ["k"], "at")
    one, two = (spark.createDataFrame(rows, "k long, v string, at long") for rows in ([(1, "a", 1)], [(1, "b", 2), (2, "c", 1)]))
    merge(one, 0)
    merge(two, 1)
    compact(spark, folder, ["k"], "at")
    merge(two, 1)  # Spark repeats its last batch after a failure, here one that the base has already
    assert sorted((r.k, r.v) for r in latest(spark, folder, ["k"], "at").collect()) == [(1, "b"), (2, "c")]
    compact(spark, folder, ["k"], "at")
    assert latest(spark, folder, ["k"], "at").count() == 2 and not list((tmp_path / "out" / "_deltas").glob("_batch=*"))


def test_engine_facade(spark):
    from quarryline.api import Engine

    engine = Engine(spark, SF)
    assert engine.sql("select count(*) n from documents where source = :s", s="src1").first().n > 0
    assert "q14_idf" in engine.names() and engine.named("q05_categories").count() > 0
    with pytest.raises(ValueError):
        engine.sql("drop table documents")
