"""Chunks without loss, and mining that goes on where it was."""

import re
from collections import Counter

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from quarryline.operators import mining
from quarryline.sources.tableset import TableSet

def names():
    return F.regexp_extract_all("part", F.lit(r"[A-Z][a-z]+"), F.lit(0))


def brute_chunks(pages, budget):
    """Blocks of (page, piece, text), page by page."""
    out, held = [], 0
    for page, text in pages:
        text = text or ""
        cut = [(page, k, text[k * budget : (k + 1) * budget]) for k in range(max(1, -(-len(text) // budget)))]
        if len(cut) > 1:
            out += [[c] for c in cut]
            held = budget
        elif not out or held + max(1, len(text)) > budget:
            out.append(cut)
            held = max(1, len(text))
        else:
            out[-1] += cut
            held += max(1, len(text))
    return out


def pages(spark, by_group):
    rows = [(g, k, t) for g, held in by_group.items() for k, t in held]
    return spark.createDataFrame(rows, "source string, doc_id long, text string")


def test_nothing_is_lost_at_a_cut(spark):
    held = {"a": [(1, "x" * 4), (2, "y" * 25), (5, ""), (6, "zz"), (7, None), (9, "w" * 10), (11, "é" * 11), (12, "v")], "b": [(1, None)], "c": [(3, "q" * 40)]}
    got = {}
    for r in mining.chunks(pages(spark, held), "source", "doc_id", "text", 10).collect():
        got.setdefault(r.group, {}).setdefault(r.block, []).append((r.page, r.piece, r.part))
    for g, rows in held.items():
        want = brute_chunks(rows, 10)
        assert [sorted(got[g][b]) for b in sorted(got[g])] == want
        assert sum(len(x) for b in want for *_, x in b) == sum(len(t or "") for _, t in rows)
    assert mining.chunks(pages(spark, {}), "source", "doc_id", "text", 10).count() == 0


def test_a_resumed_run_repeats_nothing(spark, tmp_path, monkeypatch):
    held = {g: [(k, f"Alpha met Béta{k % 3}x and ALPHA. " * (1 + 7 * (k % 4 == 1))) for k in range(12)] for g in ("s", "t")}
    docs, folder = pages(spark, held), str(tmp_path / "m")
    blocks = {g: brute_chunks(rows, 60) for g, rows in held.items()}
    table = lambda: {(r.group, r.key): (r.name, r.n, r.block) for r in TableSet(spark, folder).read("found").collect()}

    def want(upto):
        out = {}
        for g, b in blocks.items():
            names = [(m, k) for k, held in enumerate(b[:upto]) for _, _, text in held for m in re.findall("[A-Z][a-z]+", text)]
            keys = Counter(m.lower() for m, _ in names)
            out |= {(g, k): (next(m for m, _ in names if m.lower() == k), n, next(b for m, b in names if m.lower() == k)) for k, n in keys.items()}
        return out

    mine = lambda most=None: mining.mine(docs, "source", "doc_id", "text", names(), folder, 60, most)
    assert mine(3) == 6 and table() == want(3)
    write = DataFrameWriter.parquet

    def dies(self, path, *args, **kwargs):
        if path.endswith("/cursor"):
            raise OSError("killed")
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", dies)
    with pytest.raises(OSError):
        mine(2)
    monkeypatch.undo()
    assert table() == want(3)  # neither table of the dead run counts
    assert mine(2) == 4 and table() == want(5)
    assert mine() == sum(len(b) - 5 for b in blocks.values()) and table() == want(10**9)
    assert mine() == 0 and table() == want(10**9)
