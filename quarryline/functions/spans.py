"""Spans of a text (start, end, and what was found) as column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spans that a task holds before it hands them on.
_HELD = 100_000


def after_first_sentence(name: str) -> str:
    """A pattern whose group is the last ``name`` of the first sentence that has one and is not the text's first.

    It finds what ``[^.!?]*[.!?]\\s+(?:[^.!?]*\\b)?(name)`` finds, in time in proportion to the text: a sentence is tried from
    its start alone, and neither it nor the white space after it is given back (``name`` starts with neither).
    """
    return rf"(?<![^.!?])[^.!?]*+[.!?]\s++(?:[^.!?]*\b)?({name})"


def spans_of(text: Column, pattern: str, kind: str) -> Column:
    """array of (start, end, kind, found) of every match, by character from 0.

    Matches and what lies between them alternate, so starts are running sums of their lengths.
    """
    text = F.coalesce(text, F.lit(""))
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    between = F.split(text, pattern, -1)
    sizes = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, f: F.struct(F.length(b).alias("b"), f.alias("f")))
    empty = F.array().cast("array<struct<start:int,end:int,kind:string,found:string>>")

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["b"]
        span = F.struct(start.alias("start"), (start + F.length(x["f"])).alias("end"), F.lit(kind).alias("kind"), x["f"].alias("found"))
        return F.struct(F.concat(state["out"], F.array(span)).alias("out"), (start + F.length(x["f"])).alias("at"))

    return F.aggregate(sizes, F.struct(empty.alias("out"), F.lit(0).alias("at")), add, lambda s: s["out"])


def outermost(spans: Column, kind: str = "array<struct<start:int,end:int,kind:string,found:string>>") -> Column:
    """The spans that no other one contains, in order; of equal spans the least in its further fields stays.

    A sweep by start, longer ones first: a span is contained if it ends no later than any before it.
    """
    before = lambda a, b: (
        F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
        .when(a["end"] != b["end"], F.when(a["end"] > b["end"], -1).otherwise(1))
        .when(a < b, -1)
        .when(a > b, 1)
        .otherwise(0)
    )
    start = F.struct(F.array().cast(kind).alias("out"), F.lit(-1).alias("reach"))
    keep = lambda s, x: F.when(x["end"] > s["reach"], F.struct(F.concat(s["out"], F.array(x)).alias("out"), x["end"].alias("reach"))).otherwise(s)
    return F.aggregate(F.array_sort(spans, before), start, keep, lambda s: s["out"])


def outermost_rows(rows: DataFrame, key: str, text: str, patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """key, kind, start, end: a row a span of ``outermost`` over the matches of all (kind, pattern), for long texts.

    Column expressions have no positions of matches, and arrays that grow by one element are copied each time; here a
    text's time grows with its length and the sorting of its spans.
    """
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = [(name, re.compile(pattern)) for name, pattern in patterns]

        def out(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, names, starts, ends = zip(*held)
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(names, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=[key, "kind", "start", "end"])

        for batch in batches:
            held: list[tuple] = []
            for at, value in enumerate(batch.column(1)):
                body, reach = value.as_py() or "", -1
                for start, end, name in sorted((m.start(), -m.end(), name) for name, pattern in told for m in pattern.finditer(body)):
                    if -end > reach:
                        reach = -end
                        held.append((at, name, start, reach))
                if len(held) >= _HELD:
                    yield out(batch)
                    held.clear()
            if held:
                yield out(batch)

    return rows.select(key, text).mapInArrow(run, f"`{key}` {kind}, kind string, start int, end int")
