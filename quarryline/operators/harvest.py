"""Contests told in sentences: who won over whom, by names on both sides of the word that tells it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions.spans import outermost
from quarryline.operators.snapshots import snapshot

#: Bytes of names whose automaton a task holds at a time; more names are searched in as many passes.
SLICE_BYTES = 4 << 20
_SPANS = "array<struct<start:int,end:int,key:string>>"


@dataclass(frozen=True)
class Telling:
    """Patterns of lower-case text: where the winner stands before the word, and where after it."""

    won: str
    lost: str


def _automaton(names: list[tuple[str, str]]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for name, key in names:
        found.add_word(name, (len(name), key))
    found.make_automaton()
    return found


def mentions(sentences: DataFrame, names: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The columns of ``sentences`` (with ``text``, lower-case) and ``spans``: the names (name, key) that stand there as whole words, none inside another.

    An Aho-Corasick automaton over a slice of the names reads each text once. The number of slices comes from the
    names' bytes; a text's spans of all slices are put together before those inside others go.
    """
    known = snapshot(names.select(F.lower("name").alias("name"), "key").where("name <> ''").groupBy("name").agg(F.min("key").cast("string").alias("key")), "names")
    size = known.agg(F.sum(F.octet_length("name") + 64)).first()[0] or 0
    slices = max(1, -(-size // slice_bytes))
    rows = snapshot(sentences.withColumn("_row", F.monotonically_increasing_id()), "sentences") if slices > 1 else sentences
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + f", spans {_SPANS}"
    at = rows.columns.index("text")
    parts = []
    for k in range(slices):
        held = [(r.name, r.key) for r in known.where(F.pmod(F.xxhash64("name"), F.lit(slices)) == k).collect()]  # slice_bytes of them
        sent = rows.sparkSession.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            found = _automaton(sent.value) if sent.value else None
            for batch in batches:
                out = []
                for text in batch.column(at).to_pylist():
                    spans = []
                    for end, (n, key) in found.iter(text) if found and text else ():
                        start = end + 1 - n
                        if not (start and text[start - 1].isalnum()) and not text[end + 1 : end + 2].isalnum():
                            spans.append({"start": start, "end": end + 1, "key": key})
                    out.append(spans)
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("key", pa.string())]))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, "spans"])

        parts.append(rows.mapInArrow(run, schema))
    if slices == 1:
        return parts[0].withColumn("spans", outermost(F.col("spans"), _SPANS))
    apart = parts[0].select("_row", "spans")
    for part in parts[1:]:
        apart = apart.unionByName(part.select("_row", "spans"))
    together = apart.where("size(spans) > 0").groupBy("_row").agg(outermost(F.flatten(F.collect_list("spans")), _SPANS).alias("spans"))
    return rows.join(together, "_row", "left").drop("_row").withColumn("spans", F.coalesce("spans", F.array().cast(_SPANS)))


def contests(sentences: DataFrame, names: DataFrame, telling: Telling, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The columns of ``sentences`` (with ``text``) that tell a contest, and winner, loser: the nearest names on the two sides of its first telling word, or null."""
    lowered = sentences.withColumn("text", F.lower("text"))
    word = f"(?:{telling.won})|(?:{telling.lost})"
    told = lowered.where(F.col("text").rlike(word))
    before = F.regexp_extract("text", rf"(?s)^(.*?)(?:{word})", 1)
    said = F.regexp_extract("text", rf"(?s)^.*?({word})", 1)
    told = told.withColumns({"_from": F.length(before), "_to": F.length(before) + F.length(said), "_turned": ~said.rlike(f"^(?:{telling.won})$")})
    found = mentions(told, names, slice_bytes)
    left = F.filter("spans", lambda s: s["end"] <= F.col("_from"))
    right = F.filter("spans", lambda s: s["start"] >= F.col("_to"))
    ahead, behind = F.get(left, F.size(left) - 1)["key"], F.get(right, F.lit(0))["key"]
    sides = {"winner": F.when(F.col("_turned"), behind).otherwise(ahead), "loser": F.when(F.col("_turned"), ahead).otherwise(behind)}
    return found.withColumns(sides).drop("_from", "_to", "_turned", "spans")


def edges(found: DataFrame, entity: str = "entity") -> DataFrame:
    """winner, loser, n over contests with both sides; an entity's sentence counts once however often it is found, and nobody beats themselves."""
    once = found.select(entity, "text", "winner", "loser").where("winner is not null and loser is not null and winner <> loser").distinct()
    return once.groupBy("winner", "loser").agg(F.count(F.lit(1)).alias("n"))


def sides(found: DataFrame, entity: str = "entity") -> DataFrame:
    """state, n: how many told contests are resolved, are a self-contest, or lack a side."""
    state = F.when(F.col("winner").isNull() & F.col("loser").isNull(), "neither").when(F.col("winner").isNull(), "no winner").when(F.col("loser").isNull(), "no loser")
    state = state.when(F.col("winner") == F.col("loser"), "self").otherwise("resolved")
    return found.select(entity, "text", state.alias("state")).distinct().groupBy("state").agg(F.count(F.lit(1)).alias("n"))
