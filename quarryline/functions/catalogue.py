"""Codecs, stems, ordered rules, verdicts and coined names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions.gates import well_formed
from quarryline.functions.numeric import hash_seed
from quarryline.functions.text import name_key

#: Syllables of coined names: onsets, vowels, endings (fixed values).
ONSETS = ["am", "be", "ca", "do", "el", "fi", "go", "ha", "is", "ka", "lo", "mi", "na", "or", "pe", "ru", "sa", "ti", "ul", "va"]
VOWELS = ["la", "ne", "ri", "so", "tu", "ma", "de", "li"]
ENDINGS = ["n", "s", "r", "th", "l", "m"]


def stem(c: Column | str, letters: int) -> Column:
    """A lossy key: the first letters of the name's key."""
    return F.left(name_key(c), F.lit(letters))


def encode_profile(fields: Sequence[Column]) -> Column:
    """Fields in one string, parted by hyphens; fields must hold none."""
    return F.concat_ws("-", *[f.cast("string") for f in fields])


def decode_profile(code: Column, n: int) -> list[Column]:
    parts = F.split(code, "-")
    return [F.get(parts, F.lit(k)) for k in range(n)]


def base36(number: Column) -> Column:
    return F.lower(F.conv(number.cast("string"), 10, 36))


def first_match(rules: Sequence[tuple[Column, str, str]], defaults: Sequence[str], seed: Column) -> tuple[Column, Column]:
    """(value, provenance): the first rule whose pattern is in its text, else a default by hash."""
    value, how = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, pattern, result in rules:
        hit = text.rlike(pattern)
        value, how = F.coalesce(value, F.when(hit, result)), F.coalesce(how, F.when(hit, "text"))
    default = F.element_at(F.array(*[F.lit(d) for d in defaults]), (hash_seed(seed) % len(defaults) + 1).cast("int"))
    return F.coalesce(value, default), F.coalesce(how, F.lit("hash"))


def probe_verdict(present: Column, absent: Column, reachable: Column) -> Column:
    """Verdict of three probes: finds what is there, does not find what is not, answers at all."""
    return F.when(~reachable, "UNREACHABLE").when(present & absent.isNull(), "UNCHECKED").when(present & ~absent, "CONFIRMED").when(present & absent, "INDISCRIMINATE").otherwise("ABSENT")


def coined(seed: Column, salt: int) -> Column:
    pick = lambda options, part: F.element_at(F.array(*[F.lit(o) for o in options]), (hash_seed(F.concat(seed, F.lit(f"/{salt}/{part}"))) % len(options) + 1).cast("int"))
    return F.concat(pick(ONSETS, "a"), pick(VOWELS, "b"), pick(ENDINGS, "c"), F.when(hash_seed(F.concat(seed, F.lit(f"/{salt}/d"))) % 2 == 0, pick(VOWELS, "e")).otherwise(F.lit("")))


def coin_names(df: DataFrame, tries: int = 6) -> DataFrame:
    """id, name, attempt of every (id, seed): the first sayable try that no smaller id has; else the digest's tail is added.

    All tries are made at once and competed for by one aggregation a round, so that no name depends on
    the order in which rows arrive.
    """
    from quarryline.operators.snapshots import snapshot

    left = snapshot(df.select("id", "seed"))
    done = None
    for k in range(tries):
        tried = left.withColumn("name", coined(F.col("seed"), k)).where(well_formed(F.col("name")))
        won = tried.groupBy("name").agg(F.min("id").alias("id"))
        if done is not None:
            won = won.join(done.select("name"), "name", "left_anti")
        won = won.select("id", "name", F.lit(k).alias("attempt"))
        done = snapshot(won if done is None else done.union(won))
        left = snapshot(left.join(done.select("id"), "id", "left_anti"))
        if left.isEmpty():
            break
    rest = left.select("id", F.concat(coined(F.col("seed"), 0), F.lit("-"), F.left(F.sha2(F.concat("seed", F.col("id").cast("string")), 256), F.lit(8))).alias("name"), F.lit(tries).alias("attempt"))
    return done.union(rest)
