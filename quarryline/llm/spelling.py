"""Spelling variants by a symmetric-delete join.

Every word emits itself and its distinct single deletions as hashed keys; words that share a key are
candidates, and those at an edit distance of exactly one are near. A near word of much larger count is
a word's form, and forms are followed to the root by joins that double the distance in each round.

A key is a polynomial hash over code points, so a word's deletions come out of prefix sums: a word of L
letters costs L keys of eight bytes, not L strings of L letters. A key has at most as many words as there
are letters times places, whatever the corpus; hash collisions only add candidates, which the exact
distance refuses. Copies of a word are added up before the shuffle.

Defined cases: null and empty texts have no words; a null ``doc_id`` counts as the empty string in the
hash that decides on damage; rows that repeat count each time; of near words with equal counts the smallest
in code-point order is the form; a form's count is at least ``RATIO`` (more than one) times the word's, so that
forms never meet in a ring; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.rolling import mix
from quarryline.llm.shared import bounded, cut
from quarryline.operators.snapshots import discard

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many (by its hash) loses a letter.
DAMAGED = 199
MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5
_BASE = 0x9E3779B97F4A7C15 | 1
#: Letters whose keys are computed at a time (a longer word is computed alone).
LETTERS = 1 << 16


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, word: every maximal run of letters of the whole texts, A-Z lower-cased."""
    lowered = F.translate("text", UPPER, LOWER)
    return docs.select("doc_id", F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("word"))


def damage(found: DataFrame) -> DataFrame:
    """word: the runs, of which one in ``DAMAGED`` lacks the code point that its hash names."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")))
    hashed = found.select("word", h.alias("h"))
    at = (F.col("h") % F.length("word")).cast("int")
    without = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
    return hashed.select(F.when(F.col("h") % DAMAGED == 0, without).otherwise(F.col("word")).alias("word"))


def vocabulary(found: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """id (64-bit hash), word, n of the words that are long and frequent enough."""
    counted = found.where(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count).select(F.xxhash64("word").alias("id"), "word", "n")


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def deletion_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``words``, key) of every word and of its distinct single deletions."""
    sizes = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    end = np.cumsum(sizes)
    start = end - sizes
    power, inverse = _powers(len(letters) + 2)
    total = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum((letters + np.uint64(1)) * power[: len(letters)], out=total[1:])
    of = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(letters))
    distinct = np.ones(len(letters), bool)  # in a run of one letter every deletion gives the same word
    distinct[1:] = letters[1:] != letters[:-1]
    distinct[start[sizes > 0]] = True
    of, at = of[distinct], at[distinct]
    s, e = start[of], end[of]
    # what follows the deleted letter moves one place down
    deleted = ((total[at] - total[s]) + (total[e] - total[at + 1]) * inverse[1]) * inverse[s]
    whole = (total[end] - total[start]) * inverse[start]
    length = np.concatenate([sizes[of] - 1, sizes]).astype(np.uint64)
    keys = mix(np.concatenate([deleted, whole]) + length * np.uint64(0xD1342543DE82EF95))
    return np.concatenate([of, np.arange(len(words))]), keys.view(np.int64)


def keyed(words: DataFrame) -> DataFrame:
    """key, id of every word and of its single deletions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            held: list[str] = []
            size = first = 0
            for k, word in enumerate([*batch.column(1).to_pylist(), None]):
                if word is None or size + len(word) > LETTERS:
                    if held:
                        of, keys = deletion_keys(held)
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids[first + of])], names=["key", "id"])
                    held, size, first = [], 0, k
                if word is not None:
                    held.append(word)
                    size += len(word)

    return bounded(words).select("id", "word").mapInArrow(run, "key long, id long")


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n of each pair (once) that differs by exactly one inserted, deleted or replaced code point."""
    keys = keyed(words)
    other = keys.select("key", F.col("id").alias("other_id"))
    pairs = keys.join(other, "key").where("id < other_id").select("id", "other_id").distinct()
    left = words.select("id", "word", "n")
    right = words.select(F.col("id").alias("other_id"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    found = pairs.join(left, "id").join(right, "other_id")
    return found.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n_near, form, form_n of the words that have near words; form and form_n are null where none is frequent enough."""
    pairs = near_pairs(words)
    turned = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("o")))
    grouped = pairs.unionByName(turned).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.m") >= ratio * F.col("n")
    return grouped.select("word", "n_near", F.when(enough, F.col("best.o")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n"))


def roots(edges: DataFrame) -> DataFrame:
    """word, root for each word of ``edges`` (word, form): the last word that its forms lead to."""
    way = cut(edges.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        last, way = way, cut(way.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(last)
        moved = way.where("moved").limit(1).count()
        way_path, way = way._quarryline_path, way.drop("moved")
        way._quarryline_path = way_path
        if not moved:
            return way


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the whole texts, after the damage."""
    words = cut(vocabulary(damage(runs(docs))), "words")
    known = cut(forms(words), "forms")
    root = roots(known.where("form is not null"))
    out = words.select("word", "n").join(known, "word", "left").join(root, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
