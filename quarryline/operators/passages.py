"""Passages in texts: verbatim containment without comparing every text with every passage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most words of the run by which a passage finds its candidate texts.
ANCHOR_WORDS = 4
#: Anchors that are looked up in a broadcast list; more of them are joined. Bytes of a slice of passages without anchor.
LISTED_ANCHORS = 20_000
SLICE_BYTES = 4 << 20


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \t\r\n]+"), lambda w: F.length(w) > 0)


def _runs(text: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words: the word array is zipped with its own shifts, one pass for each text."""
    shifted = lambda ws: F.arrays_zip(*[F.slice(ws, k + 1, F.greatest(F.size(ws) - width + 1, F.lit(0))).alias(f"w{k}") for k in range(width)])
    return F.transform(F.array(_words(text)), lambda ws: F.transform(shifted(ws), lambda r: F.xxhash64(F.lit(width), *[r[f"w{k}"] for k in range(width)])))[0]


def passages_in(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """(doc_id, item_id) of each passage that a text contains as a substring.

    All but the first and last word of a passage are whole words of any text that contains it, so a run
    of them (up to ANCHOR_WORDS) is an equality key; ``contains`` then decides. A text goes on only
    with the anchors that it has. Passages of one or two words have no whole word and are looked for
    in every text, in slices of bounded size. Null or blank passages are in no text; an empty passage
    of spaces only counts as blank.
    """
    items = passages.where(F.trim(F.coalesce("text", F.lit(""))) != "").select("item_id", F.col("text").alias("passage"), F.size(_words(F.col("text"))).alias("n"))
    items = items.dropDuplicates(["item_id", "passage"])
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    width = F.least(F.col("n") - 2, F.lit(ANCHOR_WORDS))
    out = []
    for k in sorted(r.k for r in items.where("n >= 3").select(width.alias("k")).distinct().collect()):  # four widths at most
        keyed = items.where(width == k).select("item_id", "passage", F.get(_runs(F.col("passage"), k), F.lit(1)).alias("anchor"))
        anchors = keyed.select("anchor").distinct()
        runs = F.array_distinct(_runs(F.col("text"), k))
        if anchors.count() <= LISTED_ANCHORS:
            listed = anchors.agg(F.collect_set("anchor").alias("listed"))
            hits = texts.crossJoin(F.broadcast(listed)).select("doc_id", "text", F.explode(F.array_intersect(runs, "listed")).alias("anchor"))  # listed is one row of LISTED_ANCHORS numbers at most
        else:
            found = texts.select("doc_id", F.explode(runs).alias("anchor")).join(anchors, "anchor").distinct()
            hits = found.join(texts, "doc_id")
        out.append(hits.join(keyed, "anchor").where(F.contains("text", "passage")).select("doc_id", "item_id"))
    short = items.where("n < 3")
    size = short.agg(F.sum(F.octet_length("passage") + 32)).first()[0] or 0
    slices = -(-size // SLICE_BYTES)
    for k in range(slices):
        part = short.where(F.pmod(F.xxhash64("item_id", "passage"), F.lit(slices)) == k).select("item_id", "passage")
        out.append(texts.join(F.broadcast(part), F.contains("text", "passage")).select("doc_id", "item_id"))  # about SLICE_BYTES
    if not out:
        return docs.select("doc_id").crossJoin(passages.select("item_id")).limit(0)
    found = out[0]
    for part in out[1:]:
        found = found.union(part)
    return found.distinct()
