"""Mining of long texts in chunks: nothing is lost at a cut, and a stopped run goes on where it was.

Pages are packed in order into chunks of a budget. A page above the budget is cut into pieces, each a chunk of
its own; the characters of all chunks are those of all pages. What an extraction finds is merged by folded key
into one table, and the chunks done are noted by group in the same commit, so a run that dies repeats at most what it had
not committed, and a resumed one reads only the chunks that are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.text import name_key
from quarryline.operators import windows as W
from quarryline.operators.snapshots import snapshot
from quarryline.sources.tableset import TableSet

#: Pieces that one page may have, in the numbering of pieces (a page of 9 billion characters).
_PIECES = 1 << 20


def pieces(pages: DataFrame, group: str, order: str, text: str, budget: int) -> DataFrame:
    """group, seq (increasing by ``order`` and place), page, piece, part: pages up to the budget whole, others cut at every ``budget`` characters."""
    body = F.coalesce(F.col(text), F.lit(""))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.length(body) / F.lit(budget)).cast("int") - 1))
    cut = pages.select(F.col(group).alias("group"), F.col(order).cast("long").alias("page"), body.alias("body"), F.explode(starts).alias("piece"))
    part = F.substring("body", F.col("piece") * budget + 1, F.lit(budget))
    return cut.select("group", (F.col("page") * _PIECES + F.col("piece")).alias("seq"), "page", "piece", part.alias("part"), (F.length("body") > budget).alias("cut"))


def chunks(pages: DataFrame, group: str, order: str, text: str, budget: int) -> DataFrame:
    """``pieces`` and ``block``, the number of the chunk in its group; a piece of a cut page is a chunk alone."""
    found = snapshot(pieces(pages, group, order, text, budget), "pieces")
    # for packing, a piece of a cut page fills a chunk whatever its length, and an empty page takes a place
    size = F.when(F.col("cut"), budget).otherwise(F.greatest(F.length("part"), F.lit(1)))
    packed = W.pack_budget(found.select("group", "seq", size.cast("long").alias("size")), "group", "seq", "size", budget)
    return found.join(packed.select("group", "seq", "block"), ["group", "seq"])


def mine(pages: DataFrame, group: str, order: str, text: str, extract: Column, folder: str, budget: int = 9000, most: int | None = None) -> int:
    """Extracts names (``extract``: an array of them, from the column ``part``) from the chunks that no run has done yet, ``most`` of each group; returns how many.

    ``found`` (group, key, name, n, block) has one row a folded name: the name and the chunk of its first mention, and how
    often it was found.
    """
    spark = pages.sparkSession
    tables = TableSet(spark, folder)
    now = tables.current()
    done = tables.read("cursor", now)
    done = spark.createDataFrame([], "group string, next long") if done is None else done
    rows = chunks(pages, group, order, text, budget).withColumn("group", F.col("group").cast("string"))
    upto = F.coalesce("next", F.lit(0)) + (most if most is not None else 1 << 60)
    left = rows.join(done, "group", "left").where((F.col("block") >= F.coalesce("next", F.lit(0))) & (F.col("block") < upto))
    left = snapshot(left.select("group", "seq", "block", "part"), "chunks")
    cursor = left.groupBy("group").agg((F.max("block") + 1).alias("next"))
    new = left.select("group", "seq", "block", F.posexplode(extract).alias("pos", "name")).withColumn("key", name_key("name")).where("key <> ''")
    first = F.min(F.struct("seq", "pos", "block", "name"))
    merged = new.groupBy("group", "key").agg(first.alias("f"), F.count(F.lit(1)).alias("n")).select("group", "key", F.col("f.name").alias("name"), "n", F.col("f.block").cast("long").alias("block"), F.lit(1).alias("run"))
    held = tables.read("found", now)
    both = merged if held is None else merged.unionByName(held.withColumn("run", F.lit(0)))
    kept = both.groupBy("group", "key").agg(F.min(F.struct("run", "name", "block")).alias("f"), F.sum("n").alias("n")).select("group", "key", "f.name", "n", "f.block")
    count = left.select("group", "block").distinct().count()
    if count:
        further = cursor.unionByName(done.join(cursor, "group", "left_anti"))
        tables.commit({"found": kept, "cursor": further}, now)
    return count
