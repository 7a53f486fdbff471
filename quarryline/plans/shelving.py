"""Queries over instruments, shelves and job manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions import rules as K
from quarryline.operators.shelves import shelve
from quarryline.operators.windows import places
from quarryline.plans.base import Registry, Tables

R = Registry()

# Windows of the instrument by band (fixed values).
WINDOWS = {"M0": (1, 18), "M1": (8, 22), "M2": (12, 26), "M3": (16, 28), "M4": (18, 30), "M5": (30, 30)}


def _case(column: str, side: int) -> str:
    return "case " + column + " " + " ".join(f"when '{b}' then {w[side]}" for b, w in WINDOWS.items()) + " end"


@R.add("q138_instrument", f"""with s as (select o_orderkey, 'M' || (o_orderkey % 6) band, o_totalprice / 60000 ruin, case when o_orderkey % 4 = 0 then null else o_totalprice / 90000 end sustain from orders)
 select o_orderkey, band, round_even({_case('band', 0)} + least(ruin, 10) / 10 * ({_case('band', 1)} - {_case('band', 0)}), 0)::int strength, case when sustain is not null then round_even({_case('band', 0)} + (least(ruin, 10) + least(sustain, 10)) / 20 * ({_case('band', 1)} - {_case('band', 0)}), 0)::int end constitution from s""")
def instrument(t: Tables) -> DataFrame:
    """Axis scores on the window of their band; constitution is the mean of two axes, null if either is unread."""
    band = F.concat(F.lit("M"), (F.col("o_orderkey") % 6).cast("string"))
    rows = t.orders.select("o_orderkey", band.alias("band"), F.least(F.col("o_totalprice") / 60000, F.lit(10.0)).alias("ruin"), F.least(F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice") / 90000), F.lit(10.0)).alias("sustain"), F.col("o_orderkey") % 4 != 0)
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for b, (a, z) in WINDOWS.items():
        low, high = F.when(F.col("band") == b, float(a)).otherwise(low), F.when(F.col("band") == b, float(z)).otherwise(high)
    place = lambda s: F.bround(low + s / 10 * (high - low), 0).cast("int")
    both = F.when(F.col("o_orderkey") % 4 != 0, (F.col("ruin") + F.col("sustain")) / 2)
    return rows.select("o_orderkey", "band", place(F.col("ruin")).alias("strength"), place(both).alias("constitution"))


_W = K.WEIGHTS


@R.add("q139_widening", "with r as (select c_nationkey k, 0.2::double + 0.05::double * (c_nationkey % 5) rho from customer group by 1, 2) select k, sqrt((" + repr(sum(v * v for v in _W.values())) + "::double * (1 - rho) + rho) / " + repr(sum(v * v for v in _W.values())) + "::double) widening from r")
def widening(t: Tables) -> DataFrame:
    """How much wider an interval is when the axes' errors correlate: root of total over independent variance."""
    squares = sum(v * v for v in _W.values())
    rows = t.customer.select(F.col("c_nationkey").alias("k")).distinct().withColumn("rho", 0.2 + 0.05 * (F.col("k") % 5))
    return rows.select("k", F.sqrt((squares * (1 - F.col("rho")) + F.col("rho")) / squares).alias("widening"))


@R.add("q140_shelves")
def shelves(t: Tables) -> DataFrame:
    from quarryline.plans.measures import _graph

    members = t.documents.where("source is not null").select(F.lit("all").alias("g"), F.col("source").alias("member")).distinct()
    return shelve(_graph(t), members, "g")


@R.add("q141_job_manifest", """with e as (select source, lang, doc_id, row_number() over (partition by source, lang order by doc_id) n from documents), j as (select source, lang, (n - 1) // 10 part, min(n) first_n, max(n) last_n, count(*) entries, sha256(string_agg(doc_id::varchar, ',' order by doc_id)) content_hash from e group by 1, 2, 3)
 select source || '/' || lang || '/' || part job, first_n || '-' || last_n span, entries, content_hash from j""")
def job_manifest(t: Tables) -> DataFrame:
    """Jobs of ten entries by source and chapter with their span and content hash."""
    rows = places(t.documents.select("source", "lang", "doc_id"), ["source", "lang"], ["doc_id"], "n").withColumn("part", F.floor((F.col("n") - 1) / 10))
    jobs = rows.groupBy("source", "lang", "part").agg(F.min("n").alias("a"), F.max("n").alias("z"), F.count(F.lit(1)).alias("entries"), F.array_sort(F.collect_list("doc_id")).alias("ids"))
    return jobs.select(F.concat_ws("/", "source", "lang", F.col("part").cast("string")).alias("job"), F.concat_ws("-", F.col("a").cast("string"), F.col("z").cast("string")).alias("span"), "entries", F.sha2(F.array_join("ids", ","), 256).alias("content_hash"))
