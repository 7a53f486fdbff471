"""Queries over numbers and events: ranks, statistics, telemetry, rules, graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions import numeric as N
from quarryline.functions import text as T
from quarryline.operators import aggregates as A
from quarryline.operators import graph as G
from quarryline.operators import joins as J
from quarryline.operators.snapshots import snapshot
from quarryline.operators import stats as S
from quarryline.operators import windows as W
from quarryline.plans.base import Registry, Tables

R = Registry()


def _seconds(c: str = "ts"):
    return F.unix_timestamp(F.col(c).cast("timestamp"))


@R.add("q10_throughput", "with m as (select max(ts) - interval 15 hour since from events) select event_type, count(*) n, count(*) filter (where event_type <> 'error') ok, count(*) / 15.0::double per_hour from events, m where ts > since group by 1")
def throughput(t: Tables) -> DataFrame:
    last = t.events.agg((F.max("ts") - F.expr("interval 15 hours")).alias("since"))
    recent = t.events.crossJoin(last).where("ts > since")  # last is one row
    return recent.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") != "error").alias("ok"), (F.count(F.lit(1)) / F.lit(15.0)).alias("per_hour"))


@R.add("q11_success_rate", "with r as (select user_id, count(*) n, case when count(*) filter (where event_type in ('purchase', 'error')) > 0 then count(*) filter (where event_type = 'purchase') / count(*) filter (where event_type in ('purchase', 'error'))::double end rate from events group by user_id) select *, case when rate is null then 'idle' when rate >= 0.75 then 'healthy' when rate >= 0.5 then 'degraded' else 'failing' end regime from r")
def success_rate(t: Tables) -> DataFrame:
    tried, ok = F.count_if(F.col("event_type").isin("purchase", "error")), F.count_if(F.col("event_type") == "purchase")
    rows = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), A.ratio(ok, tried).alias("rate"))
    rate = F.col("rate")
    return rows.withColumn("regime", F.when(rate.isNull(), "idle").when(rate >= 0.75, "healthy").when(rate >= 0.5, "degraded").otherwise("failing"))


@R.add("q12_latest_state", """with r as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) i, max(ts) over () m from events) select user_id, event_id, event_type from r where i = 1 and epoch(m) - epoch(ts) <= 86400""")
def latest_state(t: Tables) -> DataFrame:
    """Latest by an aggregate of structs: no sort, combined map-side."""
    last = t.events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("l"))
    newest = t.events.agg(F.max("ts").alias("m"))
    rows = last.crossJoin(newest).where(_seconds("m") - F.unix_timestamp(F.col("l.ts").cast("timestamp")) <= 86400)  # newest is one row
    return rows.select("user_id", "l.event_id", "l.event_type")


@R.add("q13_json_rule_update", """select event_id, case when json_valid(props) and (props->>'$.k')::int = 1 then 0 else (props->>'$.k')::int end k, json_valid(props) and (props->>'$.k')::int = 1 updated from events""")
def json_rule_update(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select("event_id", F.when(k == 1, 0).otherwise(k).alias("k"), F.coalesce(k == 1, F.lit(False)).alias("updated"))


@R.add("q48_weave_order", """with l as (select o_orderkey, o_custkey, case when o_orderpriority like '1%' then 0 else 1 end lane, o_totalprice from orders), n as (select *, row_number() over (partition by o_custkey, lane order by o_totalprice desc, o_orderkey) i from l),
 k as (select *, case when lane = 0 then (i - 1)::double else (i - 1) // 4 + 0.5::double end k from n) select o_orderkey, lane, row_number() over (partition by o_custkey order by k, lane, i) "position" from k""")
def weave_order(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_orderpriority").startswith("1"), 0).otherwise(1).alias("lane"), "o_totalprice")
    return W.weave(rows, "lane", [F.desc("o_totalprice"), "o_orderkey"], 4, ["o_custkey"]).select("o_orderkey", "lane", F.col("position"))


@R.add("q49_rank_in_group", """with r as (select p_partkey, p_brand, p_type, row_number() over (partition by p_brand, p_type order by p_retailprice desc, p_partkey) i, count(*) over (partition by p_brand, p_type) n from part), b as (select *, row_number() over (partition by p_brand order by n desc, p_type, i) place from r) select p_partkey, p_brand, p_type, i "rank", place from b""")
def rank_in_group(t: Tables) -> DataFrame:
    scale = Window.partitionBy("p_brand", "p_type")
    rows = t.part.select("p_partkey", "p_brand", "p_type", F.row_number().over(scale.orderBy(F.desc("p_retailprice"), "p_partkey")).alias("rank"), F.count(F.lit(1)).over(scale).alias("n"))
    k = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("n"), "p_type", "rank"))
    return rows.select("p_partkey", "p_brand", "p_type", "rank", k.alias("place"))


@R.add("q50_nearest_rank", """with r as (select event_type, value, row_number() over (partition by event_type order by value) - 1 i, count(*) over (partition by event_type) n from events where value is not null)
 select event_type, any_value(n) n, max(value) filter (where i = least(n - 1, floor(0.5 * n))) p50, max(value) filter (where i = least(n - 1, floor(0.95 * n))) p95 from r group by 1""")
def nearest_rank(t: Tables) -> DataFrame:
    """Exact nearest rank from places in the sorted order, which are numbered by range and not by type."""
    rows = W.places(t.events.where("value is not null").select("event_type", "value"), ["event_type"], ["value"])
    sizes = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    at = lambda q: F.max(F.when(F.col("place") - 1 == F.least(F.col("n") - 1, F.floor(F.lit(q) * F.col("n"))), F.col("value")))
    return rows.join(sizes, "event_type").groupBy("event_type", "n").agg(at(0.5).alias("p50"), at(0.95).alias("p95"))


@R.add("q51_movement", """with s as (select user_id, date_trunc('hour', ts) h, count(*) c from events group by 1, 2), t as (select user_id, h, sum(c) over (partition by user_id order by h)::bigint total from s)
 select a.user_id, a.h "at", a.total, max_by(b.total, b.h) "before", a.total - max_by(b.total, b.h) delta, a.total - max_by(b.total, b.h) < 0 "reset", a.total - max_by(b.total, b.h) = 0 stalled from t a left join t b on a.user_id = b.user_id and b.h <= a.h - interval 30 minute group by 1, 2, 3""")
def movement(t: Tables) -> DataFrame:
    hourly = t.events.groupBy("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("at")).agg(F.count(F.lit(1)).alias("c"))
    total = F.sum("c").over(Window.partitionBy("user_id").orderBy("at"))
    return W.movement(hourly.select("user_id", "at", total.alias("total")), "user_id", "at", "total", 1800)


_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@R.add("q52_pearson_pairs", " union all ".join(f"select '{a}' a, '{b}' b, count(*) n, corr({a}, {b}) r from lineitem" for i, a in enumerate(_COLS) for b in _COLS[i + 1 :]))
def pearson_pairs(t: Tables) -> DataFrame:
    return S.correlations(t.lineitem.select(*_COLS), _COLS).withColumn("r", F.col("r"))


@R.add("q53_spearman", """with r as (select p_brand, rank() over (partition by p_brand order by p_size) + (count(*) over (partition by p_brand, p_size) - 1) / 2.0::double a, rank() over (partition by p_brand order by p_retailprice) + (count(*) over (partition by p_brand, p_retailprice) - 1) / 2.0::double b from part)
 select p_brand, count(*) n, round(corr(a, b), 3) rho from r group by 1 having count(*) >= 4""")
def spearman(t: Tables) -> DataFrame:
    return S.spearman(t.part, ["p_brand"], "p_size", "p_retailprice").withColumn("rho", F.round("rho", 3))


@R.add("q54_assay", """with s as (select c_custkey, ln(greatest(c_acctbal, 1)) a, n_nationkey::double / 2.4::double b, case when c_mktsegment = 'BUILDING' then null else length(c_mktsegment)::double end c from customer join nation on c_nationkey = n_nationkey),
 w as (select *, 0.5::double + 0.3::double + case when c is null then 0 else 0.2::double end tot, 0.25::double + 0.09::double + case when c is null then 0 else 0.04::double end sq from s)
 select c_custkey, (0.5::double * a + 0.3::double * b + coalesce(0.2::double * c, 0)) / tot score, 1.96::double * sqrt(1.7973::double * 1.7973::double * (sq * 0.6::double + tot * tot * 0.4::double)) / tot half from w""")
def assay(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    a, b = F.ln(F.greatest("c_acctbal", F.lit(1.0))), F.col("n_nationkey").cast("double") / 2.4
    c = F.when(F.col("c_mktsegment") != "BUILDING", F.length("c_mktsegment").cast("double"))
    score, half = S.weighted_composite([(a, 0.5), (b, 0.3), (c, 0.2)], F.lit(1.7973), 0.4)
    return rows.select("c_custkey", score.alias("score"), half.alias("half"))


@R.add("q55_covering_interval", "select user_id, count(value) n, avg(value) mean, stddev_pop(value) sd, greatest(1.96::double * stddev_pop(value), max(value) - avg(value), avg(value) - min(value)) half from events group by 1")
def covering(t: Tables) -> DataFrame:
    return S.covering_interval(t.events, "user_id", "value")


@R.add("q56_dominance", """with v as (select c_nationkey k, round(avg(c_acctbal), 2) x, count(*) y from customer group by 1)
 select a.k, count(*) filter (where a.x >= b.x and a.y >= b.y and not (a.x <= b.x and a.y <= b.y)) dominates, count(*) filter (where a.x <= b.x and a.y <= b.y and not (a.x >= b.x and a.y >= b.y)) dominated,
 count(*) filter (where a.x = b.x and a.y = b.y) tied, count(*) filter (where not (a.x >= b.x and a.y >= b.y) and not (a.x <= b.x and a.y <= b.y)) incomparable from v a join v b on a.k <> b.k group by 1""")
def dominance(t: Tables) -> DataFrame:
    v = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.round(F.avg("c_acctbal"), 2).alias("x"), F.count(F.lit(1)).alias("y"))
    return S.dominance(v, "k", ["x", "y"])


def _contests(t: Tables) -> DataFrame:
    """Nations contest by trade: each order is won by the customer's nation if it is above the mean price."""
    rows = t.lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    up = F.col("l_extendedprice") > 38_000
    return rows.select(F.when(up, F.col("c_nationkey")).otherwise(F.col("s_nationkey")).alias("winner"), F.when(up, F.col("s_nationkey")).otherwise(F.col("c_nationkey")).alias("loser")).groupBy("winner", "loser").agg(F.count(F.lit(1)).alias("n"))


R.add("q59_bradley_terry")(lambda t: S.bradley_terry(_contests(t)))


@R.add("q60_gradient_share")
def gradient_share(t: Tables) -> DataFrame:
    c = _contests(t).where("winner <> loser").cache()
    y = c.alias("x").join(c.alias("z"), (F.col("x.winner") == F.col("z.loser")) & (F.col("x.loser") == F.col("z.winner"))).where("x.winner < x.loser")
    return S.gradient_share(y.select(F.col("x.winner").alias("a"), F.col("x.loser").alias("b"), (F.log("z.n") - F.log("x.n")).alias("y")))


#: Share of the smaller source's idf from which two sources count as linked.
LINK = 0.07


def _source_words(t: Tables) -> DataFrame:
    """(source, token, weight) without repeats: words of nine letters and more by idf over sources; written once."""
    o = snapshot(t.documents.where("source is not null").select("source", F.explode(T.tokens("text", 9)).alias("token")).distinct(), "source-words")
    n = o.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    total = o.agg(F.count_distinct("source").alias("total"))
    return o.join(n, "token").crossJoin(total).select("source", "token", F.log(F.col("total") / F.col("n")).alias("weight"))  # total is one row


def _graph(t: Tables) -> DataFrame:
    """Sources linked by the words that they share, however many share them: the shared idf over the smaller source's whole idf."""
    o = snapshot(_source_words(t), "weighted-words")
    own = o.groupBy("source").agg(F.sum("weight").alias("own"))
    shared = J.pair_weights(o.where("weight > 0"), "source", "token", "weight")
    rows = shared.join(own.select(F.col("source").alias("a"), F.col("own").alias("wa")), "a").join(own.select(F.col("source").alias("b"), F.col("own").alias("wb")), "b")
    return snapshot(rows.select("a", "b", (F.col("weight") / F.least("wa", "wb")).alias("w")), "graph")


_EDGE_SQL = r"""o as (select distinct source, unnest(list_filter(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: length(w) >= 9)) token from documents where source is not null),
 w as (select source, token, ln((select count(distinct source) from o) / count(*) over (partition by token)) w from o), s as (select source, sum(w) own from w group by 1),
 e as (select a.source a, b.source b, sum(a.w) / least(any_value(x.own), any_value(y.own)) w from w a join w b using (token) join s x on x.source = a.source join s y on y.source = b.source where a.source < b.source and a.w > 0 group by 1, 2)"""


def components_sql(least: float, tag: str = "") -> str:
    return f"""with recursive {_EDGE_SQL}, u as (select a, b from e where w >= {least!r} union select b, a from e where w >= {least!r}), r(node, seen) as (select a, a from u union select r.node, u.b from r join u on r.seen = u.a) select node, min(seen) component{tag} from r group by node"""


_HOPS_SQL = f"""with recursive {_EDGE_SQL}, u as (select a, b from e where w >= {LINK!r} union select b, a from e where w >= {LINK!r}), r(o, n, h) as (select a, a, 0 from u union select r.o, u.b, r.h + 1 from r join u on r.n = u.a where r.h < 25), d as (select o, n, min(h) h from r group by 1, 2)"""


@R.add("q61_components", components_sql(LINK))
def components(t: Tables) -> DataFrame:
    return G.components(_graph(t), LINK)


R.add("q62_linkage")(lambda t: G.complete_linkage(_graph(t), LINK))
R.add("q63_eccentricity", _HOPS_SQL + " select o node, max(h)::int eccentricity, count(*) - 1 reached from d group by 1")(lambda t: G.eccentricity(_graph(t).where(F.col("w") >= LINK)))


@R.add("q215_graph_report", _HOPS_SQL + """, p as (select o, min(n) part from d group by 1), z as (select part, count(*) n from p group by 1), a as (select count(distinct source) nodes from documents)
 select nodes, (select count(*) from e where w >= """ + repr(LINK) + """) edges, (select count(*) from z) parts, (select max(n) from z) largest, nodes - (select count(*) from p) isolates, (select max(h)::int from d) diameter from a""")
def graph_report(t: Tables) -> DataFrame:
    """The source graph in numbers."""
    nodes = t.documents.where("source is not null").select(F.col("source").alias("node")).distinct()
    return G.report(_graph(t).where(F.col("w") >= LINK), nodes)


@R.add("q216_dependency_faults", """with recursive e as (select n_nationkey a, case when n_nationkey % 6 = 5 then 40 when n_nationkey < 9 then (n_nationkey + 1) % 3 else n_nationkey // 2 end b from nation),
 r(a, b) as (select a, b from e union select r.a, e.b from r join e on e.a = r.b) select a node, 'cycle' fault from r where a = b union select a, 'dangling' from e where b not in (select n_nationkey from nation)""")
def dependency_faults(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    need = F.when(k % 6 == 5, 40).when(k < 9, (k + 1) % 3).otherwise(F.floor(k / 2))
    return G.dependency_faults(t.nation.select(k.cast("long").alias("a"), need.cast("long").alias("b")), t.nation.select(k.cast("long").alias("node")))


@R.add("q64_shortest")
def shortest(t: Tables) -> DataFrame:
    g = _graph(t)
    d = G.distances(g, t.documents.where("source = 'src0'").select(F.col("source").alias("node")).distinct())
    return d.select("node", "distance", N.lag_years(F.col("distance")).alias("lag"))


@R.add("q65_dag_depth", """with recursive p as (select n_nationkey child, case when n_nationkey < 5 then null else n_nationkey // 3 end parent from nation), d(node, depth, root) as (select child, 0, child from p where parent is null union all select p.child, d.depth + 1, d.root from p join d on p.parent = d.node) select node, depth, root from d""")
def dag_depth(t: Tables) -> DataFrame:
    t.views("nation")
    return t.spark.sql(
        """with recursive p as (select n_nationkey child, case when n_nationkey < 5 then null else n_nationkey div 3 end parent from nation),
        d(node, depth, root) as (select child, 0, child from p where parent is null union all select p.child, d.depth + 1, d.root from p join d on p.parent = d.node) select node, depth, root from d"""
    )


@R.add("q66_prefix_tree", "with s as (select string_split(p_name, ' ') x from part), e as (select x, unnest(range(1, len(x) + 1)) depth from s) select array_to_string(x[1:depth], ' ') prefix, depth::int depth, count(*) n from e group by 1, 2")
def prefix_tree(t: Tables) -> DataFrame:
    return G.prefix_rollup(t.part, "p_name")


@R.add("q67_null_threshold")
def null_threshold(t: Tables) -> DataFrame:
    """The weight that chance alone reaches: forty trials at the 99.9th percentile, their median."""
    return S.median_threshold(S.null_threshold(_source_words(t), "source", "token", "weight"))


@R.add("q68_montecarlo", f"""with r as (select s_nationkey, ln(count(*)) / ln(10) - 1 m, 0.25::double + stddev_pop(s_acctbal) / 10000 s from supplier group by 1),
 i as (select (i + 0.5::double) i from range(20000) t(i)), u as (select greatest(i * {S.LATTICE[0]}::double - floor(i * {S.LATTICE[0]}::double), 1e-12) r, i * {S.LATTICE[1]}::double - floor(i * {S.LATTICE[1]}::double) a from i)
 select s_nationkey, avg(1 - exp(-pow(10.0::double, m + sqrt(-2 * ln(r)) * cos(2 * pi() * a) * s))) mean, 1 - exp(-pow(10.0::double, any_value(m))) point from r, u group by s_nationkey""")
def montecarlo(t: Tables) -> DataFrame:
    """Chance that a nation's suppliers give at least one event, with a log-normal rate from their number and the spread of their balances."""
    rates = t.supplier.groupBy("s_nationkey").agg((F.log10(F.count(F.lit(1))) - 1).alias("m"), (0.25 + F.stddev_pop("s_acctbal") / 10000).alias("s"))
    return S.at_least_one(rates, "s_nationkey", "m", "s")


@R.add("q69_invariants", """select 'orders without customer' "check", count(*) violations from orders anti join customer on o_custkey = c_custkey union all select 'lines without order', count(*) from lineitem anti join orders on l_orderkey = o_orderkey
 union all select 'repeated line numbers', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1) union all select 'documents of wrong length', count(*) from documents where n_chars <> length(text)
 union all select 'labels without document', count(*) from labels anti join documents using (doc_id) union all select 'negative balances', count(*) from customer where c_acctbal < 0 union all select 'empty turns', count(*) from conversations where coalesce(text, '') = ''
 union all select 'repeated documents', count(*) from (select 1 from documents group by doc_id having count(*) > 1) union all select 'labels out of range', count(*) from labels where quality not in (0, 1) or toxic not in (0, 1) union all select 'documents without language', count(*) from documents where lang is null
 union all select 'orders of another total', count(*) from orders where o_totalprice <= 0 union all select 'lines without supplier', count(*) from lineitem anti join supplier on l_suppkey = s_suppkey union all select 'lines without part', count(*) from lineitem anti join part on l_partkey = p_partkey
 union all select 'nations without region', count(*) from nation anti join region on n_regionkey = r_regionkey union all select 'events without user', count(*) from events where user_id is null union all select 'vectors of another length', count(*) from embeddings where len(embedding) <> 64
 union all select 'turns out of order', count(*) from (select turn - row_number() over (partition by conv_id order by turn) d from conversations) where d <> -1""")
def invariants(t: Tables) -> DataFrame:
    return A.violations(
        {
            "orders without customer": t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left_anti"),
            "lines without order": t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti"),
            "repeated line numbers": t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
            "documents of wrong length": t.documents.where(F.col("n_chars") != F.length("text")),
            "labels without document": J.stranded(t.labels, t.documents, ["doc_id"]),
            "negative balances": t.customer.where("c_acctbal < 0"),
            "empty turns": t.conversations.where(F.coalesce("text", F.lit("")) == ""),
            "repeated documents": t.documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
            "labels out of range": t.labels.where("quality not in (0, 1) or toxic not in (0, 1)"),
            "documents without language": t.documents.where("lang is null"),
            "orders of another total": t.orders.where("o_totalprice <= 0"),
            "lines without supplier": t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left_anti"),
            "lines without part": t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left_anti"),
            "nations without region": t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left_anti"),
            "events without user": t.events.where("user_id is null"),
            "vectors of another length": t.embeddings.where(F.size("embedding") != 64),
            "turns out of order": t.conversations.select((F.col("turn") - F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))).alias("d")).where("d <> -1"),
        }
    )


_STAGES = ["view", "click", "signup", "purchase"]


@R.add("q70_funnel", "with f as (select user_id, " + ", ".join(f"bool_or(event_type = '{s}' and value > 40) {s}" for s in _STAGES) + " from events group by 1) " + " union all ".join(f"select {k} step, '{s}' stage, count(*) filter (where {s}) reached, count(*) filter (where {' and '.join(_STAGES[: k + 1])}) nested from f" for k, s in enumerate(_STAGES)))
def funnel(t: Tables) -> DataFrame:
    return A.funnel(t.events, "user_id", {s: (F.col("event_type") == s) & (F.col("value") > 40) for s in _STAGES})


#: Rules: (name, metric, op, low, high).
RULES = [("errors_rare", "error_share", "lte", None, 0.25), ("busy", "events", "gte", 100.0, None), ("mean_value", "mean_value", "in_range", 10.0, 60.0), ("users_known", "users", "exists", None, None), ("no_such", "nothing", "gte", 1.0, None), ("not_zero", "events", "ne", 0.0, None)]


@R.add("q71_rules_engine", """with m(metric, value) as (select 'error_share', count(*) filter (where event_type = 'error') / count(*)::double from events union all select 'events', count(*) from events union all select 'mean_value', avg(value) from events union all select 'users', count(distinct user_id) from events),
 r(name, metric, op, low, high) as (values """ + ", ".join(f"('{n}', '{m}', '{o}', {'null' if lo is None else lo}::double, {'null' if hi is None else hi}::double)" for n, m, o, lo, hi in RULES) + """)
 select name, metric, op, value, case when op = 'exists' then value is not null when value is null then null when op = 'gte' then value >= low when op = 'lte' then value <= high when op = 'ne' then value <> low when op = 'in_range' then value between low and high end ok, value is null vacuous from r left join m using (metric)""")
def rules_engine(t: Tables) -> DataFrame:
    m = t.events.agg((F.count_if(F.col("event_type") == "error") / F.count(F.lit(1))).alias("error_share"), F.count(F.lit(1)).cast("double").alias("events"), F.avg("value").alias("mean_value"), F.count_distinct("user_id").cast("double").alias("users"))
    metrics = m.unpivot([], ["error_share", "events", "mean_value", "users"], "metric", "value")
    rules = t.spark.createDataFrame(RULES, "name string, metric string, op string, low double, high double")
    return A.check_rules(metrics, rules)


@R.add("q72_slo_floors", """with d as (select date_trunc('day', ts) "day", count(*) n, count(*) filter (where event_type = 'error') / count(*)::double err from events group by 1), b as (select "day", 'events' floor_name, n::double observed, 330.0::double floor_value, 'MAJOR' severity from d where n < 330 union all select "day", 'error share', err, 0.2::double, 'CRITICAL' from d where err > 0.2)
 select *, row_number() over (order by case severity when 'CRITICAL' then 0 else 1 end, "day", floor_name) "order" from b""")
def slo_floors(t: Tables) -> DataFrame:
    """Breaches by severity; one row a day and floor, so the ordering window is over days."""
    d = t.events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.count(F.lit(1)).alias("n"), (F.count_if(F.col("event_type") == "error") / F.count(F.lit(1))).alias("err"))
    few = d.where("n < 330").select("day", F.lit("events").alias("floor_name"), F.col("n").cast("double").alias("observed"), F.lit(330.0).alias("floor_value"), F.lit("MAJOR").alias("severity"))
    bad = d.where("err > 0.2").select("day", F.lit("error share").alias("floor_name"), F.col("err").alias("observed"), F.lit(0.2).alias("floor_value"), F.lit("CRITICAL").alias("severity"))
    rank = F.when(F.col("severity") == "CRITICAL", 0).otherwise(1)
    return few.union(bad).withColumn("order", F.row_number().over(Window.orderBy(rank, "day", "floor_name")).cast("long"))


@R.add("q73_windows", """select 'tumbling' kind, date_trunc('hour', ts) start, event_type, count(*) n, count(*) filter (where event_type <> 'error') ok from events group by all
 union all select 'sliding', time_bucket(interval 30 minute, ts) - to_minutes(30 * i) s, event_type, count(*), count(*) filter (where event_type <> 'error') from events, range(0, 2) r(i) group by all""")
def windows(t: Tables) -> DataFrame:
    from quarryline.streaming.windows import windowed_counts

    rows = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    one = windowed_counts(rows, "1 hour").select(F.lit("tumbling").alias("kind"), "start", "event_type", "n", "ok")
    two = windowed_counts(rows, "1 hour", "30 minutes").select(F.lit("sliding").alias("kind"), "start", "event_type", "n", "ok")
    return one.union(two).withColumn("start", F.col("start").cast("timestamp_ntz"))


@R.add("q77_bitpack", "with p as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, case when l_partkey < 2048 and l_suppkey < 256 then ((l_partkey << 16) | (l_suppkey << 8) | (l_linenumber & 255))::bigint end packed from lineitem) select l_orderkey, l_partkey, l_suppkey, l_linenumber, packed, (packed >> 16) & 65535 part_back, packed & 255 line_back from p")
def bitpack(t: Tables) -> DataFrame:
    packed = N.pack_bits([(F.when(F.col("l_partkey") < 2048, F.col("l_partkey")), 16), (F.col("l_suppkey"), 8), (F.col("l_linenumber"), 8)])
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", packed.alias("packed"))
    part, _, line = N.unpack_bits(F.col("packed"), [16, 8, 8])
    return rows.withColumn("part_back", part).withColumn("line_back", line)


_FLOORS = [0.0, 1e3, 1e4, 1e5, 2e5, 4e5]


@R.add("q78_range_lookup", "with b(i, f) as (values " + ", ".join(f"({i}, {f}::double)" for i, f in enumerate(_FLOORS)) + ") select o_orderkey, max(i)::int band, 10.0::double * least(1.0::double, greatest(0.0::double, (ln(any_value(o_totalprice)) - ln(1000.0::double)) / (ln(500000.0::double) - ln(1000.0::double)))) score from orders join b on f <= o_totalprice where o_totalprice > 0 group by 1")
def range_lookup(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    return t.orders.where("o_totalprice > 0").select("o_orderkey", N.band(price, _FLOORS).alias("band"), N.log_score(price, F.lit(1e3), F.lit(5e5)).alias("score"))


@R.add("q79_currency", "with r(p, rate) as (values ('1-URGENT', 2.5::double), ('2-HIGH', 1.25::double), ('3-MEDIUM', 0.0::double)) select o_orderkey, case when rate > 0 then o_totalprice * rate end standards, case when rate > 0 then o_totalprice * rate / 2.5::double end back from orders left join r on p = o_orderpriority")
def currency(t: Tables) -> DataFrame:
    rates = t.spark.createDataFrame([("1-URGENT", 2.5), ("2-HIGH", 1.25), ("3-MEDIUM", 0.0)], "o_orderpriority string, rate double")
    standards = N.convert(F.col("o_totalprice"), F.col("rate"))
    return t.orders.join(rates, "o_orderpriority", "left").select("o_orderkey", standards.alias("standards"), (standards / 2.5).alias("back"))


@R.add("q86_even_spread", """with r as (select s_nationkey, s_suppkey, row_number() over (partition by s_nationkey order by s_suppkey) - 1 i, count(*) over (partition by s_nationkey) n from supplier) select s_nationkey, s_suppkey from r where i in (0, floor((n - 1) / 2.0::double + 0.5::double), n - 1)""")
def even_spread(t: Tables) -> DataFrame:
    return W.even_spread(t.supplier.select("s_nationkey", "s_suppkey"), ["s_nationkey"], ["s_suppkey"], 3)


@R.add("q87_bin_pack", """with recursive d as (select source, doc_id, n_chars // 100 units, row_number() over (partition by source order by n_chars // 100 desc, doc_id) i from documents where source is not null),
 r as (select source, 0::bigint i, null::bigint doc_id, null::bigint units, [0, 0, 0, 0]::bigint[] loads, null::bigint bin from (select distinct source from d) union all
 select d.source, d.i, d.doc_id, d.units, [loads[k] + case when k = list_position(loads, list_min(loads)) then d.units else 0 end for k in [1, 2, 3, 4]], list_position(loads, list_min(loads)) - 1 from r join d on d.source = r.source and d.i = r.i + 1)
 select source, doc_id, units, bin::int bin from r where i > 0""")
def bin_pack(t: Tables) -> DataFrame:
    """Longest first to the least loaded of four bins, by hundreds of characters."""
    return W.bin_pack(t.documents.where("source is not null").select("source", "doc_id", F.floor(F.col("n_chars") / 100).alias("units")), "source", "doc_id", "units", 4)

#: Floors over the tables: (metric, op, bound, severity).
STANDARDS = [
    ("orders", "gte", 1000, "MAJOR"), ("lines_per_order", "gte", 3.5, "MINOR"), ("customers_with_orders", "gte", 0.6, "MAJOR"), ("negative_balances", "lte", 0.05, "MINOR"), ("documents", "gte", 100, "CRITICAL"),
    ("mean_chars", "gte", 500, "MAJOR"), ("unlabelled", "lte", 0.5, "MAJOR"), ("toxic_share", "lte", 0.2, "MAJOR"), ("languages", "gte", 4, "MINOR"), ("sources", "gte", 10, "MINOR"), ("pages", "gte", 40, "MAJOR"), ("hosts", "gte", 10, "MINOR"),
    ("conversations", "gte", 50, "MINOR"), ("mean_turns", "gte", 3, "MINOR"), ("events", "gte", 1000, "MAJOR"), ("error_share", "lte", 0.15, "CRITICAL"), ("users", "gte", 200, "MINOR"), ("vectors", "gte", 100, "MINOR"), ("parts_sold", "gte", 0.9, "MAJOR"), ("suppliers", "gte", 10, "MINOR"),
]

_METRICS_SQL = """select 'orders' metric, count(*)::double "value" from orders union all select 'lines_per_order', count(*) / count(distinct l_orderkey)::double from lineitem union all select 'customers_with_orders', (select count(distinct o_custkey) from orders) / count(*)::double from customer
 union all select 'negative_balances', count(*) filter (where c_acctbal < 0) / count(*)::double from customer union all select 'documents', count(*) from documents union all select 'mean_chars', avg(n_chars) from documents union all select 'unlabelled', 1 - (select count(*) from labels) / count(*)::double from documents
 union all select 'toxic_share', avg(toxic) from labels union all select 'languages', count(distinct lang) from documents union all select 'sources', count(distinct source) from documents union all select 'pages', count(*) from pages union all select 'hosts', count(distinct regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) from pages
 union all select 'conversations', count(distinct conv_id) from conversations union all select 'mean_turns', count(*) / count(distinct conv_id)::double from conversations union all select 'events', count(*) from events union all select 'error_share', count(*) filter (where event_type = 'error') / count(*)::double from events
 union all select 'users', count(distinct user_id) from events union all select 'vectors', count(*) from embeddings union all select 'parts_sold', (select count(distinct l_partkey) from lineitem) / count(*)::double from part union all select 'suppliers', count(*) from supplier"""


@R.add("q217_standards", f"with m as ({_METRICS_SQL}), r(metric, op, bound, severity) as (values " + ", ".join(f"('{m}', '{o}', {b}::double, '{s}')" for m, o, b, s in STANDARDS) + """) select metric, round("value", 6) observed, bound, severity, case when op = 'gte' then "value" >= bound else "value" <= bound end held from r left join m using (metric)""")
def standards(t: Tables) -> DataFrame:
    """Twenty floors over all tables, each with what was observed and whether it held; each table is read once for its own."""
    count, share = F.count(F.lit(1)).cast("double"), lambda c: F.count_if(c) / F.count(F.lit(1))
    one = lambda df, **m: df.agg(*[e.cast("double").alias(k) for k, e in m.items()])
    line = one(t.lineitem, lines_per_order=F.count(F.lit(1)) / F.count_distinct("l_orderkey"), sold=F.count_distinct("l_partkey"))
    order = one(t.orders, orders=count, buyers=F.count_distinct("o_custkey"))
    people = one(t.customer, customers=count, negative_balances=share(F.col("c_acctbal") < 0))
    docs = one(t.documents, documents=count, mean_chars=F.avg("n_chars"), languages=F.count_distinct("lang"), sources=F.count_distinct("source"))
    rest = [
        one(t.labels, labels=count, toxic_share=F.avg("toxic")), one(t.pages, pages=count, hosts=F.count_distinct(T.url_host("url"))), one(t.conversations, conversations=F.count_distinct("conv_id"), mean_turns=F.count(F.lit(1)) / F.count_distinct("conv_id")),
        one(t.events, events=count, error_share=share(F.col("event_type") == "error"), users=F.count_distinct("user_id")), one(t.embeddings, vectors=count), one(t.part, parts=count), one(t.supplier, suppliers=count),
    ]
    row = line
    for other in (order, people, docs, *rest):
        row = row.crossJoin(other)  # one row each
    row = row.withColumns({"customers_with_orders": F.col("buyers") / F.col("customers"), "unlabelled": 1 - F.col("labels") / F.col("documents"), "parts_sold": F.col("sold") / F.col("parts")})
    metrics = row.unpivot([], [m for m, *_ in STANDARDS], "metric", "value")
    rules = t.spark.createDataFrame([(m, o, float(b), s) for m, o, b, s in STANDARDS], "metric string, op string, bound double, severity string")
    held = F.when(F.col("op") == "gte", F.col("value") >= F.col("bound")).otherwise(F.col("value") <= F.col("bound"))
    return rules.join(metrics, "metric", "left").select("metric", F.round("value", 6).alias("observed"), "bound", "severity", held.alias("held"))
