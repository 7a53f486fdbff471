"""Queries over the gates, bands, tiers, integrity checks and incremental rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions import gates as G
from quarryline.functions import numeric as N
from quarryline.functions import rules as K
from quarryline.functions import text as T
from quarryline.operators import joins as J
from quarryline.plans.base import Registry, Tables

R = Registry()

#: Sentences that a part's name is put into, one for each outcome of the evidence gate.
TEMPLATES = [
    "The {} destroyed two planets in a day",
    "The {} was destroyed on a far planet",
    "The {} crossed 40 light-years at once",
    "The {} is known as a breaker who shattered the moon",
    "Roll a saving throw against the {}, which razes the city",
    "A {} of no note at all",
    "{}",
    "Armies fled before the {} shattered their camp during the campaign",
]


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


@R.add("q88_evidence_gate", "with t(k, s) as (values " + ", ".join(f"({k}, '{s}')" for k, s in enumerate(TEMPLATES)) + f"""), n as (select p_partkey, trim(replace(s, '{{}}', p_name)) s from part join t on k = p_partkey % {len(TEMPLATES)})
 select p_partkey, case when length(s) < 8 then 'short' when regexp_matches(s, '{_sql(K.STATBLOCK)}') then 'mechanics' when regexp_matches(s, '{_sql(K.MAGNITUDE)}') then 'ok'
 when not (regexp_matches(s, '(?is){K.ACT}.{{0,70}}{K.OBJECT}') or regexp_matches(s, '(?is){K.OBJECT}.{{0,64}}{K.ACT}')) then 'no deed' when regexp_matches(s, '{_sql(K.PATIENT)}') then 'passive' when regexp_matches(s, '{_sql(K.REPUTATION)}') then 'reputation' else 'ok' end reason,
 regexp_matches(s, '{K.SETTING_META}') rephrase from n""")
def evidence_gate(t: Tables) -> DataFrame:
    template = F.element_at(F.array(*[F.lit(s) for s in TEMPLATES]), (F.col("p_partkey") % len(TEMPLATES) + 1).cast("int"))
    rows = t.part.select("p_partkey", F.trim(F.replace(template, F.lit("{}"), F.col("p_name"))).alias("s"))
    return rows.select("p_partkey", F.coalesce(G.evidence_reason(F.col("s")), F.lit("ok")).alias("reason"), G.needs_rephrase(F.col("s")).alias("rephrase"))


@R.add("q224_gate_of_texts", rf"""with n as (select doc_id, trim(unnest(regexp_extract_all(regexp_replace(text, '[^\x00-\x7F]', 'x', 'g'), '[^.!?]+'))) s from documents where text is not null),
 g as (select doc_id, case when length(s) < 8 then 'short' when regexp_matches(s, '{_sql(K.STATBLOCK)}') then 'mechanics' when regexp_matches(s, '{_sql(K.MAGNITUDE)}') then 'ok'
 when not (regexp_matches(s, '(?is){K.ACT}.{{0,70}}{K.OBJECT}') or regexp_matches(s, '(?is){K.OBJECT}.{{0,64}}{K.ACT}')) then 'no deed' when regexp_matches(s, '{_sql(K.PATIENT)}') then 'passive' when regexp_matches(s, '{_sql(K.REPUTATION)}') then 'reputation' else 'ok' end reason,
 regexp_matches(s, '{K.SETTING_META}') rephrase from n) select reason, rephrase, count(*) n, count(distinct doc_id) documents from g group by 1, 2""")
def gate_of_texts(t: Tables) -> DataFrame:
    """The evidence gate over every sentence of all texts: how many pass, and why the others do not."""
    plain = F.regexp_replace("text", r"[^\x00-\x7F]", "x")
    s = t.documents.where("text is not null").select("doc_id", F.explode(F.regexp_extract_all(plain, F.lit("[^.!?]+"), F.lit(0))).alias("s")).withColumn("s", F.trim("s"))
    told = s.select("doc_id", F.coalesce(G.evidence_reason(F.col("s")), F.lit("ok")).alias("reason"), G.needs_rephrase(F.col("s")).alias("rephrase"))
    return told.groupBy("reason", "rephrase").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("documents"))


_AXES = ["ruin", "reach", "celerity"]


def _score_sql(axis: str, x: str) -> str:
    f = K.FLOORS[axis]
    parts = " ".join(f"when band = 'M{k}' then round_even(10.0::double * least(1.0::double, greatest(0.0::double, (ln({x}) - ln({f[k]!r}::double)) / (ln({f[k + 1]!r}::double) - ln({f[k]!r}::double)))), 2)" for k in range(len(f) - 1))
    return f"case when {x} is null or {x} <= 0 then null {parts} end"


@R.add("q89_band_assay", "with x as (select o_orderkey, o_totalprice * 1e6 ruin, case when o_orderkey % 3 = 0 then null else o_totalprice / 10 end reach, o_totalprice / 1000 celerity from orders where o_totalprice > 0), b as (select *, 'M' || case " + " ".join(f"when ruin >= {f!r}::double then {k}" for k, f in reversed(list(enumerate(K.FLOORS["ruin"])))) + " end band from x where ruin >= 100), s as (select o_orderkey, band, " + ", ".join(f"{_score_sql(a, a)} s_{a}" for a in _AXES) + " from b) select o_orderkey, band, s_ruin, s_reach, s_celerity, substr(band, 2)::int + (" + " + ".join(f"coalesce(s_{a} * {K.WEIGHTS[a]!r}::double, 0)" for a in _AXES) + ") / (" + " + ".join(f"case when s_{a} is null then 0 else {K.WEIGHTS[a]!r}::double end" for a in _AXES) + ") / 10 composite from s")
def band_assay(t: Tables) -> DataFrame:
    x = t.orders.where("o_totalprice > 0").select("o_orderkey", (F.col("o_totalprice") * 1e6).alias("ruin"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice") / 10).alias("reach"), (F.col("o_totalprice") / 1000).alias("celerity")).where("ruin >= 100")
    rows = x.withColumn("band", G.band_of(F.col("ruin"), "ruin"))
    rows = rows.select("o_orderkey", "band", *[G.axis_score(F.col(a), F.col("band"), a).alias(f"s_{a}") for a in _AXES])
    return rows.withColumn("composite", G.composite({a: F.col(f"s_{a}") for a in _AXES}, F.col("band")))


@R.add("q90_tier_ratchet", """with c as (select l_suppkey, l_returnflag f, count(*) n from lineitem group by 1, 2), e as (select *, case when n * 4 >= 3000 then 'set' when n * 4 >= 900 then 'grand' when n * 4 >= 400 then 'series' else 'volume' end earned, case l_suppkey % 4 when 0 then 'grand' when 1 then 'kingdom' when 2 then null else 'volume' end cur from c),
 r as (select *, case earned when 'set' then 3 when 'grand' then 2 when 'series' then 1 else 0 end er, case cur when 'set' then 3 when 'grand' then 2 when 'series' then 1 when 'volume' then 0 end cr from e) select l_suppkey, f, n, case when coalesce(cr, -1) >= er then cur else earned end tier from r""")
def tier_ratchet(t: Tables) -> DataFrame:
    rows = t.lineitem.groupBy("l_suppkey", F.col("l_returnflag").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    k = F.col("l_suppkey") % 4
    current = F.when(k == 0, "grand").when(k == 1, "kingdom").when(k == 3, "volume")
    return rows.select("l_suppkey", "f", "n", G.promoted(current, F.col("n") * 4).alias("tier"))


@R.add("q91_well_formed")
def well_formed(t: Tables) -> DataFrame:
    words = t.documents.select(F.explode(T.tokens("text", 4)).alias("word")).distinct()
    return words.where("length(word) <= 11").groupBy(F.length("word").alias("letters")).agg(F.count(F.lit(1)).alias("words"), F.count_if(G.well_formed(F.col("word"))).alias("sayable"))


@R.add("q92_designators", """with n as (select p_partkey, p_name || ' (' || p_type || '/x)' nm, p_name base from part), d as (select base, lower(trim(split_part(regexp_extract(nm, '\\(([^)]*)\\)', 1), '/', 1))) d from n) select d designator, count(distinct base) bearers from d where length(d) between 2 and 39 group by 1 having count(distinct base) >= 3""")
def designators(t: Tables) -> DataFrame:
    names = t.part.select(F.concat("p_name", F.lit(" ("), "p_type", F.lit("/x)")).alias("name"))
    rows = names.select(T.split_qualifier("name")["base"].alias("base"), G.designator(F.col("name")).alias("designator")).where("designator is not null")
    return rows.groupBy("designator").agg(F.count_distinct("base").alias("bearers")).where("bearers >= 3")


@R.add("q93_cohorts", """with c as (select s_suppkey, case when s_suppkey % 17 = 0 then null else 'C' || (s_nationkey % 5) || '.' || chr((65 + s_nationkey % 3)::int) || '.' || s_suppkey end code, s_nationkey, s_acctbal > 0 room from supplier), f as (select *, array_to_string(string_split(code, '.')[1:2], '.') family from c), n as (select family, room, count(*) n from f where code is not null group by 1, 2), t3 as (select n_nationkey k, count(*) curated from nation join region on n_regionkey = r_regionkey where n_nationkey % 4 = 0 group by 1)
 select f.s_suppkey, f.family, case when code is null then 'unaddressed' when n.n = 1 then 'unmatched' else 'cohort' end state, coalesce(n.n - 1, 0) t2, coalesce(curated, 0) t3 from f left join n on n.family = f.family and n.room = f.room left join t3 on k = s_nationkey""")
def cohorts(t: Tables) -> DataFrame:
    """Shelf cohorts: one two-part family that shares a room. The graph stores each entry's degree by class and not its pairs; entries without an address, and those without a cohort, are told."""
    address = F.concat(F.lit("C"), (F.col("s_nationkey") % 5).cast("string"), F.lit("."), F.char(65 + F.col("s_nationkey") % 3), F.lit("."), F.col("s_suppkey").cast("string"))
    code = F.when(F.col("s_suppkey") % 17 != 0, address)
    f = t.supplier.select("s_suppkey", "s_nationkey", G.cohort(code).alias("family"), (F.col("s_acctbal") > 0).alias("room"))
    n = f.where("family is not null").groupBy("family", "room").agg(F.count(F.lit(1)).alias("n"))
    curated = t.nation.where("n_nationkey % 4 = 0").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi").groupBy(F.col("n_nationkey").alias("s_nationkey")).agg(F.count(F.lit(1)).alias("t3"))
    rows = f.join(n, ["family", "room"], "left").join(curated, "s_nationkey", "left")
    state = F.when(F.col("family").isNull(), "unaddressed").when(F.col("n") == 1, "unmatched").otherwise("cohort")
    return rows.select("s_suppkey", "family", state.alias("state"), F.coalesce(F.col("n") - 1, F.lit(0)).alias("t2"), F.coalesce("t3", F.lit(0)).alias("t3"))


@R.add("q94_denominators", """with k as (select c_nationkey n, c_mktsegment m, count(*) c from customer group by 1, 2), d as (select n, max(c) denominator, sum(c)::bigint total from k group by 1), s as (select s_nationkey n, count(*) have from supplier group by 1)
 select coalesce(d.n, s.n) nation, have, denominator, have / denominator::double coverage, case when have is null then 'no record' when denominator is null then 'unreachable' when have > denominator then 'over' else 'ok' end reason from d full join s on d.n = s.n""")
def denominators(t: Tables) -> DataFrame:
    """Coverage against the largest category, with the reason a row cannot be relied on."""
    k = t.customer.groupBy(F.col("c_nationkey").alias("nation"), "c_mktsegment").agg(F.count(F.lit(1)).alias("c")).groupBy("nation").agg(F.max("c").alias("denominator"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("have"))
    rows = k.join(s, "nation", "full_outer")
    reason = F.when(F.col("have").isNull(), "no record").when(F.col("denominator").isNull(), "unreachable").when(F.col("have") > F.col("denominator"), "over").otherwise("ok")
    return rows.select("nation", "have", "denominator", (F.col("have") / F.col("denominator")).alias("coverage"), reason.alias("reason"))


@R.add("q95_partial_names", """with f as (select distinct p_name name from part), p as (select name, unnest(string_split(name, ' ')) partial from f), u as (select partial, min(name) name from p group by 1 having count(distinct name) = 1)
 select name as key, name, 'full' how from f union all select partial, name, 'partial' from u where partial not in (select name from f)""")
def partial_names(t: Tables) -> DataFrame:
    """Full names, and the words that only one name has; a full name wins over a partial one."""
    full = t.part.select("p_name").distinct().select(F.col("p_name").alias("key"), F.col("p_name").alias("name"), F.lit("full").alias("how"))
    words = full.select("name", F.explode(F.split("name", " ")).alias("key")).distinct()
    single = words.groupBy("key").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("n")).where("n = 1").select("key", "name", F.lit("partial").alias("how"))
    return full.union(single.join(full.select("key"), "key", "left_anti").select("key", "name", "how"))


@R.add("q96_expiring_rules", """with r(detector, pat, expires) as (values ('dup', 'src1*', timestamp '2024-02-01'), ('short', 'src2', timestamp '2024-01-02'), ('short', '*', null)), n as (select max(ts) now from events)
 select d.doc_id, r.detector, case when expires is null then 'UNBOUNDED' when expires <= now then 'EXPIRED' else 'active' end state from documents d join r on regexp_matches(d.source, '^' || replace(pat, '*', '.*') || '$'), n""")
def expiring_rules(t: Tables) -> DataFrame:
    """Exceptions by glob with a time to live; the rule table is a fixed list."""
    rules = [("dup", "src1*", "2024-02-01"), ("short", "src2", "2024-01-02"), ("short", "*", None)]
    now = t.events.agg(F.max("ts").alias("now"))
    hits = F.array_compact(
        F.array(*[F.when(F.col("source").rlike("^" + g.replace("*", ".*") + "$"), F.struct(F.lit(d).alias("detector"), F.lit(e).cast("timestamp_ntz").alias("expires"))) for d, g, e in rules])
    )
    rows = t.documents.select("doc_id", F.explode(hits).alias("r")).crossJoin(now)  # now is one row
    state = F.when(F.col("r.expires").isNull(), "UNBOUNDED").when(F.col("r.expires") <= F.col("now"), "EXPIRED").otherwise("active")
    return rows.select("doc_id", "r.detector", state.alias("state"))


@R.add("q97_json_rules", """select event_type, count(*) filter (where (props->>'$.k')::int >= 50) gte, count(*) filter (where props->>'$.k' is null) absent, count(*) filter (where (props->>'$.k')::int between 10 and 20) in_range, count(*) filter (where regexp_matches(props->>'$.k', '^7')) matches from events group by 1""")
def json_rules(t: Tables) -> DataFrame:
    """Data-driven rules on a dotted path into a document."""
    v = F.get_json_object("props", "$.k")
    k = v.cast("int")
    return t.events.groupBy("event_type").agg(F.count_if(k >= 50).alias("gte"), F.count_if(v.isNull()).alias("absent"), F.count_if(k.between(10, 20)).alias("in_range"), F.count_if(v.rlike("^7")).alias("matches"))


@R.add("q98_scrub", f"""with s as (select doc_id, text, regexp_replace(regexp_replace(text, '{_sql(K.SECRET)}', '[REDACTED]', 'g'), '{_sql(G.SECRET_VALUE)}', '\\1[REDACTED]', 'g') scrubbed from documents) select doc_id, scrubbed from s where scrubbed <> text""")
def scrubbed(t: Tables) -> DataFrame:
    """Texts with their credentials redacted: known shapes, and values of assignments to credential names."""
    return t.documents.select("doc_id", "text", G.scrub(F.col("text")).alias("scrubbed")).where("scrubbed <> text").drop("text")


@R.add("q99_missing_runs", """with a as (select unnest(range(0, 200)) part), c as (select distinct p_partkey % 200 part from part where p_partkey % 7 <> 0 union select distinct l_partkey % 200 from lineitem where l_linenumber = 7 and l_quantity > 49.5 and l_tax > 0.07) select a.part from a anti join c using (part)""")
def missing_runs(t: Tables) -> DataFrame:
    """A universe less the union of what shards covered."""
    universe = t.spark.range(200).select(F.col("id").alias("part"))
    covered = t.part.where("p_partkey % 7 <> 0").select((F.col("p_partkey") % 200).alias("part")).union(t.lineitem.where("l_linenumber = 7 and l_quantity > 49.5 and l_tax > 0.07").select((F.col("l_partkey") % 200).alias("part")))
    return J.stranded(universe, covered, ["part"])


@R.add("q100_drift", """with a as (select c_custkey k, c_name v from customer where c_custkey % 9 <> 0), b as (select c_custkey k, case when c_custkey % 8 = 0 then 'changed' else c_name end v from customer where c_custkey % 10 <> 0)
 select coalesce(a.k, b.k) k, case when a.k is null then 'added' when b.k is null then 'deleted' else 'changed' end state from a full join b using (k) where a.v is distinct from b.v""")
def drift(t: Tables) -> DataFrame:
    """Two manifests of (key, content) against each other."""
    c = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    a = c.where("k % 9 <> 0").withColumnRenamed("v", "x")
    b = c.where("k % 10 <> 0").select("k", F.when(F.col("k") % 8 == 0, "changed").otherwise(F.col("v")).alias("y"))
    state = F.when(F.col("x").isNull(), "added").when(F.col("y").isNull(), "deleted").otherwise("changed")
    return a.join(b, "k", "full_outer").where(~F.col("x").eqNullSafe(F.col("y"))).select("k", state.alias("state"))


@R.add("q101_return_level", """with g as (select p_brand, max(p_retailprice) m, count(*) filter (where p_size > 10) n, count(*) total from part group by 1) select p_brand, case when n > 0 and total >= n then m + log2(total / n::double) / 2 end level, n / total::double confidence from g""")
def return_level(t: Tables) -> DataFrame:
    g = t.part.groupBy("p_brand").agg(F.max("p_retailprice").alias("m"), F.count_if(F.col("p_size") > 10).alias("n"), F.count(F.lit(1)).alias("total"))
    return g.select("p_brand", N.return_level(F.col("m"), F.col("n"), F.col("total"), 2.0).alias("level"), (F.col("n") / F.col("total")).alias("confidence"))


@R.add("q102_rank_size", """with r as (select s_suppkey, unnest(range(1, 21)) k from supplier), p as (select s_suppkey, k, 100000.0::double / k p from r) select case when p >= 50000 then 'city' when p >= 10000 then 'town' else 'village' end class, count(*) n, sum(p) people from p group by 1""")
def rank_size(t: Tables) -> DataFrame:
    """Rank-size law: the k-th settlement has a k-th of the largest's people."""
    rows = t.supplier.select("s_suppkey", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("k")).select((F.lit(100_000.0) / F.col("k")).alias("p"))
    size = F.when(F.col("p") >= 50_000, "city").when(F.col("p") >= 10_000, "town").otherwise("village")
    return rows.groupBy(size.alias("class")).agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("people"))


@R.add("q103_roll_numbers", r"""select n_nationkey, row_number() over (order by regexp_replace(regexp_replace(lower('The ' || n_name), '^(the|a|an) ', ''), '[^a-z0-9 ]', '', 'g'), n_nationkey) seq from nation""")
def roll_numbers(t: Tables) -> DataFrame:
    """Numbering by a folded sort key, for dimension tables (one row a source)."""
    key = F.regexp_replace(F.regexp_replace(F.lower(F.concat(F.lit("The "), F.col("n_name"))), "^(the|a|an) ", ""), "[^a-z0-9 ]", "")
    return t.nation.select("n_nationkey", F.row_number().over(Window.orderBy(key, "n_nationkey")).cast("long").alias("seq"))


@R.add("q104_shared_address", """with a as (select o_orderkey, o_custkey || '-' || strftime(o_orderdate, '%Y-%m') addr, o_orderpriority from orders), c as (select addr from a group by addr having count(distinct o_orderpriority) > 1) select o_orderkey, addr, addr in (select addr from c) held from a""")
def shared_address(t: Tables) -> DataFrame:
    """Jobs are held while their address is claimed by more than one source."""
    a = t.orders.select("o_orderkey", F.concat_ws("-", F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM")).alias("addr"), "o_orderpriority")
    claims = a.groupBy("addr").agg((F.count_distinct("o_orderpriority") > 1).alias("held"))
    return a.join(claims, "addr").select("o_orderkey", "addr", "held")


@R.add("q105_sessions", """with o as (select user_id, ts, case when ts - lag(ts) over w > interval 6 hour or lag(ts) over w is null then 1 else 0 end new from events window w as (partition by user_id order by ts)), s as (select *, sum(new) over (partition by user_id order by ts) k from o) select user_id, min(ts) start, max(ts) + interval 6 hour "end", count(*) n from s group by user_id, k""")
def session_windows(t: Tables) -> DataFrame:
    from quarryline.streaming.windows import sessions

    out = sessions(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "6 hours")
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@R.add("q218_paths", """with j as (select event_id, '{"a": {"b": [{"c": ' || (event_id % 50) || '}, {"c": "x"}]}, "k": ' || props || '}' doc from events) select event_id, doc->>'$.a.b[0].c' first, doc->>'$.a.b[1].c' other, doc->>'$.a.b[2].c' third, doc->>'$.k.k' inner_k from j""")
def paths(t: Tables) -> DataFrame:
    """Dotted paths through objects and lists of a document; what is not there is null."""
    doc = F.concat(F.lit('{"a": {"b": [{"c": '), (F.col("event_id") % 50).cast("string"), F.lit('}, {"c": "x"}]}, "k": '), "props", F.lit("}"))
    at = lambda path, name: F.get_json_object("doc", f"$.{path}").alias(name)
    return t.events.select("event_id", doc.alias("doc")).select("event_id", at("a.b[0].c", "first"), at("a.b[1].c", "other"), at("a.b[2].c", "third"), at("k.k", "inner_k"))
