"""Catalogue queries: lookups, resolution, integrity, citations, weights, work queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions import catalogue as C
from quarryline.functions import gates as G
from quarryline.functions import numeric as N
from quarryline.functions import text as T
from quarryline.operators import aggregates as A
from quarryline.operators import graph as GR
from quarryline.operators import joins as J
from quarryline.operators import weights as WT
from quarryline.plans.base import Registry, Tables
from quarryline.plans.measures import LINK, components_sql

R = Registry()


@R.add("q106_clean_titles", r"""with t as (select distinct page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) title from pages), k as (select *, trim(regexp_replace(title, '\s+', ' ', 'g')) clean from t where not contains(title, '/') and not regexp_matches(title, '^(List of|Category:)|\(disambiguation\)'))
 select clean title, min(page_id) first_page, count(*) n from k where clean <> '' group by 1""")
def clean_titles(t: Tables) -> DataFrame:
    """Titles without subpages, lists and disambiguations, each by its first page."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    rows = t.pages.select("page_id", title.alias("title")).distinct().where(~F.contains("title", F.lit("/")) & ~F.col("title").rlike(r"^(List of|Category:)|\(disambiguation\)"))
    return rows.select("page_id", F.trim(F.regexp_replace("title", r"\s+", " ")).alias("title")).where("title <> ''").groupBy("title").agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))


@R.add("q107_floor_gate", """with s as (select source, count(*) filter (where quality is not null) judged, count(*) filter (where quality = 1) good from documents left join labels using (doc_id) group by 1)
 select source, case when judged > 0 then good / judged::double end fraction, coalesce(case when judged > 0 then good / judged::double end >= 0.85::double, false) ok, case when judged = 0 then 'unmeasured' when good / judged::double >= 0.85::double then 'ok' else 'below floor' end reason from s""")
def floor_gate(t: Tables) -> DataFrame:
    """A ratio against a floor; what was not measured is refused."""
    s = t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left").groupBy("source").agg(F.count("quality").alias("judged"), F.count_if(F.col("quality") == 1).alias("good"))
    fraction = A.ratio(F.col("good"), F.col("judged"))
    reason = F.when(fraction.isNull(), "unmeasured").when(fraction >= 0.85, "ok").otherwise("below floor")
    return s.select("source", fraction.alias("fraction"), F.coalesce(fraction >= 0.85, F.lit(False)).alias("ok"), reason.alias("reason"))


@R.add("q108_lead", r"""with p as (select doc_id, list_filter(string_split(text, E'\n'), lambda s: length(s) >= 60 and not contains(s, '|')) l from documents), b as (select doc_id, l[1] s from p where len(l) > 0)
 select doc_id, case when length(s) <= 420 then s when regexp_extract(left(s, 420), '^(?s)(.{120,}[.!?])[^.!?]*$', 1) <> '' then regexp_extract(left(s, 420), '^(?s)(.{120,}[.!?])[^.!?]*$', 1) else left(s, 420) end lead from b""")
def lead(t: Tables) -> DataFrame:
    """The first block of prose, cut at a sentence end between 120 and 420 characters."""
    blocks = F.filter(F.split("text", "\n"), lambda s: (F.length(s) >= 60) & ~F.contains(s, F.lit("|")))
    rows = t.documents.select("doc_id", F.get(blocks, F.lit(0)).alias("s")).where("s is not null")
    head = F.left("s", F.lit(420))
    whole = F.regexp_extract(head, r"^(?s)(.{120,}[.!?])[^.!?]*$", 1)
    return rows.select("doc_id", F.when(F.length("s") <= 420, F.col("s")).when(whole != "", whole).otherwise(head).alias("lead"))


@R.add("q109_pair_states", """with e as (select s_nationkey k from supplier group by 1 having count(*) >= 2), p(a, b) as (select x.k, y.n_nationkey from e x join nation y on x.k < y.n_nationkey and y.n_nationkey < x.k + 4), r as (select distinct n_nationkey a, (n_nationkey * 2) % 25 b from nation)
 select p.a, p.b, case when p.b not in (select k from e) then 'DANGLING' when f.a is not null and g.a is not null then 'RECIPROCAL' when f.a is not null or g.a is not null then 'ASYMMETRIC' else 'UNRECORDED' end state from p left join r f on f.a = p.a and f.b = p.b left join r g on g.a = p.b and g.b = p.a""")
def pair_states(t: Tables) -> DataFrame:
    """Implied pairs against entities and recorded edges of either direction."""
    e = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("k")
    p = e.select(F.col("k").alias("a"), F.explode(F.sequence(F.col("k") + 1, F.col("k") + 3)).alias("b")).join(t.nation.select(F.col("n_nationkey").alias("b")), "b")
    r = t.nation.select(F.col("n_nationkey").alias("a"), (F.col("n_nationkey") * 2 % 25).alias("b")).distinct()
    out = p.join(e.select(F.col("k").alias("b"), F.lit(True).alias("known")), "b", "left").join(r.withColumn("f", F.lit(True)), ["a", "b"], "left").join(r.select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit(True).alias("g")), ["a", "b"], "left")
    state = F.when(F.col("known").isNull(), "DANGLING").when(F.col("f").isNotNull() & F.col("g").isNotNull(), "RECIPROCAL").when(F.col("f").isNotNull() | F.col("g").isNotNull(), "ASYMMETRIC").otherwise("UNRECORDED")
    return out.select("a", "b", state.alias("state"))


@R.add("q110_lossy_key", """with a as (select p_partkey, p_name, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g')[1:8] stem from part), b as (select distinct p_name owner, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g')[1:8] stem from part)
 select p_partkey, count(*) candidates, count(*) filter (where owner = p_name) owned from a join b using (stem) group by 1""")
def lossy_key(t: Tables) -> DataFrame:
    """A join on a lossy stem, then the exact owner among the candidates."""
    a = t.part.select("p_partkey", "p_name", C.stem("p_name", 8).alias("stem"))
    b = t.part.select(F.col("p_name").alias("owner"), C.stem("p_name", 8).alias("stem")).distinct()
    return a.join(b, "stem").groupBy("p_partkey").agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("owner") == F.col("p_name")).alias("owned"))


@R.add("q111_wide_sweep", """with r as (select p_brand, max_by(p_partkey, p_retailprice * 1000000 - p_partkey) top from part group by 1), l as (select l_partkey, count(*) n from lineitem group by 1)
 select p.p_partkey, n_name, coalesce(l.n, 0) lines, top = p.p_partkey is_top from part p left join l on l.l_partkey = p.p_partkey left join supplier on s_suppkey = p.p_partkey % 100 left join nation on n_nationkey = s_nationkey left join r on r.p_brand = p.p_brand""")
def wide_sweep(t: Tables) -> DataFrame:
    """Persons, host, evidence and rank in one wide left join; the measures are aggregated before they join."""
    lines = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    top = t.part.groupBy("p_brand").agg(F.max_by("p_partkey", F.col("p_retailprice") * 1_000_000 - F.col("p_partkey")).alias("top"))
    host = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "n_name")
    rows = t.part.join(lines, "p_partkey", "left").join(host, F.col("p_partkey") % 100 == F.col("s_suppkey"), "left").join(top, "p_brand", "left")
    return rows.select("p_partkey", "n_name", F.coalesce("n", F.lit(0)).alias("lines"), (F.col("top") == F.col("p_partkey")).alias("is_top"))


@R.add("q112_reconcile", """with h as (select distinct source from documents where lang = 'es'), s as (select source, count(*) n from documents where lang = 'de' group by 1 having count(*) > 10)
 select coalesce(h.source, s.source) source, case when h.source is null then 'no host' when s.source is null then 'orphan' else 'both' end state, n from h full join s on h.source = s.source""")
def reconcile(t: Tables) -> DataFrame:
    h = t.documents.where("lang = 'es'").select("source", F.lit(True).alias("h")).distinct()
    s = t.documents.where("lang = 'de'").groupBy("source").agg(F.count(F.lit(1)).alias("n")).where("n > 10")
    return h.join(s, "source", "full_outer").select("source", F.when(F.col("h").isNull(), "no host").when(F.col("n").isNull(), "orphan").otherwise("both").alias("state"), "n")


@R.add("q113_first_evidence", "select o_orderkey, coalesce(a.v, b.v, 'none') evidence from orders left join (select l_orderkey k, strftime(max(l_shipdate), '%Y-%m-%d') v from lineitem where l_returnflag = 'R' group by 1) a on a.k = o_orderkey left join (select l_orderkey k, 'line ' || min(l_linenumber) v from lineitem group by 1) b on b.k = o_orderkey")
def first_evidence(t: Tables) -> DataFrame:
    """The first source that has evidence wins."""
    both = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.date_format(F.max(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))), "yyyy-MM-dd").alias("a"), F.concat(F.lit("line "), F.min("l_linenumber").cast("string")).alias("b"))
    return t.orders.select("o_orderkey").join(both, "o_orderkey", "left").select("o_orderkey", F.coalesce("a", "b", F.lit("none")).alias("evidence"))


@R.add("q114_citations", """with b as (select item_id, text, string_split(lower(text), ' ')[2:9] w from benchmark), c as (select item_id, array_to_string(w, ' ') cited from b), m as (select c.item_id, count(*) n, min(b.item_id) hit from c join b on contains(lower(b.text), cited) group by 1)
 select item_id, case when n = 1 then hit end resolved, case when n = 1 then 'contained' else 'ambiguous' end how from m""")
def citations(t: Tables) -> DataFrame:
    """A cited run of words against the lines that hold it: only a single holder resolves it."""
    w = F.split(F.lower("text"), " ")
    cited = t.benchmark.select("item_id", F.array_join(F.slice(w, 2, 8), " ").alias("cited"), F.get(w, F.lit(2)).alias("token"))
    lines = t.benchmark.select(F.col("item_id").alias("hit"), F.lower("text").alias("line"), F.explode(F.array_distinct(w)).alias("token"))
    hits = cited.join(lines, "token").where(F.contains("line", "cited")).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.min("hit").alias("hit"))
    return hits.select("item_id", F.when(F.col("n") == 1, F.col("hit")).alias("resolved"), F.when(F.col("n") == 1, "contained").otherwise("ambiguous").alias("how"))


@R.add("q115_redirects", """with recursive r as (select n_nationkey a, case when n_nationkey % 3 = 0 then n_nationkey + 1 when n_nationkey % 3 = 1 and n_nationkey < 20 then n_nationkey + 4 end b from nation), w(origin, spot, hops) as (select a, a, 0 from r union all select w.origin, r.b, w.hops + 1 from w join r on r.a = w.spot where r.b is not null), e as (select *, row_number() over (partition by origin order by hops desc) i from w)
 select origin, spot target, hops::bigint hops from e where i = 1""")
def redirects(t: Tables) -> DataFrame:
    """Redirect chains followed to their end, however long."""
    k = F.col("n_nationkey")
    onward = F.when(k % 3 == 0, k + 1).when((k % 3 == 1) & (k < 20), k + 4)
    way = GR.follow(t.nation.select(k.alias("a"), onward.alias("b")).where("b is not null"))
    return t.nation.select(k.alias("origin")).join(way, F.col("node") == F.col("origin"), "left").select("origin", F.coalesce("end", "origin").alias("target"), F.coalesce("hops", F.lit(0)).cast("long").alias("hops"))


@R.add("q116_continuities", """with n as (select p_partkey, p_name base, p_type d from part), i as (select d, count(distinct base) bearers from n group by 1 having count(distinct base) >= 3) select p_partkey, base, case when i.d is not null then base || '@' || lower(replace(n.d, ' ', '-')) else base end node from n left join i using (d)""")
def continuities(t: Tables) -> DataFrame:
    """A title's parenthetical names a continuity only if the inventory has it."""
    name = F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))
    parts = T.split_qualifier(name)
    rows = t.part.select("p_partkey", parts["base"].alias("base"), parts["qualifier"].alias("d"))
    inventory = rows.groupBy("d").agg(F.count_distinct("base").alias("bearers")).where("bearers >= 3").select("d", F.lit(True).alias("known"))
    node = F.when(F.col("known"), F.concat("base", F.lit("@"), F.lower(F.replace("d", F.lit(" "), F.lit("-"))))).otherwise(F.col("base"))
    return rows.join(inventory, "d", "left").select("p_partkey", "base", node.alias("node"))


@R.add("q117_line_citations", r"""with l as (select doc_id, len(string_split(text, E'\n')) n, string_split(text, E'\n') x from documents), c as (select doc_id, doc_id % 12 + 1 line from documents), j as (select c.doc_id, c.line, n, x[c.line] content from c join l using (doc_id))
 select doc_id, line, case when line > n then 'PAST_EOF' when trim(content) = '' then 'BLANK' else 'ok' end state from j""")
def line_citations(t: Tables) -> DataFrame:
    """file:line citations against the files' lines."""
    lines = F.split("text", "\n")
    rows = t.documents.select("doc_id", (F.col("doc_id") % 12 + 1).alias("line"), F.size(lines).alias("n"), F.get(lines, (F.col("doc_id") % 12).cast("int")).alias("content"))
    return rows.select("doc_id", "line", F.when(F.col("line") > F.col("n"), "PAST_EOF").when(F.trim("content") == "", "BLANK").otherwise("ok").alias("state"))


@R.add("q118_by_folder", "select split_part(regexp_replace(url, '^[a-z]+://[^/]+/', ''), '/', 1) folder, count(*) files, sum(length(html))::bigint bytes, count(*) filter (where not contains(html, '</html>')) bad from pages group by 1")
def by_folder(t: Tables) -> DataFrame:
    folder = F.split_part(F.regexp_replace("url", "^[a-z]+://[^/]+/", ""), F.lit("/"), F.lit(1))
    return t.pages.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"), F.sum(F.length("html")).alias("bytes"), F.count_if(~F.contains("html", F.lit("</html>"))).alias("bad"))


@R.add("q119_profile_codec", "select p_partkey, upper(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) || '-' || p_size || '-' || length(p_name) code, p_size size_back, length(p_name)::int name_back from part")
def profile_codec(t: Tables) -> DataFrame:
    """Fields in one string and back."""
    code = C.encode_profile([F.upper(F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")), F.col("p_size"), F.length("p_name")])
    rows = t.part.select("p_partkey", code.alias("code"))
    _, size, name = C.decode_profile(F.col("code"), 3)
    return rows.select("p_partkey", "code", size.cast("int").alias("size_back"), name.cast("int").alias("name_back"))


@R.add("q120_first_rule", """select p_partkey, case when regexp_matches(p_name, 'anvil|rod') then 'iron' when regexp_matches(p_type, 'BRASS|COPPER') then 'metal' else ['plain', 'hill', 'sea'][(('0x' || substr(sha256(p_partkey::varchar || 'axis'), 1, 8))::bigint % 3 + 1)::int] end feature, case when regexp_matches(p_name, 'anvil|rod') or regexp_matches(p_type, 'BRASS|COPPER') then 'text' else 'hash' end provenance from part""")
def first_rule(t: Tables) -> DataFrame:
    """The first rule of an ordered table that matches, else a hashed default; with its provenance."""
    value, how = C.first_match([(F.col("p_name"), "anvil|rod", "iron"), (F.col("p_type"), "BRASS|COPPER", "metal")], ["plain", "hill", "sea"], F.concat(F.col("p_partkey").cast("string"), F.lit("axis")))
    return t.part.select("p_partkey", value.alias("feature"), how.alias("provenance"))


@R.add("q121_coined_names")
def coined_names(t: Tables) -> DataFrame:
    """Names from hashed syllables, unique by salted retries; what stays doubled gets a tail of its digest."""
    return C.coin_names(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("seed")))


@R.add("q122_lognormal", """select p_brand, sum(log10(p_retailprice)) / count(*) + log10(3.0::double) median, sqrt(var_pop(log10(p_retailprice)) + 0.04::double + 2 * 0.3::double * sqrt(var_pop(log10(p_retailprice))) * 0.2::double) dex from part group by 1""")
def lognormal(t: Tables) -> DataFrame:
    """Median and spread (in powers of ten) of a product of two factors that correlate."""
    g = t.part.groupBy("p_brand").agg(F.avg(F.log10("p_retailprice")).alias("m"), F.stddev_pop(F.log10("p_retailprice")).alias("s"))
    median, dex = N.lognormal_product([(F.col("m"), F.col("s")), (F.log10(F.lit(3.0)), F.lit(0.2))], 0.3)
    return g.select("p_brand", median.alias("median"), dex.alias("dex"))


@R.add("q123_truth_table", """with p as (select user_id, bool_or(event_type = 'purchase') a, case when count(*) filter (where event_type = 'error') > 0 then bool_or(event_type = 'error' and value > 90) end b, count(*) > 50 c from events group by 1)
 select user_id, case when not c then 'UNREACHABLE' when a and b is null then 'UNCHECKED' when a and not b then 'CONFIRMED' when a and b then 'INDISCRIMINATE' else 'ABSENT' end verdict from p""")
def truth_table(t: Tables) -> DataFrame:
    """Three probes of true, false or not run: a verdict of each combination."""
    error = F.col("event_type") == "error"
    p = t.events.groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("a"), F.bool_or(F.when(error, F.col("value") > 90)).alias("b"), (F.count(F.lit(1)) > 50).alias("c"))
    return p.select("user_id", C.probe_verdict(F.col("a"), F.col("b"), F.col("c")).alias("verdict"))


R.add("q124_strong_components")(lambda t: WT.strong_components(_defeats(t)))


def _defeats(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").cast("long").alias("a"), ((F.col("n_nationkey") * 3 + 1) % 25).cast("long").alias("b")).union(t.nation.where("n_nationkey < 6").select(((F.col("n_nationkey") + 1) % 6).cast("long"), F.col("n_nationkey").cast("long")))


@R.add("q125_pairwise_weights")
def pairwise_weights(t: Tables) -> DataFrame:
    """Weights of criteria from a reciprocal comparison matrix a customer segment: principal vector, its consistency, log means."""
    price = t.customer.groupBy("c_mktsegment", F.col("c_nationkey").alias("i")).agg(F.avg("c_acctbal").alias("v"))
    pairs = price.alias("x").join(price.alias("y"), "c_mktsegment").select("c_mktsegment", F.col("x.i").alias("i"), F.col("y.i").alias("j"), (F.col("x.v") / F.col("y.v")).alias("ratio")).where("ratio > 0")
    return WT.principal_weights(pairs, "c_mktsegment")


@R.add("q126_nested_cuts", " union all ".join(f"select * from ({components_sql(LINK * share, f', {k} cut')})" for k, share in enumerate((0.8, 1.0, 1.2))))
def nested_cuts(t: Tables) -> DataFrame:
    """Components of one graph at several thresholds; a finer cut refines a coarser one."""
    from quarryline.plans.measures import _graph

    g = _graph(t)
    out = None
    for k, share in enumerate((0.8, 1.0, 1.2)):
        one = GR.components(g, LINK * share).withColumn("cut", F.lit(k))
        out = one if out is None else out.union(one)
    return out


@R.add("q127_orders_upsert", """with o as (select user_id::varchar id, min(ts) first_seen, max(ts) last_seen, count(*) seen from events where event_type = 'error' group by 1), c as (select user_id::varchar id, max(ts) resolved_at from events where event_type = 'purchase' group by 1)
 select o.id, seen, case when resolved_at > last_seen then 'closed' else 'open' end state, case when seen >= 20 then 'MAJOR' else 'MINOR' end severity from o left join c using (id)""")
def orders_upsert(t: Tables) -> DataFrame:
    """Work orders keyed by fault: seen counters, closed when resolved after the last sighting."""
    error, fixed = F.col("event_type") == "error", F.col("event_type") == "purchase"
    o = t.events.groupBy(F.col("user_id").cast("string").alias("id")).agg(F.max(F.when(error, F.col("ts"))).alias("last_seen"), F.count_if(error).alias("seen"), F.max(F.when(fixed, F.col("ts"))).alias("resolved_at")).where("seen > 0")
    return o.select("id", "seen", F.when(F.col("resolved_at") > F.col("last_seen"), "closed").otherwise("open").alias("state"), F.when(F.col("seen") >= 20, "MAJOR").otherwise("MINOR").alias("severity"))


@R.add("q128_staleness", """with l as (select user_id, max(ts) t, count(*) filter (where ts > timestamp '2024-01-28') newer, count(*) n from events group by 1), m as (select max(ts) now from events) select user_id, case when epoch(now) - epoch(t) > 48 * 3600 then 'old' when newer > 0.1::double * n then 'changed' else 'fresh' end state from l, m""")
def staleness(t: Tables) -> DataFrame:
    """Stale after 48 hours or when more than a tenth is newer than the index."""
    l = t.events.groupBy("user_id").agg(F.max("ts").alias("t"), F.count_if(F.col("ts") > F.lit("2024-01-28").cast("timestamp_ntz")).alias("newer"), F.count(F.lit(1)).alias("n"))  # noqa: E741
    now = t.events.agg(F.max("ts").alias("now"))
    age = F.unix_timestamp(F.col("now").cast("timestamp")) - F.unix_timestamp(F.col("t").cast("timestamp"))
    return l.crossJoin(now).select("user_id", F.when(age > 48 * 3600, "old").when(F.col("newer") > 0.1 * F.col("n"), "changed").otherwise("fresh").alias("state"))  # now is one row


@R.add("q129_quantities", r"""with m as (select doc_id, unnest(regexp_extract_all(text, '[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}|[0-9][0-9,]*')) v from documents) select doc_id, count(*) numbers, max(case when contains(v, '.') then null else replace(v, ',', '')::double end) largest from m group by 1""")
def quantities(t: Tables) -> DataFrame:
    found = t.documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}|[0-9][0-9,]*"), F.lit(0))).alias("v"))
    return found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("numbers"), F.max(F.when(~F.contains("v", F.lit(".")), F.replace("v", F.lit(","), F.lit("")).cast("double"))).alias("largest"))


@R.add("q130_host_cascade", """with r(source, host) as (values ('src1', 'ruled.example'), ('src2', 'ruled2.example')), m as (select d.source, regexp_extract(p.url, '^[a-z]+://([^/:?#]+)', 1) host, count(*) n from documents d join pages p on p.page_id = d.doc_id group by 1, 2), b as (select source, host from (select *, row_number() over (partition by source order by n desc, host) i from m) where i = 1), s as (select distinct source from documents)
 select s.source, coalesce(r.host, b.host, 'undetermined') host, case when r.host is not null then 'ruling' when b.host is not null then 'modal' else 'none' end how from s left join r using (source) left join b using (source)""")
def host_cascade(t: Tables) -> DataFrame:
    """A ruling, else the host that most of a source's pages have, else undetermined."""
    ruled = t.spark.createDataFrame([("src1", "ruled.example"), ("src2", "ruled2.example")], "source string, ruled string")
    m = t.documents.select("source", F.col("doc_id").alias("page_id")).join(t.pages.select("page_id", T.url_host("url").alias("host")), "page_id").groupBy("source", "host").agg(F.count(F.lit(1)).alias("n"))
    modal = J.first_wins(m, ["source"], [F.desc("n"), "host"]).select("source", "host")
    out = t.documents.select("source").distinct().join(ruled, "source", "left").join(modal, "source", "left")
    how = F.when(F.col("ruled").isNotNull(), "ruling").when(F.col("host").isNotNull(), "modal").otherwise("none")
    return out.select("source", F.coalesce("ruled", "host", F.lit("undetermined")).alias("host"), how.alias("how"))


@R.add("q131_ratchet_floor", """with d as (select date_trunc('day', ts) "day", count(*) filter (where event_type = 'error') faults from events group by 1), f as (select *, min(faults) over (order by "day" rows between unbounded preceding and 1 preceding) standing from d) select "day", faults, standing, case when standing is null then 'baseline' when faults > standing then 'REGRESSED' when faults = standing then 'held' else 'ratcheted' end verdict from f""")
def ratchet_floor(t: Tables) -> DataFrame:
    """A fault floor that only goes down; one row a day, so the running window is over days."""
    d = t.events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.count_if(F.col("event_type") == "error").alias("faults"))
    standing = F.min("faults").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("standing", standing)
    return d.withColumn("verdict", F.when(F.col("standing").isNull(), "baseline").when(F.col("faults") > F.col("standing"), "REGRESSED").when(F.col("faults") == F.col("standing"), "held").otherwise("ratcheted"))


@R.add("q132_names_covered", r"""with w as (select distinct conv_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) w from conversations), n as (select distinct lower(p_name) nm, split_part(lower(p_name), ' ', 1) a, split_part(lower(p_name), ' ', -1) z from part union select distinct lower(substr(text, 1, 3)), lower(substr(text, 1, 3)), lower(substr(text, 1, 3)) from benchmark)
 select x.conv_id, count(distinct nm) covered from n join w x on x.w = a join w y on y.w = z and y.conv_id is not distinct from x.conv_id group by 1""")
def names_covered(t: Tables) -> DataFrame:
    """Names that a conversation covers, by their first and last word: the names of parts, and three-letter ones. Names and words meet by equality; no conversation is gathered."""
    words = t.conversations.select("conv_id", F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("w")).distinct()
    short = F.lower(F.left("text", F.lit(3)))
    parts = F.split(F.lower("p_name"), " ")
    names = t.part.select(F.lower("p_name").alias("nm"), parts[0].alias("a"), F.element_at(parts, -1).alias("z")).union(t.benchmark.select(short, short, short)).distinct()
    first = words.join(names, F.col("w") == F.col("a")).select("conv_id", "nm", F.col("z").alias("w"))
    both = first.alias("f").join(words.alias("y"), (F.col("f.w") == F.col("y.w")) & F.col("f.conv_id").eqNullSafe(F.col("y.conv_id")), "left_semi")
    return both.groupBy("conv_id").agg(F.count_distinct("nm").alias("covered"))


@R.add("q133_ceiling_clamp", """with n as (select o_custkey, max(case when o_orderpriority like '1%' then o_totalprice end) gate, max(o_totalprice) top from orders group by 1) select o_orderkey, case when gate is null then 'unassayed' else 'M' || least(case when o_totalprice >= 400000 then 5 when o_totalprice >= 200000 then 4 when o_totalprice >= 100000 then 3 when o_totalprice >= 10000 then 2 else 1 end, case when gate >= 400000 then 5 when gate >= 200000 then 4 when gate >= 100000 then 3 when gate >= 10000 then 2 else 1 end) end band from orders join n using (o_custkey)""")
def ceiling_clamp(t: Tables) -> DataFrame:
    """No evidence, no band; a band never exceeds its source's ceiling."""
    floors = [0.0, 1e4, 1e5, 2e5, 4e5]
    gate = t.orders.where("o_orderpriority like '1%'").groupBy("o_custkey").agg(F.max("o_totalprice").alias("gate"))
    rows = t.orders.join(gate, "o_custkey", "left")
    k = F.least(N.band(F.col("o_totalprice"), floors), N.band(F.col("gate"), floors)) + 1
    return rows.select("o_orderkey", F.when(F.col("gate").isNull(), "unassayed").otherwise(F.concat(F.lit("M"), k.cast("string"))).alias("band"))


@R.add("q134_progress_upsert", """with r as (select s_suppkey, s_acctbal > 0 done from supplier), b as (select l_suppkey, count(*) n from lineitem where l_quantity > 30 group by 1) select s_suppkey, case when n is not null then 'done' when done then 'kept' else 'waiting' end status, coalesce(n, 0) entries, count(*) filter (where n is not null) over () / count(*) over ()::double progress from r left join b on l_suppkey = s_suppkey""")
def progress_upsert(t: Tables) -> DataFrame:
    """A batch's results into a roll by name, and the roll's progress."""
    b = t.lineitem.where("l_quantity > 30").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = t.supplier.select("s_suppkey", (F.col("s_acctbal") > 0).alias("done")).join(b, "s_suppkey", "left")
    total = rows.agg((F.count("n") / F.count(F.lit(1))).alias("progress"))
    status = F.when(F.col("n").isNotNull(), "done").when(F.col("done"), "kept").otherwise("waiting")
    return rows.crossJoin(total).select("s_suppkey", status.alias("status"), F.coalesce("n", F.lit(0)).alias("entries"), "progress")  # total is one row


@R.add("q135_base36", "select doc_id, sha256(text)[1:12] coordinate, ('0x' || sha256(text)[1:12])::bigint number from documents")
def base36(t: Tables) -> DataFrame:
    """A text's coordinate from its digest; ``functions.catalogue.base36`` writes a number in base 36."""
    d = F.left(F.sha2("text", 256), F.lit(12))
    return t.documents.select("doc_id", d.alias("coordinate"), F.conv(d, 16, 10).cast("long").alias("number"))


@R.add("q136_search", "select doc_id, source, instr(lower(text), 'idiot') place from documents where contains(lower(text), 'idiot')")
def search(t: Tables) -> DataFrame:
    return t.documents.where(F.contains(F.lower("text"), F.lit("idiot"))).select("doc_id", "source", F.instr(F.lower("text"), "idiot").cast("long").alias("place"))


@R.add("q137_saturated", "select vec_id, len(list_filter(embedding, lambda x: x is not null)) >= 6 and list_min(embedding) >= -0.3::float saturated from embeddings")
def saturated(t: Tables) -> DataFrame:
    """Enough axes are numeric and the least of them is high."""
    axes = F.col("embedding")
    return t.embeddings.select("vec_id", ((F.size(F.filter(axes, lambda x: x.isNotNull())) >= 6) & (F.array_min(axes) >= F.lit(-0.3).cast("float"))).alias("saturated"))
