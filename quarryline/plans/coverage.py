"""Coverage, resolution, merging and sharing: the canned rollups and the joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions import text as T
from quarryline.operators import aggregates as A
from quarryline.operators import joins as J
from quarryline.operators.snapshots import snapshot
from quarryline.plans.base import Registry, Tables

R = Registry()


def _judged(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "source", "lang", "text").join(t.labels, "doc_id", "left")


_COVERAGE_SQL = """select source, count(*) docs, count(*) filter (where quality = 1) good, count(*) filter (where quality = 0) bad,
 count(*) filter (where quality is null) unlabelled, count(*) filter (where quality = 1) / greatest(count(*), 1)::double good_share
 from documents left join labels using (doc_id) group by source"""


def _coverage(t: Tables) -> DataFrame:
    c = A.conditional_counts(_judged(t), ["source"], {"good": F.col("quality") == 1, "bad": F.col("quality") == 0, "unlabelled": F.col("quality").isNull()})
    return c.select("source", F.col("n").alias("docs"), "good", "bad", "unlabelled", (F.col("good") / F.greatest("n", F.lit(1))).alias("good_share"))


R.add("q01_coverage_by_source", _COVERAGE_SQL)(_coverage)


#: Entries that a source must have before its share is ranked (fixed value).
FLOOR = 40


def _cited(t: Tables, low: int, high: int) -> DataFrame:
    """Sources of so many entries with what is cited of them; sources without any judged entry are unmeasured and left out."""
    rows = _judged(t).groupBy("source").agg(F.count(F.lit(1)).alias("entries"), F.count("quality").alias("judged"), F.count_if(F.col("quality") == 1).alias("cited"))
    rows = rows.where((F.col("judged") > 0) & F.col("entries").between(low, high))
    return rows.select("source", "entries", "cited", F.round(100.0 * F.col("cited") / F.col("entries"), 1).alias("percent"))


def _cited_sql(low: int, high: int) -> str:
    return f"""select source, count(*) entries, count(*) filter (where quality = 1) cited, round(100.0 * count(*) filter (where quality = 1) / count(*), 1)::double percent
 from documents left join labels using (doc_id) group by source having count(quality) > 0 and count(*) between {low} and {high}"""


R.add("q02_worst_cited", _cited_sql(FLOOR, 1 << 40))(lambda t: _cited(t, FLOOR, 1 << 40))
R.add("q03_below_floor", _cited_sql(1, FLOOR - 1))(lambda t: _cited(t, 1, FLOOR - 1))


@R.add("q04_unmeasured", "select h host, n pages from (select regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) h, count(*) n, count(labels.doc_id) m from pages left join labels on labels.doc_id = page_id group by 1) where m = 0")
def unmeasured(t: Tables) -> DataFrame:
    rows = t.pages.select(T.url_host("url").alias("host"), F.col("page_id").alias("doc_id")).join(t.labels.select("doc_id", F.lit(1).alias("m")), "doc_id", "left")
    return rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.count("m").alias("m")).where("m = 0").drop("m")


R.add("q05_categories", "select lang, count(*) n from documents group by lang")(lambda t: t.documents.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
R.add("q06_types_nonnull", "select p_type, count(*) n from part where p_type is not null group by p_type")(lambda t: t.part.where("p_type is not null").groupBy("p_type").agg(F.count(F.lit(1)).alias("n")))
R.add("q07_unjudged", "select source, count(*) n from documents anti join labels using (doc_id) group by source")(lambda t: J.stranded(t.documents.select("doc_id", "source"), t.labels, ["doc_id"]).groupBy("source").agg(F.count(F.lit(1)).alias("n")))


@R.add("q08_evidence_rollup", "select regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) host, count(*) pages, sum(length(html))::bigint chars, count(*) filter (where html like '%</html>%') whole from pages group by 1")
def evidence_rollup(t: Tables) -> DataFrame:
    return t.pages.groupBy(T.url_host("url").alias("host")).agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("html")).alias("chars"), F.count_if(F.col("html").contains("</html>")).alias("whole"))


_HTML_SQL = r"trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&nbsp;', ' '), '&amp;', '&'), '[ \t\r\n]+', ' ', 'g'))".replace('\\"', '"')


def page_gate(html, least: int = 200) -> tuple:
    """(passes, reason) of the page-reality gate: long enough, no refusal wording, some prose markup."""
    body = T.html_text(html)
    reason = F.when(F.length(body) < 900, "short").when(F.lower(body).rlike("access denied|enable javascript|captcha|404 not found"), "refusal").when(~F.col(html).contains("<p"), "no markup")
    return reason.isNull(), reason


@R.add(
    "q09_refused_by_host",
    f"""with g as (select regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) host, {_HTML_SQL} body, html from pages)
 select host, count(*) refused, count(*) filter (where length(body) < 900) short from g
 where length(body) < 900 or regexp_matches(lower(body), 'access denied|enable javascript|captcha|404 not found') or not contains(html, '<p') group by host""",
)
def refused_by_host(t: Tables) -> DataFrame:
    ok, reason = page_gate("html", 900)
    return t.pages.select(T.url_host("url").alias("host"), ok.alias("ok"), reason.alias("reason")).where("not ok").groupBy("host").agg(F.count(F.lit(1)).alias("refused"), F.count_if(F.col("reason") == "short").alias("short"))


@R.add("q14_idf", r"""with p as (select distinct doc_id, unnest(list_filter(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: length(w) >= 4)) token from documents)
 select token, count(*) df, ln((select count(distinct doc_id) from p) / count(*)) idf from p group by token having count(*) >= 2""")
def idf(t: Tables) -> DataFrame:
    return A.document_frequency(t.documents, T.tokens("text", 4)).withColumnRenamed("key", "token").where("df >= 2")


@R.add("q15_surprisal", r"""with p as (select distinct p_name, unnest(list_filter(string_split(regexp_replace(lower(p_name), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: length(w) >= 1)) token from part),
 d as (select token, count(*) df from p group by token)
 select p_name, sum(log2((select count(distinct p_name) from p) / df)) bits from p join d using (token) group by p_name""")
def surprisal(t: Tables) -> DataFrame:
    return A.surprisal(t.part.select("p_name", F.explode(T.tokens("p_name")).alias("token")), "p_name", "token")


_OCC_SQL = r"""with o as (select distinct source, unnest(list_filter(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: length(w) >= 6)) token from documents),
 d as (select token, count(*) n from o group by token)"""


def _occurrences(t: Tables) -> DataFrame:
    """Distinct (source, token) with n, the sources that have the token; written once, as several joins read it."""
    o = snapshot(t.documents.select("source", F.explode(T.tokens("text", 6)).alias("token")).distinct(), "occurrences")
    return o.join(o.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token")


@R.add("q16_pair_weights", _OCC_SQL + """, w as (select source, token, ln((select count(distinct source) from o) / n) weight from o join d using (token) where n >= 2)
 select a.source a, b.source b, sum(a.weight) weight, count(*) shared from w a join w b using (token) where a.source < b.source group by 1, 2""")
def pair_weights(t: Tables) -> DataFrame:
    o = _occurrences(t)
    total = t.documents.agg(F.count_distinct("source").alias("total"))
    weighted = o.where("n >= 2").crossJoin(total).select("source", "token", F.log(F.col("total") / F.col("n")).alias("weight"))  # total is one row
    return J.pair_weights(weighted, "source", "token", "weight")


@R.add("q17_pair_damped", _OCC_SQL + """, w as (select source, token, 1 / ln(n + 1.5::double) * case when n > 12 then 0.15::double else 1 end weight from o join d using (token) where n >= 2)
 select a.source a, b.source b, sum(a.weight) weight, count(*) shared from w a join w b using (token) where a.source < b.source group by 1, 2""")
def pair_damped(t: Tables) -> DataFrame:
    damp = F.lit(1.0) / F.log(F.col("n") + 1.5) * F.when(F.col("n") > 12, 0.15).otherwise(1.0)
    return J.pair_weights(_occurrences(t).where("n >= 2").select("source", "token", damp.alias("weight")), "source", "token", "weight")


@R.add("q18_directed_sharing", """with k as (select distinct s_nationkey, l_partkey from lineitem join supplier on l_suppkey = s_suppkey)
 select a.s_nationkey a, b.s_nationkey b, count(*) shared from k a join k b using (l_partkey) where a.s_nationkey <> b.s_nationkey group by 1, 2""")
def directed_sharing(t: Tables) -> DataFrame:
    keys = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("s_nationkey", "l_partkey").distinct()
    one = J.pair_weights(keys.withColumn("w", F.lit(1)), "s_nationkey", "l_partkey", "w").select("a", "b", "shared")
    return one.union(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))


@R.add("q19_thread_classes", """with e as (select distinct c_nationkey a, s_nationkey b from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey where c_nationkey <> s_nationkey and l_quantity > 49),
 p as (select least(a, b) lo, greatest(a, b) hi, bool_or(a < b) up, bool_or(a > b) down from e group by 1, 2)
 select lo, hi, case when up and down then 'RECIPROCAL' when up then 'UP' else 'DOWN' end state from p""")
def thread_classes(t: Tables) -> DataFrame:
    big = t.lineitem.where("l_quantity > 49").select("l_orderkey", "l_suppkey")
    edges = big.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    a, b = F.col("c_nationkey"), F.col("s_nationkey")
    pairs = edges.where(a != b).groupBy(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).agg(F.bool_or(a < b).alias("up"), F.bool_or(a > b).alias("down"))
    return pairs.select("lo", "hi", F.when(F.col("up") & F.col("down"), "RECIPROCAL").when(F.col("up"), "UP").otherwise("DOWN").alias("state"))


@R.add("q20_inverted_index", """with k as (select regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') key, l_suppkey m from lineitem join part on l_partkey = p_partkey),
 i as (select key, count(distinct m) spread, count(*) n from k where key <> '' group by key) select spread, count(*) keys, sum(n)::bigint attestations from i group by spread""")
def inverted_index(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_partkey", "l_suppkey").join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    index = A.inverted_index(rows, T.name_key("p_name"), "l_suppkey")
    return index.groupBy("spread").agg(F.count(F.lit(1)).alias("keys"), F.sum("attestations").alias("attestations"))


@R.add("q21_dedup_first", r"""with k as (select doc_id, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') key from documents), r as (select *, row_number() over (partition by key order by doc_id) n, min(doc_id) over (partition by key) kept from k)
 select doc_id dropped, kept from r where n > 1""")
def dedup_first(t: Tables) -> DataFrame:
    keyed = t.documents.select("doc_id", F.sha2(F.regexp_replace(F.lower("text"), "[^a-z0-9]", ""), 256).alias("key"))
    first = keyed.groupBy("key").agg(F.min("doc_id").alias("kept"))
    return keyed.join(first, "key").where("doc_id <> kept").select(F.col("doc_id").alias("dropped"), "kept")


@R.add("q22_occurrence_key", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_extendedprice) occurrence from lineitem")
def occurrence_key(t: Tables) -> DataFrame:
    rows = J.occurrence(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "occurrence")


@R.add("q23_merge_three_way", """with b as (select o_orderkey k, o_orderstatus s, o_orderpriority p from orders where o_orderkey % 7 <> 0),
 o as (select k, case when k % 5 = 0 then 'X' else s end s, p from b where k % 11 <> 0 union all select o_orderkey, 'N', 'new' from orders where o_orderkey % 14 = 0),
 t as (select k, case when k % 10 = 0 then 'Y' else s end s, case when k % 3 = 0 then 'P' else p end p from b where k % 13 <> 0),
 j as (select k, b.k is not null hb, o.k is not null ho, t.k is not null ht, b.s bs, b.p bp, o.s os, o.p op, t.s ts, t.p tp from b full join o using (k) full join t using (k)),
 kept as (select * from j where not (hb and ((not ho and ((ht and ts is not distinct from bs and tp is not distinct from bp) or not ht)) or (not ht and ((ho and os is not distinct from bs and op is not distinct from bp) or not ho))))),
 v as (select k, bs, bp, case when ho then os else bs end os, case when ho then op else bp end op, case when ht then ts else bs end ts, case when ht then tp else bp end tp from kept)
 select k, case when os is not distinct from bs then ts else os end s, case when op is not distinct from bp then tp else op end p,
 (os is distinct from bs and ts is distinct from bs and os is distinct from ts) or (op is distinct from bp and tp is distinct from bp and op is distinct from tp) conflict from v""")
def merge_three_way(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    base = rows.where("k % 7 <> 0")
    ours = base.where("k % 11 <> 0").withColumn("s", F.when(F.col("k") % 5 == 0, "X").otherwise(F.col("s"))).union(rows.where("k % 14 = 0").select("k", F.lit("N"), F.lit("new")))
    theirs = base.where("k % 13 <> 0").select("k", F.when(F.col("k") % 10 == 0, "Y").otherwise(F.col("s")).alias("s"), F.when(F.col("k") % 3 == 0, "P").otherwise(F.col("p")).alias("p"))
    return J.three_way_merge(base, ours, theirs, ["k"], ["s", "p"])


@R.add("q24_resolver_cascade", r"""with c as (select s_suppkey, s_name, s_nationkey k from supplier), codes as (select n_name name, 'N' || n_nationkey code, n_nationkey from nation),
 x as (select s_suppkey id, case when k % 3 = 0 then n.name when k % 3 = 1 then lower(replace(n.name, 'N', 'n')) else 'house of ' || n.name || ' east' end label from c join codes n on n.n_nationkey = k),
 e as (select id, min(code) v from x join codes on label = name group by id),
 f as (select id, min(code) v from x join codes on regexp_replace(lower(label), '[^a-z0-9]', '', 'g') = regexp_replace(lower(name), '[^a-z0-9]', '', 'g') group by id),
 w as (select id, min(code) lo, max(code) hi from x join codes on contains(' ' || label || ' ', ' ' || name || ' ') group by id)
 select id, coalesce(e.v, f.v, case when w.lo <> w.hi then 'UNASSIGNED' else w.lo end, 'UNASSIGNED') code, case when e.v is not null then 'exact' when f.v is not null then 'folded' when w.lo <> w.hi then 'tie' when w.lo is not null then 'contained' else 'none' end how
 from x left join e using (id) left join f using (id) left join w using (id)""")
def resolver_cascade(t: Tables) -> DataFrame:
    codes = t.nation.select(F.col("n_name").alias("name"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"), "n_nationkey")
    k = F.col("s_nationkey")
    label = F.when(k % 3 == 0, F.col("name")).when(k % 3 == 1, F.lower("name")).otherwise(F.concat(F.lit("house of "), F.col("name"), F.lit(" east")))
    asked = t.supplier.join(codes, k == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), label.alias("label"))
    codes = codes.select("name", "code")
    exact = asked.join(codes, F.col("label") == F.col("name")).select("id", "code")
    folded = asked.join(codes, T.name_key("label") == T.name_key("name")).select("id", "code")
    # contained: the label's word runs meet the names' words by equality, no cross join
    words = asked.select("id", "label", F.explode(F.split("label", " ")).alias("w"))
    contained = words.join(codes.withColumn("w", F.split("name", " ")[0]), "w").where(F.contains(F.concat(F.lit(" "), F.col("label"), F.lit(" ")), F.concat(F.lit(" "), F.col("name"), F.lit(" ")))).select("id", "code").distinct()
    return J.cascade(asked.select("id"), [("exact", exact), ("folded", folded), ("contained", contained)], "id", "code", "UNASSIGNED")


@R.add("q25_first_wins_join", """with f as (select p_brand, p_type, min(p_partkey) p_partkey from part group by 1, 2)
 select p_brand, p_type, f.p_partkey, count(*) lines, sum(l_quantity) quantity from f join lineitem on l_partkey = p_partkey group by 1, 2, 3""")
def first_wins_join(t: Tables) -> DataFrame:
    first = J.first_wins(t.part.select("p_brand", "p_type", "p_partkey"), ["p_brand", "p_type"], ["p_partkey"])
    lines = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    return first.join(lines, "p_partkey")


@R.add("q26_stranded_anti", "select 'customer' side, c_custkey key from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000) union all select 'order', o_orderkey from orders where not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal > -900)")
def stranded_anti(t: Tables) -> DataFrame:
    a = J.stranded(t.customer.select(F.col("c_custkey").alias("k")), t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("k")), ["k"]).select(F.lit("customer").alias("side"), F.col("k").alias("key"))
    b = t.orders.join(t.customer.where("c_acctbal > -900"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select(F.lit("order").alias("side"), F.col("o_orderkey").alias("key"))
    return a.union(b)


@R.add("q27_why_unbound", """select p.page_id, case when d.doc_id is null then 'unknown' when l.doc_id is null then 'unread' when d.lang <> regexp_extract(p.url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1) then 'other language' else 'bound' end reason
 from pages p left join documents d on d.doc_id = p.page_id left join labels l on l.doc_id = p.page_id""")
def why_unbound(t: Tables) -> DataFrame:
    rows = t.pages.select("page_id", "url").join(t.documents.select(F.col("doc_id").alias("page_id"), "lang"), "page_id", "left").join(t.labels.select(F.col("doc_id").alias("page_id"), F.lit(True).alias("read")), "page_id", "left")
    reason = F.when(F.col("lang").isNull(), "unknown").when(F.col("read").isNull(), "unread").when(F.col("lang") != F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z][a-z])/", 1), "other language").otherwise("bound")
    return rows.select("page_id", reason.alias("reason"))


@R.add("q28_state_precedence", r"""with b as (select distinct d.doc_id from documents d join benchmark b on contains(d.text, b.text))
 select source, case when b.doc_id is not null then 'CITED' when l.quality = 1 then 'READ' when l.quality = 0 then 'NO PAGE' else 'NOT ATTEMPTED' end state, count(*) n
 from documents d left join b using (doc_id) left join labels l using (doc_id) group by 1, 2""")
def state_precedence(t: Tables) -> DataFrame:
    from quarryline.operators.passages import passages_in

    cited = passages_in(t.documents, t.benchmark).select("doc_id").distinct().withColumn("cited", F.lit(True))
    rows = _judged(t).join(cited, "doc_id", "left")
    state = F.when(F.col("cited"), "CITED").when(F.col("quality") == 1, "READ").when(F.col("quality") == 0, "NO PAGE").otherwise("NOT ATTEMPTED")
    return rows.groupBy("source", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@R.add("q29_interval_overlap", """with s as (select l_suppkey g, l_orderkey id, min(epoch(l_shipdate))::bigint // 86400 s, max(epoch(l_shipdate))::bigint // 86400 + 2 e from lineitem where l_quantity > 45 group by 1, 2)
 select a.g, a.id a, b.id b, least(a.e, b.e) - greatest(a.s, b.s) shared from s a join s b on a.g = b.g and a.id < b.id and a.s <= b.e and b.s <= a.e""")
def interval_overlap(t: Tables) -> DataFrame:
    day = F.floor(F.unix_timestamp(F.col("l_shipdate").cast("timestamp")) / 86400)
    spans = t.lineitem.where("l_quantity > 45").groupBy(F.col("l_suppkey").alias("g"), F.col("l_orderkey").alias("id")).agg(F.min(day).alias("s"), (F.max(day) + 2).alias("e"))
    return J.overlaps(spans, "g", "id", "s", "e", 16)


@R.add("q30_ghosts", """with o as (select user_id, max(ts) seen from events where event_type = 'signup' group by 1), c as (select user_id, max(ts) closed from events where event_type = 'error' group by 1)
 select user_id, case when closed is null then 'open' when seen < closed then 'ghost' else 'recurrence' end state from o left join c using (user_id)""")
def ghosts(t: Tables) -> DataFrame:
    opened = t.events.where("event_type = 'signup'").groupBy("user_id").agg(F.max("ts").alias("seen"))
    return J.latest_close(opened, t.events.where("event_type = 'error'"), "user_id", "seen", "ts").select("user_id", "state")


@R.add("q31_semi_scale", """with b as (select p_brand from part group by p_brand having count(*) >= 4 and max(p_retailprice) / min(p_retailprice) >= 1.01), r as (select * from part semi join b using (p_brand))
 select p_brand, count(*) n, avg(p_retailprice) mean from r group by p_brand""")
def semi_scale(t: Tables) -> DataFrame:
    wide = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), (F.max("p_retailprice") / F.min("p_retailprice")).alias("spread")).where("n >= 4 and spread >= 1.01")
    return t.part.join(wide, "p_brand", "left_semi").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.avg("p_retailprice").alias("mean"))


@R.add("q32_fuzzy_match")
def fuzzy_match(t: Tables) -> DataFrame:
    """Part names against part names that lost their sixth or first letter: equal digits, a score of 0.72 at least."""
    from quarryline.operators.matching import candidates

    names = t.part.select(F.col("p_name").alias("name")).distinct()
    lost = names.select(F.regexp_replace("name", "(?<=^.{5}).", "").alias("name")).union(names.select(F.regexp_replace("name", "^.", "").alias("name")))
    return candidates(names, lost, 0.72)


@R.add("q75_vote", "with w as (select source g, lang c, sum(n_chars) v from documents where lang is not null group by 1, 2), r as (select *, row_number() over (partition by g order by v desc, c) k, sum(v) over (partition by g) s, count(*) over (partition by g) contested from w) select g source, c lang, v::bigint votes, (v / s)::double share, contested from r where k = 1")
def vote(t: Tables) -> DataFrame:
    return A.vote(t.documents, "source", "lang", "n_chars")


R.add("q76_rollup_total", "select coalesce(l_returnflag, 'TOTAL') l_returnflag, count(*) n from lineitem group by rollup(l_returnflag)")(lambda t: A.with_total(t.lineitem, "l_returnflag"))


@R.add("q80_section_presence", """with r as (select conv_id, bool_or(role = 'system') s, bool_or(role = 'user') u, bool_or(role = 'assistant') a, count(distinct role) filter (where role not in ('system', 'user', 'assistant')) extras from conversations group by 1)
 select conv_id, (not s)::int + (not u)::int + (not a)::int missing, extras from r""")
def section_presence(t: Tables) -> DataFrame:
    required = ["system", "user", "assistant"]
    flags = [F.bool_or(F.coalesce(F.col("role") == r, F.lit(False))).alias(r) for r in required]
    rows = t.conversations.groupBy("conv_id").agg(*flags, F.count_distinct(F.when(~F.col("role").isin(required), F.col("role"))).alias("extras"))
    return rows.select("conv_id", sum(((~F.col(r)).cast("int") for r in required), F.lit(0)).alias("missing"), "extras")
