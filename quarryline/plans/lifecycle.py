"""Queries over the life of records: status, queues, stamps, floors, rosters and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions import lifecycle as L
from quarryline.functions import numeric as N
from quarryline.functions import text as T
from quarryline.operators import joins as J
from quarryline.operators import windows as W
from quarryline.plans.base import Registry, Tables
from quarryline.streaming.retention import retained

R = Registry()

_HOST_SQL = "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"

# --- entries: documents as catalogue entries; a label of quality judges, one of toxicity strikes, every seventh length is stale.
_ENTRIES_SQL = "entries as (select source, doc_id, n_chars, quality = 1 catalogued, case when toxic = 1 then 'struck' end excluded, case when n_chars % 7 = 0 then 'stale' end stale from documents left join labels using (doc_id))"


def _entries(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "source", "n_chars").join(t.labels, "doc_id", "left")
    return rows.select("source", "doc_id", "n_chars", (F.col("quality") == 1).alias("catalogued"), F.when(F.col("toxic") == 1, "struck").alias("excluded"), F.when(F.col("n_chars") % 7 == 0, "stale").alias("stale"))


@R.add("q142_entry_status", f"with {_ENTRIES_SQL} select source, count(*) n, count(*) filter (where coalesce(catalogued, false) or excluded is not null) settled, count(*) filter (where excluded is null and stale is null) live, count(*) filter (where excluded is null and stale is not null) held_out from entries group by 1")
def entry_status(t: Tables) -> DataFrame:
    c, x, s = F.col("catalogued"), F.col("excluded"), F.col("stale")
    return _entries(t).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(L.entry_settled(c, x)).alias("settled"), F.count_if(L.entry_live(x, s)).alias("live"), F.count_if(L.stale_held_out(x, s)).alias("held_out"))


_RESULT_SQL = "select event_id, event_type, case when event_type = 'purchase' then value end dec, case when event_type = 'error' and event_id % 2 = 0 then 'DEFERRED' end status, case event_id % 4 when 0 then 'timed out' when 1 then 'no axis cleared its gate (3 axes)' when 2 then 'sheet saturated' end reason from events"


@R.add("q143_settled_results", f"with r as ({_RESULT_SQL}), s as (select event_type, case when dec is not null then true when status is not distinct from 'DEFERRED' then false else contains(coalesce(reason, ''), 'no axis cleared its gate') or contains(coalesce(reason, ''), 'sheet saturated') end settled from r) select event_type, settled, count(*) n from s group by 1, 2")
def settled_results(t: Tables) -> DataFrame:
    e, k = F.col("event_type"), F.col("event_id")
    reason = F.when(k % 4 == 0, "timed out").when(k % 4 == 1, "no axis cleared its gate (3 axes)").when(k % 4 == 2, "sheet saturated")
    settled = L.result_settled(F.when(e == "purchase", F.col("value")), F.when((e == "error") & (k % 2 == 0), F.lit("DEFERRED")), reason)
    return t.events.groupBy("event_type", settled.alias("settled")).agg(F.count(F.lit(1)).alias("n"))


_MAGNITUDES = ["M3", " None ", "unassayed", "N/A", "", "A M7.25"]
_MAGNITUDE_SQL = "case p_partkey % 7 " + " ".join(f"when {k} then '{m}'" for k, m in enumerate(_MAGNITUDES)) + " end"


def _magnitude() -> F.Column:
    return F.get(F.array(*[F.lit(m) for m in _MAGNITUDES]), (F.col("p_partkey") % 7).cast("int"))


@R.add("q144_magnitude_claims", f"select p_brand, count(*) filter (where {_MAGNITUDE_SQL} is not null and trim({_MAGNITUDE_SQL}) <> '' and lower(trim({_MAGNITUDE_SQL})) not in ('unassayed', 'none', 'n/a')) claims, count(*) n from part group by 1")
def magnitude_claims(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.count_if(L.asserts_magnitude(_magnitude())).alias("claims"), F.count(F.lit(1)).alias("n"))


_META = r"\b(tokens?|wiki\w*|stubs?|(?:this|the) (?:article|entry)|hit points?|homebrew|license)\b"


@R.add("q145_banned_terms", f"with f as (select doc_id, list_sort(list_distinct(list_transform(regexp_extract_all(text, '(?i){_META}'), lambda x: lower(x)))) f from documents) select doc_id, array_to_string(f, ', ') terms from f where len(f) > 0")
def banned_terms(t: Tables) -> DataFrame:
    found = L.banned_terms(F.col("text"), "(?i)" + _META)
    return t.documents.select("doc_id", found.alias("f")).where(F.size("f") > 0).select("doc_id", F.array_join("f", ", ").alias("terms"))


_BODIES = ['{"feats": [{"sentence": "a", "axis": null}, {}]}', '{"feats": null}', '{"feats": "abc"}', '{"feats": ["a"]}', '{"feats": [{"sentence": 3}]}', '{"feats": []}', "not json"]


@R.add("q146_row_shapes", "with b(k, body) as (values " + ", ".join(f"({k}, '{b}')" for k, b in enumerate(_BODIES)) + f"""), r as (select event_id, coalesce(body, props) body from events left join b on k = event_id % 9), j as (select event_id, body, try_cast(body as json) j from r)
 select coalesce(json_type(j, '$.feats') = 'ARRAY' and len(list_filter(json_extract(j, '$.feats[*]'), lambda x: json_type(x) <> 'OBJECT' or coalesce(json_type(x, '$.sentence'), 'NULL') not in ('VARCHAR', 'NULL') or coalesce(json_type(x, '$.axis'), 'NULL') not in ('VARCHAR', 'NULL'))) = 0, false) ok, count(*) n from j group by 1""")
def row_shapes(t: Tables) -> DataFrame:
    body = F.coalesce(F.get(F.array(*[F.lit(b) for b in _BODIES]), (F.col("event_id") % 9).cast("int")), F.col("props"))
    return t.events.groupBy(L.rows_well_shaped(body, "feats", ["sentence", "axis"]).alias("ok")).agg(F.count(F.lit(1)).alias("n"))


#: Rooms and their shelves, and what a type forbids (for this table).
_ROOMS = {"Brand#1": ["s1", "s2"], "Brand#2": ["s2", "s3"]}
_PAIRS = [(room, shelf) for room, shelves in _ROOMS.items() for shelf in shelves]


@R.add("q147_subrooms", "with d(room, shelf) as (values " + ", ".join(f"('{r}', '{s}')" for r, s in _PAIRS) + """), p as (select p_partkey, left(p_brand, 7) room, case when p_size % 5 = 0 then 'none' else 's' || p_size % 5 end shelf, p_type from part)
 select p_partkey, p.shelf = 'none' or d.room is not null legal, starts_with(p.room, 'Brand#3') and contains(lower(p_type), 'steel') contradicts from p left join d on d.room = p.room and d.shelf = p.shelf""")
def subrooms(t: Tables) -> DataFrame:
    """A shelf is legal in its own room only; a type rules some rooms out."""
    dims = t.spark.createDataFrame(_PAIRS, "room string, shelf string").withColumn("known", F.lit(True))
    k = F.col("p_size") % 5
    rows = t.part.select("p_partkey", F.left("p_brand", F.lit(7)).alias("room"), F.when(k == 0, "none").otherwise(F.concat(F.lit("s"), k.cast("string"))).alias("shelf"), "p_type")
    rows = rows.join(dims, ["room", "shelf"], "left")
    return rows.select("p_partkey", ((F.col("shelf") == "none") | F.col("known").isNotNull()).alias("legal"), (F.col("room").startswith("Brand#3") & F.contains(F.lower("p_type"), F.lit("steel"))).alias("contradicts"))


@R.add("q148_epochs", f"with p as (select page_id, {_HOST_SQL} host, regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1) epoch from pages), d as (select host, min(epoch) due from p where epoch <> '' group by 1 having count(*) >= 3) select page_id, due, due is null or due = epoch acceptable from p left join d using (host)")
def epochs(t: Tables) -> DataFrame:
    """Hosts with enough pages mandate an epoch; a page of another one is not acceptable, and hosts without a rule take any."""
    p = t.pages.select("page_id", T.url_host("url").alias("host"), F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z][a-z])/", 1).alias("epoch"))
    due = p.where("epoch <> ''").groupBy("host").agg(F.min("epoch").alias("due"), F.count(F.lit(1)).alias("n")).where("n >= 3").select("host", "due")
    return p.join(due, "host", "left").select("page_id", "due", (F.col("due").isNull() | (F.col("due") == F.col("epoch"))).alias("acceptable"))


_SENTENCES = ["{}s went on", "The user of it went on", "Then she left", "Mega{} went on", "It was the {} that held"]


@R.add("q149_names_subject", "with s as (select p_partkey, lower(replace(case p_partkey % 5 " + " ".join(f"when {k} then '{s}'" for k, s in enumerate(_SENTENCES)) + """ end, '{}', p_name)) s, list_filter(string_split(lower(p_name), ' '), lambda w: length(w) > 3) parts, lower(p_name) nm from part), w as (select *, list_filter(regexp_split_to_array(s, '[^a-z0-9_]+'), lambda x: x <> '') said from s)
 select p_partkey, len(list_filter(parts, lambda p: len(list_filter(said, lambda x: starts_with(x, p))) > 0)) > 0 or (len(parts) = 0 and (contains(' ' || array_to_string(said, ' ') || ' ', ' ' || nm || ' ') or contains(' ' || array_to_string(said, ' ') || ' ', ' ' || nm || 's '))) or list_has_any(said, ['he', 'she', 'they', 'his', 'her', 'their', 'him', 'himself', 'herself', 'themselves']) named from w""")
def names_subject(t: Tables) -> DataFrame:
    template = F.get(F.array(*[F.lit(s) for s in _SENTENCES]), (F.col("p_partkey") % 5).cast("int"))
    return t.part.select("p_partkey", L.names_subject(F.replace(template, F.lit("{}"), F.col("p_name")), F.col("p_name")).alias("named"))


@R.add("q150_chunk_keys", f"with h as (select page_id, sha256(coalesce({_HOST_SQL}, '') || chr(31) || page_id || chr(31) || html) h from pages) select page_id, left(h, 2) folder, substr(h, 3, 16) name from h")
def chunk_keys(t: Tables) -> DataFrame:
    folder, name = L.chunk_key(F.coalesce(T.url_host("url"), F.lit("")), F.col("page_id").cast("string"), F.col("html"))
    return t.pages.select("page_id", folder.alias("folder"), name.alias("name"))


@R.add("q151_unaddressed", "select source from documents left join labels using (doc_id) group by source having count(quality) = 0 or bool_and(lang is null)")
def unaddressed(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "source", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return rows.groupBy("source").agg(F.count("quality").alias("n"), F.bool_and(F.col("lang").isNull()).alias("blank")).where("n = 0 or blank").select("source")


@R.add("q152_hostless", f"with h as (select page_id, case when page_id % 11 = 0 then 'LOOKUP FAILED' when page_id % 13 = 0 then null else {_HOST_SQL} end host from pages) select page_id from h where host is null")
def hostless(t: Tables) -> DataFrame:
    """Pages without a host; a failed look-up is a finding of its own and no missing host."""
    k = F.col("page_id")
    host = F.when(k % 11 == 0, "LOOKUP FAILED").when(k % 13 != 0, T.url_host("url"))
    return t.pages.select("page_id", host.alias("host")).where("host is null").select("page_id")


@R.add("q153_where_split", "select event_type code, count(distinct user_id % 40) places, min(user_id % 40) first_place, max(user_id % 40) last_place from events where value > 45 group by 1 having count(distinct user_id % 40) > 1")
def where_split(t: Tables) -> DataFrame:
    """Codes that are open at more than one place."""
    place = F.col("user_id") % 40
    return t.events.where("value > 45").groupBy(F.col("event_type").alias("code")).agg(F.count_distinct(place).alias("places"), F.min(place).alias("first_place"), F.max(place).alias("last_place")).where("places > 1")


_BINDING_SQL = f"b as (select distinct source, {_HOST_SQL} host from pages join documents on doc_id = page_id where source is not null)"


def _bindings(t: Tables) -> DataFrame:
    return t.pages.select(F.col("page_id").alias("doc_id"), T.url_host("url").alias("host")).join(t.documents.select("doc_id", "source"), "doc_id").where("source is not null")


@R.add("q154_host_coverage", f"with {_BINDING_SQL}, n as (select source, count(host) n from b group by 1) select count(*) sources, count(*) filter (where n >= 1) with_a_host, count(*) filter (where n > 1) with_more, sum(n)::bigint hosts from n")
def host_coverage(t: Tables) -> DataFrame:
    n = _bindings(t).distinct().select("source", "host").distinct().groupBy("source").agg(F.count("host").alias("n"))
    return n.agg(F.count(F.lit(1)).alias("sources"), F.count_if(F.col("n") >= 1).alias("with_a_host"), F.count_if(F.col("n") > 1).alias("with_more"), F.sum("n").alias("hosts"))


@R.add("q155_hosts_for", f"with {_BINDING_SQL}, c as (select source, host, count(*) pages from (select source, {_HOST_SQL} host from pages join documents on doc_id = page_id where source is not null) group by 1, 2) select source, host, row_number() over (partition by source order by pages desc, host) place from c")
def hosts_for(t: Tables) -> DataFrame:
    """A source's hosts, the primary one first."""
    counts = _bindings(t).groupBy("source", "host").agg(F.count(F.lit(1)).alias("pages"))
    return counts.select("source", "host", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("pages"), "host")).alias("place"))


@R.add("q156_slice_census", "with a as (select user_id, event_type axis, count(*) attempted, count(*) filter (where value > 20) answered, coalesce(sum(value::bigint) filter (where value <= 20), 0) unread from events group by 1, 2) select user_id, sum(attempted)::bigint attempted, sum(answered)::bigint answered, sum(attempted - answered)::bigint refused, sum(unread)::bigint unread, sum(answered) = sum(attempted) complete, coalesce(string_agg(axis, ',' order by axis) filter (where answered < attempted), '') thinned from a group by 1")
def slice_census(t: Tables) -> DataFrame:
    """How much of the evidence a result was read from, and which axes are thin."""
    v = F.col("value")
    a = t.events.groupBy("user_id", F.col("event_type").alias("axis")).agg(F.count(F.lit(1)).alias("attempted"), F.count_if(v > 20).alias("answered"), F.coalesce(F.sum(F.when(v <= 20, F.rint(v).cast("long"))), F.lit(0)).alias("unread"))
    thin = F.array_sort(F.collect_set(F.when(F.col("answered") < F.col("attempted"), F.col("axis"))))  # a handful of axes
    out = a.groupBy("user_id").agg(F.sum("attempted").alias("attempted"), F.sum("answered").alias("answered"), F.sum("unread").alias("unread"), thin.alias("t"))
    return out.select("user_id", "attempted", "answered", (F.col("attempted") - F.col("answered")).alias("refused"), "unread", (F.col("attempted") == F.col("answered")).alias("complete"), F.array_join("t", ",").alias("thinned"))


@R.add("q157_first_queue", f"with r as (select {_HOST_SQL} host, title, n, page_id from (select url, page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) title, length(html) n from pages)), f as (select *, row_number() over (partition by host, title order by page_id) k from r where n > 0 and not regexp_matches(title, '^(List|Index) |[(]disambiguation[)]$')) select host, title, n, row_number() over (order by n desc, host, title) place from f where k = 1")
def first_queue(t: Tables) -> DataFrame:
    """The first row of each host and name, richest evidence first; index pages are no entities. Places come from counts by size, so no task ranks all rows."""
    rows = t.pages.select("page_id", T.url_host("url").alias("host"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.length("html").alias("n"))
    rows = rows.where(F.col("n") > 0).where(~F.col("title").rlike(r"^(List|Index) |[(]disambiguation[)]$"))
    first = J.first_wins(rows.select(F.coalesce("host", F.lit("")).alias("host"), "title", "n", "page_id"), ["host", "title"], ["page_id"])
    sizes = first.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a size
    own = F.row_number().over(Window.partitionBy("n").orderBy("host", "title"))
    return first.join(sizes.select("n", before.alias("before")), "n").select("host", "title", "n", (own + F.col("before")).alias("place"))


@R.add("q158_evidence_order", "select source, doc_id, row_number() over (partition by source order by (length(text) - length(replace(text, '.', ''))) desc, doc_id) place from documents")
def evidence_order(t: Tables) -> DataFrame:
    """A source's documents by the sentences they hold, then by id."""
    feats = F.length("text") - F.length(F.replace("text", F.lit("."), F.lit("")))
    rows = t.documents.select("source", "doc_id", feats.alias("n"))
    return W.places(rows, ["source"], [F.desc_nulls_last("n"), "doc_id"]).select("source", "doc_id", "place")


@R.add("q159_quotas", "with w as (select event_type, date_trunc('week', ts) w, greatest(0, 1000 - count(*)) left_, 1000 cap from events group by 1, 2) select event_type, min(round(left_ / cap::double, 4)) worst, string_agg(round(left_ / cap::double, 4)::varchar, ' ' order by left_, w) fractions from w group by 1")
def quotas(t: Tables) -> DataFrame:
    """Windows of each bucket by the share that is left; the least one binds."""
    w = t.events.groupBy("event_type", F.date_trunc("week", "ts").alias("w")).agg(F.greatest(F.lit(0), 1000 - F.count(F.lit(1))).alias("n"))
    share = F.round(F.col("n") / 1000.0, 4)
    sorted_ = F.array_sort(F.collect_list(F.struct("n", "w", share.alias("s"))))  # one entry a week
    return w.groupBy("event_type").agg(F.min(share).alias("worst"), F.array_join(F.transform(sorted_, lambda x: x["s"].cast("string")), " ").alias("fractions"))


@R.add("q160_rank_by_size", "select doc_id, octet_length(encode(text)) size from documents order by 2 desc nulls last, 1 limit 25")
def rank_by_size(t: Tables) -> DataFrame:
    """The largest texts by bytes (a top-k report)."""
    return t.documents.select("doc_id", F.octet_length("text").cast("long").alias("size")).orderBy(F.desc_nulls_last("size"), "doc_id").limit(25)


@R.add("q161_entity_sets", "with k as (select distinct p_brand, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') key from part) select p_brand, count(*) keys, min(key) first_key, max(key) last_key from k group by 1")
def entity_sets(t: Tables) -> DataFrame:
    k = t.part.select("p_brand", T.name_key("p_name").alias("key")).distinct()
    return k.groupBy("p_brand").agg(F.count(F.lit(1)).alias("keys"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


@R.add("q162_known_codes", "select 'N' || n_nationkey code from nation union select 'R' || r_regionkey from region union select distinct 'N' || c_nationkey from customer")
def known_codes(t: Tables) -> DataFrame:
    code = lambda df, p, c: df.select(F.concat(F.lit(p), F.col(c).cast("string")).alias("code"))
    return code(t.nation, "N", "n_nationkey").union(code(t.region, "R", "r_regionkey")).union(code(t.customer, "N", "c_nationkey")).distinct()


@R.add("q163_composite", "with u as (select lower(p_name) k, p_name nm, 1 o, p_partkey id from part where p_size > 25 union all select lower(p_name), upper(p_name), 2, p_partkey from part where p_size <= 30), r as (select *, row_number() over (partition by k order by o, id, nm) i from u) select k, nm, o from r where i = 1")
def composite(t: Tables) -> DataFrame:
    """Several catalogues of one source together; of an entry that both have, the first catalogue's row stays."""
    one = t.part.where("p_size > 25").select(F.lower("p_name").alias("k"), F.col("p_name").alias("nm"), F.lit(1).alias("o"), "p_partkey")
    two = t.part.where("p_size <= 30").select(F.lower("p_name").alias("k"), F.upper("p_name").alias("nm"), F.lit(2).alias("o"), "p_partkey")
    return J.first_wins(one.unionByName(two), ["k"], ["o", "p_partkey", "nm"]).select("k", "nm", "o")


@R.add("q164_scope", "with s as (select p_brand from part group by 1 having avg(p_size) > 25) select p_brand, count(*) n from part anti join s using (p_brand) group by 1")
def scope(t: Tables) -> DataFrame:
    """Rows of brands that the scope list leaves out."""
    out = t.part.groupBy("p_brand").agg(F.avg("p_size").alias("m")).where("m > 25")
    return J.stranded(t.part, out, ["p_brand"]).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@R.add("q165_stamps", """with e as (select source, sum(('0x' || substr(sha256(n || '/' || k), 1, 15))::bigint)::varchar digest, count(*) entries from (select source, n_chars::varchar n, row_number() over (partition by source, n_chars order by doc_id) k from documents) group by 1),
 s as (select source, case when source like '%1' then null when source like '%2' then '0' else digest end d, case when source like '%3' then entries + 1 else entries end c from e) select source, case when d is null then 'UNSTAMPED' when c = entries and d = digest then 'OK' else 'DRIFTED' end state from e join s on s.source is not distinct from e.source""".replace("join s on s.source is not distinct from e.source", "join s using (source)"))
def stamps(t: Tables) -> DataFrame:
    """A record's content stamp: a sum of digests of its entries, keyed by name and occurrence, so that it adds up map-side."""
    k = F.row_number().over(Window.partitionBy("source", "n_chars").orderBy("doc_id"))
    rows = t.documents.where("source is not null").select("source", F.concat_ws("/", F.col("n_chars").cast("string"), k.cast("string")).alias("n"))
    e = rows.groupBy("source").agg(F.sum(F.conv(F.left(F.sha2("n", 256), F.lit(15)), 16, 10).cast("decimal(38,0)")).cast("string").alias("digest"), F.count(F.lit(1)).alias("entries"))
    s = F.col("source")
    stamped = F.when(s.endswith("1"), F.lit(None)).when(s.endswith("2"), F.lit("0")).otherwise(F.col("digest"))
    return e.select("source", L.stamp_state(F.when(s.endswith("3"), F.col("entries") + 1).otherwise(F.col("entries")), stamped, F.col("entries"), F.col("digest")).alias("state"))


@R.add("q166_floor_ratchet", "with m as (select event_type, count(*) n from events group by 1), f as (select *, case event_type when 'error' then n when 'click' then n - 1 when 'view' then n + 5 end bar from m) select event_type, case when bar is null then 'baseline' when n > bar then 'REGRESSED' when n < bar then 'ratcheted' else 'held' end state, least(n, coalesce(bar, n)) stored from f")
def floor_ratchet(t: Tables) -> DataFrame:
    e, n = F.col("event_type"), F.col("n")
    rows = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("bar", F.when(e == "error", n).when(e == "click", n - 1).when(e == "view", n + 5))
    return rows.select("event_type", L.floor_state(n, F.col("bar")).alias("state"), F.least(n, F.coalesce("bar", n)).alias("stored"))


@R.add("q167_refresh", "with p as (select doc_id, lang from documents where doc_id % 3 = 0) select d.doc_id, coalesce(case when d.doc_id % 2 = 0 then d.lang end, p.lang) lang, d.doc_id % 2 = 1 and p.lang is not null patched from documents d left join p using (doc_id)")
def refresh(t: Tables) -> DataFrame:
    """Fields that became known fill rows that lack them; what a row has already stays."""
    base = t.documents.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("own"))
    late = t.documents.where("doc_id % 3 = 0").select("doc_id", F.col("lang").alias("late"))
    rows = base.join(late, "doc_id", "left")
    return rows.select("doc_id", F.coalesce("own", "late").alias("lang"), ((F.col("doc_id") % 2 == 1) & F.col("late").isNotNull()).alias("patched"))


_RANK = "case when {0} >= 400000 then 5 when {0} >= 200000 then 4 when {0} >= 100000 then 3 when {0} >= 10000 then 2 else 1 end"


@R.add("q168_entry_pass", f"with c as (select o_custkey, max(o_totalprice) top from orders group by 1), b as (select o_custkey, o_orderkey, o_totalprice, o_orderstatus, row_number() over (partition by o_custkey order by o_orderkey) - 1 idx from orders), a as (select o_custkey, idx, case when o_orderstatus = 'P' then 'unknown room' else 'Room ' || o_orderstatus end room, case when o_orderkey % 4 <> 0 then {_RANK.format('o_totalprice * 2')} end rank from b) select o_orderkey, case when room in ('Room F', 'Room O') then room else 'unclassified' end room, case when rank is null then 'unassayed' else 'M' || least(rank, {_RANK.format('top')}) end band from b join a using (o_custkey, idx) join c using (o_custkey)")
def entry_pass(t: Tables) -> DataFrame:
    """Judgements come back by batch and index; rooms are validated, no evidence gives no band, and a band never passes its source's ceiling."""
    idx = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    batch = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus", idx.alias("idx"))
    ceiling = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("top"))
    floors = [0.0, 1e4, 1e5, 2e5, 4e5]
    rank = lambda c: N.band(c, floors) + 1
    room = F.when(F.col("o_orderstatus") == "P", "unknown room").otherwise(F.concat(F.lit("Room "), F.col("o_orderstatus")))
    answers = batch.select("o_custkey", "idx", room.alias("room"), F.when(F.col("o_orderkey") % 4 != 0, rank(F.col("o_totalprice") * 2)).alias("rank"))
    rows = batch.join(answers, ["o_custkey", "idx"]).join(ceiling, "o_custkey")
    band = F.when(F.col("rank").isNull(), "unassayed").otherwise(F.concat(F.lit("M"), F.least(F.col("rank"), rank(F.col("top"))).cast("string")))
    return rows.select("o_orderkey", F.when(F.col("room").isin("Room F", "Room O"), F.col("room")).otherwise("unclassified").alias("room"), band.alias("band"))


@R.add("q169_admission", f"with {_ENTRIES_SQL}, s as (select source, count(*) n, count(*) filter (where coalesce(catalogued, false) or excluded is not null) / count(*)::double settled, count(*) filter (where catalogued) / greatest(1, count(*) filter (where excluded is null))::double cited from entries group by 1) select source, case when settled < 0.2 then 'unsettled' when cited < 0.22 then 'uncited' else 'admitted' end verdict from s")
def admission(t: Tables) -> DataFrame:
    """Sources are written up only when enough of their entries are settled, then cited."""
    c, x = F.coalesce(F.col("catalogued"), F.lit(False)), F.col("excluded")
    s = _entries(t).groupBy("source").agg((F.count_if(L.entry_settled(c, x)) / F.count(F.lit(1))).alias("settled"), (F.count_if(c) / F.greatest(F.lit(1), F.count_if(x.isNull()))).alias("cited"))
    return s.select("source", F.when(F.col("settled") < 0.2, "unsettled").when(F.col("cited") < 0.22, "uncited").otherwise("admitted").alias("verdict"))


@R.add("q170_work_queue", f"with {_ENTRIES_SQL}, h as (select page_id doc_id, {_HOST_SQL} host from pages), q as (select e.doc_id, e.source, host, n_chars, case when host is null then 2 when coalesce(catalogued, false) then 1 else 0 end tier from entries e left join h using (doc_id) where excluded is null) select doc_id, tier, row_number() over (partition by source order by tier, n_chars desc, doc_id) place from q")
def work_queue(t: Tables) -> DataFrame:
    """Entries with their host and evidence, in order of priority within a source."""
    hosts = t.pages.select(F.col("page_id").alias("doc_id"), T.url_host("url").alias("host"))
    rows = _entries(t).where("excluded is null").join(hosts, "doc_id", "left")
    tier = F.when(F.col("host").isNull(), 2).when(F.coalesce("catalogued", F.lit(False)), 1).otherwise(0)
    rows = rows.select("doc_id", "source", "n_chars", tier.alias("tier"))
    return W.places(rows, ["source"], ["tier", F.desc_nulls_last("n_chars"), "doc_id"]).select("doc_id", "tier", "place")


@R.add("q171_resync", "with r as (select source, count(*) n, max(doc_id) last from documents where doc_id % 9 <> 0 group by 1), i as (select source, count(*) n, max(doc_id) last from documents where n_chars > 300 group by 1) select coalesce(r.source, i.source) source, coalesce(i.n, 0) indexed, coalesce(r.n, 0) recorded, case when i.n is null then 'missing' when r.n is null then 'orphan' when i.n <> r.n then 'stale' when i.last <> r.last then 'moved' else 'ok' end state from r full join i using (source)")
def resync(t: Tables) -> DataFrame:
    """An index against the records it was made from."""
    count = lambda df, n, l: df.groupBy("source").agg(F.count(F.lit(1)).alias(n), F.max("doc_id").alias(l))
    both = count(t.documents.where("doc_id % 9 <> 0 and source is not null"), "r", "rl").join(count(t.documents.where("n_chars > 300 and source is not null"), "i", "il"), "source", "full_outer")
    state = F.when(F.col("i").isNull(), "missing").when(F.col("r").isNull(), "orphan").when(F.col("i") != F.col("r"), "stale").when(F.col("il") != F.col("rl"), "moved").otherwise("ok")
    return both.select("source", F.coalesce("i", F.lit(0)).alias("indexed"), F.coalesce("r", F.lit(0)).alias("recorded"), state.alias("state"))


@R.add("q172_failures", "with f as (select 'E' || (value::bigint % 6) kind, ts, event_id from events where event_type = 'error'), r as (select *, row_number() over (partition by kind order by ts, event_id) k from f) select kind, count(*) n, string_agg(event_id::varchar, ',' order by k) filter (where k <= 3) samples from r group by 1")
def failures(t: Tables) -> DataFrame:
    """Failures by class with their first three samples; classes are counted map-side, samples are the least three of each task."""
    f = t.events.where("event_type = 'error'").select(F.concat(F.lit("E"), (F.rint("value").cast("long") % 6).cast("string")).alias("kind"), "ts", "event_id")
    k = F.row_number().over(Window.partitionBy("kind").orderBy("ts", "event_id"))
    first = f.withColumn("k", k).where("k <= 3").groupBy("kind").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "event_id"))), lambda x: x["event_id"].cast("string")), ",").alias("samples"))
    return f.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).join(first, "kind")


@R.add("q173_retention", "with m as (select max(ts) now from events) select event_id, ts from events, m where ts > now - interval 24 hour order by ts desc, event_id desc limit 2000")
def retention(t: Tables) -> DataFrame:
    """What a history of 24 hours and 2,000 rows at most still holds."""
    return retained(t.events.select("event_id", "ts"), "ts", 24, 2000, "event_id")


@R.add("q174_superseded", f"with p as (select page_id, {_HOST_SQL} host, case when length(html) < 1500 then 'no wiki markup' end refused, case when page_id % 3 = 0 then 'name-match' end attribution, case page_id % 4 when 1 then 1 when 2 then 2 end marker from pages) select page_id, case when host like 'www.%' then false else coalesce(contains(refused, 'no wiki markup'), false) end old_gate, host not like 'www.%' and attribution is distinct from 'name-match' no_names, coalesce(marker, 0) < 2 and refused is not null old_marker from p")
def superseded(t: Tables) -> DataFrame:
    """Stored evidence that an older gate, attribution or marker layer made, by its provenance; hosts that read as a wiki are exempt from the first two."""
    k = F.col("page_id")
    rows = t.pages.select("page_id", T.url_host("url").startswith("www.").alias("wiki"), F.when(F.length("html") < 1500, "no wiki markup").alias("refused"), F.struct(F.when(k % 3 == 0, "name-match").alias("attribution"), F.when(k % 4 == 1, 1).when(k % 4 == 2, 2).alias("marker")).alias("mined_under"))
    old_gate = ~F.col("wiki") & F.coalesce(F.contains("refused", F.lit("no wiki markup")), F.lit(False))
    no_names = ~F.col("wiki") & ~F.col("mined_under.attribution").eqNullSafe("name-match")
    return rows.select("page_id", old_gate.alias("old_gate"), no_names.alias("no_names"), ((F.coalesce("mined_under.marker", F.lit(0)) < 2) & F.col("refused").isNotNull()).alias("old_marker"))


@R.add("q175_regate", "with g as (select p_partkey, 'M' || (p_size % 6) held, case when p_retailprice < 930 then null when p_retailprice < 960 then 'M' || ((p_size % 6) - 1) else 'M' || (p_size % 6) end now from part) select case when now is null then 'cleared' when now = held then 'survives' else 'demoted' end outcome, count(*) n, min(p_partkey) first from g group by 1")
def regate(t: Tables) -> DataFrame:
    """A gate applied again to stored bands: which survive, are demoted, or lose their note."""
    held, k = F.col("p_size") % 6, F.col("p_retailprice")
    now = F.when(k < 930, F.lit(None)).when(k < 960, held - 1).otherwise(held)
    outcome = F.when(now.isNull(), "cleared").when(now == held, "survives").otherwise("demoted")
    return t.part.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first"))


@R.add("q176_progress", "with l as (select user_id, ts, event_id, 'done ' || (value::bigint) || ' of 60' line from events where event_type in ('view', 'click')), m as (select user_id, max_by(line, (ts, event_id)) line from l group by 1) select user_id, regexp_extract(line, 'done ([0-9]+)', 1)::int / regexp_extract(line, 'of ([0-9]+)', 1)::double share from m")
def progress(t: Tables) -> DataFrame:
    """The share of a job that its latest log line reports."""
    line = F.concat(F.lit("done "), F.rint("value").cast("long").cast("string"), F.lit(" of 60"))
    last = t.events.where("event_type in ('view', 'click')").groupBy("user_id").agg(F.max_by(line, F.struct("ts", "event_id")).alias("line"))
    return last.select("user_id", (F.regexp_extract("line", "done ([0-9]+)", 1).cast("int") / F.regexp_extract("line", "of ([0-9]+)", 1).cast("double")).alias("share"))


_WHERES = ["src/a.py:10-20", "see a.py:15 and b.py", "x\\\\a.py:12", "no file", "b.py:9-3, src/b.py:5"]


@R.add("q177_where_targets", "with w(k, file, a, z) as (values (0, 'a.py', 10, 20), (1, 'a.py', 15, 15), (1, 'b.py', null, null), (2, 'x/a.py', 12, 12), (4, 'b.py', 3, 9), (4, 'b.py', 5, 5)) select event_type, file, a first, z last, count(*) n from events join w on k = event_id % 5 group by all")
def where_targets(t: Tables) -> DataFrame:
    """Places named in free text, by kind."""
    where = F.get(F.array(*[F.lit(w.replace("\\\\", "\\")) for w in _WHERES]), (F.col("event_id") % 5).cast("int"))
    spans = t.events.select("event_type", F.explode(L.where_spans(where)).alias("s"))
    return spans.groupBy("event_type", "s.file", "s.first", "s.last").agg(F.count(F.lit(1)).alias("n"))


@R.add("q178_produced_expected", "with e as (select n_nationkey k, case when n_nationkey % 2 = 0 then 'even' else 'odd' end kind from nation), p as (select c_nationkey k, case when count(*) % 2 = 0 then 'even' else 'odd' end kind from customer where c_acctbal > 9700 group by 1) select coalesce(e.k, p.k) k, case when p.k is null then 'missing' when e.k is null then 'unexpected' when e.kind <> p.kind then 'wrong kind' else 'ok' end state from e full join p using (k)")
def produced_expected(t: Tables) -> DataFrame:
    parity = lambda c: F.when(c % 2 == 0, "even").otherwise("odd")
    e = t.nation.select(F.col("n_nationkey").alias("k"), parity(F.col("n_nationkey")).alias("expected"))
    p = t.customer.where("c_acctbal > 9700").groupBy(F.col("c_nationkey").alias("k")).agg(parity(F.count(F.lit(1))).alias("made"))
    state = F.when(F.col("made").isNull(), "missing").when(F.col("expected").isNull(), "unexpected").when(F.col("made") != F.col("expected"), "wrong kind").otherwise("ok")
    return e.join(p, "k", "full_outer").select("k", state.alias("state"))


@R.add("q179_vacuous_rules", "with r(rule, kind) as (values ('r1', 'error'), ('r2', 'view'), ('r3', 'refund'), ('r4', 'chargeback')), n as (select event_type kind, count(*) n from events group by 1) select rule, coalesce(n, 0) applied, n is null vacuous from r left join n using (kind)")
def vacuous_rules(t: Tables) -> DataFrame:
    """Rules that never met a row they could judge."""
    rules = t.spark.createDataFrame([("r1", "error"), ("r2", "view"), ("r3", "refund"), ("r4", "chargeback")], "rule string, event_type string")
    n = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return rules.join(n, "event_type", "left").select("rule", F.coalesce("n", F.lit(0)).alias("applied"), F.col("n").isNull().alias("vacuous"))


@R.add("q180_cited_names", "select distinct p_name from part where exists (select 1 from lineitem where l_partkey = p_partkey and l_quantity >= 50 and l_discount >= 0.1)")
def cited_names(t: Tables) -> DataFrame:
    cited = t.lineitem.where("l_quantity >= 50 and l_discount >= 0.1").select(F.col("l_partkey").alias("p_partkey"))
    return t.part.select("p_partkey", "p_name").join(cited, "p_partkey", "left_semi").select("p_name").distinct()


@R.add("q181_top_remainder", "with c as (select p_type k, count(*) n from part group by 1), r as (select *, row_number() over (order by n desc, k) i from c) select case when i <= 4 then k else '(others)' end k, sum(n)::bigint n, count(*) kinds from r group by 1")
def top_remainder(t: Tables) -> DataFrame:
    """The four most frequent, and how many others there are with their total: nothing is dropped unsaid."""
    c = t.part.groupBy(F.col("p_type").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    top = c.orderBy(F.desc("n"), "k").limit(4)
    rest = c.join(top, "k", "left_anti").agg(F.lit("(others)").alias("k"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).where("kinds > 0")
    return top.withColumn("kinds", F.lit(1).cast("long")).unionByName(rest)
