"""Queries over texts, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions import numeric as N
from quarryline.functions import text as T
from quarryline.operators import joins as J
from quarryline.operators import windows as W
from quarryline.operators.matching import dice_pairs
from quarryline.operators.passages import passages_in
from quarryline.plans.base import Registry, Tables
from quarryline.plans.coverage import _HTML_SQL

R = Registry()

R.add("q33_verbatim", "select d.doc_id, b.item_id from documents d join benchmark b on contains(d.text, b.text)")(lambda t: passages_in(t.documents, t.benchmark))


@R.add("q34_token_overlap", r"""with d as (select doc_id, list_distinct(list_filter(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: length(w) >= 8)) a from documents),
 i as (select item_id, list_distinct(list_filter(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: length(w) >= 8)) b from benchmark)
 select doc_id, item_id, len(list_intersect(a, b)) / least(len(a), len(b)) overlap from d, i where len(list_intersect(a, b)) > 0 and len(list_intersect(a, b)) / least(len(a), len(b)) > 0.6""")
def token_overlap(t: Tables) -> DataFrame:
    """Pairs meet through shared tokens, so that texts with none in common are never compared."""
    d = t.documents.select("doc_id", T.tokens("text", 8).alias("a"))
    i = t.benchmark.select("item_id", T.tokens("text", 8).alias("b"))
    da, ib = d.select("doc_id", F.size("a").alias("na"), F.explode("a").alias("token")), i.select("item_id", F.size("b").alias("nb"), F.explode("b").alias("token"))
    shared = da.join(ib, "token").groupBy("doc_id", "item_id", "na", "nb").agg(F.count(F.lit(1)).alias("n"))
    return shared.select("doc_id", "item_id", (F.col("n") / F.least("na", "nb")).alias("overlap")).where("overlap > 0.6")


_FURNITURE = "nav|aside|footer|header|form|table"


@R.add("q35_paragraphs", r"""with h as (select page_id, regexp_replace(html, '(?is)<(nav|aside|footer|header|form|table)\b.*?</(nav|aside|footer|header|form|table)>', ' ', 'g') h from pages), r as (select page_id, unnest(regexp_extract_all(h, '(?is)<p\b[^>]*>(.*?)(?:</p>|$)', 1)) x from h),
 p as (select page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) para from r)
 select page_id, count(*) paragraphs, sum(length(para))::bigint chars from p where length(para) >= 45 and contains(para, '.') and not starts_with(para, '"') group by 1""")
def paragraphs(t: Tables) -> DataFrame:
    """Paragraphs outside furniture, inline tags off, of 45 characters and more with a full stop, and not quotations."""
    body = F.regexp_replace("html", rf"(?is)<({_FURNITURE})\b.*?</({_FURNITURE})>", " ")
    rows = t.pages.select("page_id", F.explode(F.regexp_extract_all(body, F.lit(r"(?is)<p\b[^>]*>(.*?)(?:</p>|$)"), F.lit(1))).alias("raw"))
    para = F.regexp_replace("raw", "<[^>]*>", " ")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        para = F.replace(para, F.lit(name), F.lit(char))
    para = F.regexp_replace(para, r"\s+", " ")
    rows = rows.select("page_id", F.trim(para).alias("para"))
    return rows.where("length(para) >= 45 and contains(para, '.') and not startswith(para, '\"')").groupBy("page_id").agg(F.count(F.lit(1)).alias("paragraphs"), F.sum(F.length("para")).alias("chars"))


R.add("q36_html_text", f"select page_id, length({_HTML_SQL}) chars from pages")(lambda t: t.pages.select("page_id", F.length(T.html_text("html")).cast("long").alias("chars")))


@R.add("q37_url_host", """with h as (select regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) host from pages), r as (select host, array_to_string(string_split(host, '.')[-2:], '.') domain from h),
 c as (select domain, host, count(*) n from r group by 1, 2), k as (select *, row_number() over (partition by domain order by n desc, host) i, count(*) over (partition by domain) hosts from c) select domain, host, n, hosts from k where i = 1""")
def url_host(t: Tables) -> DataFrame:
    hosts = t.pages.select(T.url_host("url").alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("n")).withColumn("domain", T.registrable("host"))
    w = Window.partitionBy("domain")
    return hosts.withColumn("i", F.row_number().over(w.orderBy(F.desc("n"), "host"))).withColumn("hosts", F.count(F.lit(1)).over(w)).where("i = 1").select("domain", "host", "n", "hosts")


_UNITS_SQL = r"list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '([.!?])[ \t]+', E'\\1\n', 'g'), E'\n+', E'\n', 'g'), E'\n'), lambda s: trim(s)), lambda s: length(s) > 0)"


@R.add("q38_units", f"""with u as (select doc_id, unnest({_UNITS_SQL}) s from documents)
 select doc_id, count(*) filter (where length(s) > 20 and length(s) < 400) kept, count(*) filter (where length(s) <= 20) short, count(*) filter (where length(s) >= 400) long, max(length(s)) longest from u group by doc_id""")
def units(t: Tables) -> DataFrame:
    n = F.length("s")
    rows = t.documents.select("doc_id", F.explode(T.sentences("text")).alias("s"))
    return rows.groupBy("doc_id").agg(F.count_if((n > T.UNIT_SHORT) & (n < T.UNIT_LONG)).alias("kept"), F.count_if(n <= T.UNIT_SHORT).alias("short"), F.count_if(n >= T.UNIT_LONG).alias("long"), F.max(n).cast("long").alias("longest"))


#: Cue patterns of the sentence gate: (axis, pattern).
def word(pattern: str) -> str:
    """A word of plain letters; spelled out because engines differ on word boundaries beside accented letters."""
    return f"(?:^|[^a-z])(?:{pattern})(?:[^a-z]|$)"


AXES = [*((a, word(p)) for a, p in (("the", "the"), ("and", "and"), ("of", "of"), ("le", "les?"), ("der", "der"))), ("number", "[0-9]{3,}")]


@R.add("q39_axis_gate", f"""with u as (select doc_id, unnest({_UNITS_SQL}) s from documents), k as (select * from u where length(s) > 20 and length(s) < 400 and not contains(s, '|')), a(axis, pattern) as (values {', '.join(f"('{a}', '{p}')" for a, p in AXES)})
 select axis, count(*) hits, count(distinct doc_id) docs from k, a where regexp_matches(lower(s), pattern) group by axis""")
def axis_gate(t: Tables) -> DataFrame:
    """Sentence by axis: the pattern table is a fixed list, so it becomes one array of matches instead of a join."""
    n = F.length("s")
    kept = t.documents.select("doc_id", F.explode(T.sentences("text")).alias("s")).where((n > T.UNIT_SHORT) & (n < T.UNIT_LONG) & ~F.contains("s", F.lit("|")))
    hits = F.array_compact(F.array(*[F.when(F.lower("s").rlike(p), F.lit(a)) for a, p in AXES]))
    return kept.select("doc_id", F.explode(hits).alias("axis")).groupBy("axis").agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("doc_id").alias("docs"))


@R.add("q40_openers", r"""with o as (select lang, array_to_string(list_filter(string_split_regex(lower(text), '[ \t\n\r]+'), lambda w: length(w) > 0)[1:4], ' ') opener from documents), c as (select lang, opener, count(*) n from o group by 1, 2),
 a as (select lang, count(*) openers, max(n) most, sum(n) filter (where n > 1) / sum(n)::double repeat_share from c group by lang), d as (select lang, sum(len(regexp_extract_all(text, '[-–—]')))::double / count(*) dashes, count(*) filter (where regexp_matches(text, '[?!]\s*$')) / count(*)::double turns from documents group by 1),
 w as (select lang, count(distinct w) vocabulary from (select lang, unnest(regexp_extract_all(lower(text), '\p{L}{6,}')) w from documents) group by 1)
 select a.lang, openers, most, repeat_share, dashes, turns, vocabulary from a join d on d.lang is not distinct from a.lang left join w on w.lang is not distinct from a.lang""")
def openers(t: Tables) -> DataFrame:
    """A style audit by language: openers and how often they repeat, dashes a text, endings in a question or a shout, and words of six letters and more."""
    counts = t.documents.select("lang", T.opener("text").alias("opener")).groupBy("lang", "opener").agg(F.count(F.lit(1)).alias("n"))
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")))
    a = counts.groupBy("lang").agg(F.count(F.lit(1)).alias("openers"), F.max("n").alias("most"), (repeated / F.sum("n")).alias("repeat_share"))
    d = t.documents.groupBy(F.col("lang").alias("l")).agg((F.sum(F.regexp_count("text", F.lit("[-–—]"))) / F.count(F.lit(1))).alias("dashes"), (F.count_if(F.col("text").rlike(r"[?!]\s*$")) / F.count(F.lit(1))).alias("turns"))
    words = t.documents.select("lang", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{6,}"), F.lit(0)))).alias("w")).distinct()
    v = words.groupBy(F.col("lang").alias("k")).agg(F.count(F.lit(1)).alias("vocabulary"))
    rows = a.join(d, F.col("lang").eqNullSafe(F.col("l"))).join(v, F.col("lang").eqNullSafe(F.col("k")), "left")
    return rows.select("lang", "openers", "most", "repeat_share", "dashes", "turns", "vocabulary")


#: Surface patterns counted a document: (name, pattern).
TELLS = [("shout", "[A-Z]{4,}"), ("exclaim", "!+"), ("bars", r" \| "), ("digits", "[0-9]{4,}"), ("symbols", "[*#$%&]{3}")]


@R.add("q41_tells", "select doc_id, " + ", ".join(f"len(regexp_extract_all(text, '{p}')) {n}" for n, p in TELLS) + " from documents")
def tells(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", *[F.regexp_count("text", F.lit(p)).cast("long").alias(n) for n, p in TELLS])


#: Line-level detectors: (kind, pattern).
SECRETS = [("email", r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+\.[A-Za-z]+"), ("assignment", r"token = \"[0-9a-f]{40}\""), ("card", r"\b[0-9]{16}\b"), ("address", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b")]


@R.add("q42_secret_lines", r"""with l as (select doc_id, unnest(string_split(text, E'\n')) line, generate_subscripts(string_split(text, E'\n'), 1) n from documents), k(kind, pattern) as (values """ + ", ".join(f"('{k}', '{p.replace(chr(92) + chr(34), chr(34))}')" for k, p in SECRETS) + """)
 select distinct doc_id, n line, kind from l, k where regexp_matches(line, pattern)""")
def secret_lines(t: Tables) -> DataFrame:
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "text_line"))
    kinds = F.array_compact(F.array(*[F.when(F.col("text_line").rlike(p), F.lit(k)) for k, p in SECRETS]))
    return lines.select("doc_id", (F.col("n") + 1).cast("long").alias("line"), F.explode(kinds).alias("kind")).distinct()


@R.add("q43_entropy", """with c as (select doc_id, unnest(string_split(text, '')) ch from documents), n as (select doc_id, ch, count(*) n from c group by 1, 2), s as (select *, sum(n) over (partition by doc_id) total from n)
 select doc_id, -sum(n / total * log2(n / total)) bits from s group by doc_id""")
def entropy(t: Tables) -> DataFrame:
    """Of the whole text; counted by letters, which adds up map-side."""
    letters = t.documents.select("doc_id", F.explode(F.split("text", "")).alias("ch")).where("ch <> ''").groupBy("doc_id", "ch").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("doc_id"))
    return letters.withColumn("p", F.col("n") / total).groupBy("doc_id").agg((-F.sum(F.col("p") * F.log2("p"))).alias("bits"))


_PARTS = [(1 + 16 * k, 15) for k in range(4)]


@R.add("q44_digest", "with d as (select source, sha256(text) d from documents) select source, count(*) docs, sha256(concat_ws('/', count(*), " + ", ".join(f"coalesce(sum(('0x' || substr(d, {a}, {n}))::bigint), 0)" for a, n in _PARTS) + ")) rolled from d group by source")
def digest(t: Tables) -> DataFrame:
    """Roll-up digest of a source's texts in any order: four sums of 60-bit pieces of their digests, digested; sums add up map-side."""
    d = t.documents.select("source", F.sha2("text", 256).alias("d"))
    number = lambda a, n: F.conv(F.substring("d", a, n), 16, 10).cast("decimal(38,0)")
    sums = [F.coalesce(F.sum(number(a, n)), F.lit(0).cast("decimal(38,0)")).cast("string") for a, n in _PARTS]
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sha2(F.concat_ws("/", F.count(F.lit(1)).cast("string"), *sums), 256).alias("rolled"))


@R.add("q45_seed", "select p_partkey, ('0x' || substr(sha256(p_name || '/' || p_partkey), 1, 8))::bigint seed, ('0x' || substr(sha256(p_name || '/' || p_partkey), 1, 8))::bigint % 7 choice from part")
def seed(t: Tables) -> DataFrame:
    s = N.hash_seed(F.concat("p_name", F.lit("/"), F.col("p_partkey").cast("string")))
    return t.part.select("p_partkey", s.alias("seed"), (s % 7).alias("choice"))


@R.add("q46_pack_budget", """with recursive d as (select source, doc_id, n_chars, row_number() over (partition by source order by doc_id) i from documents where source is not null),
 r as (select source, 0::bigint i, null::bigint doc_id, null::bigint n_chars, 0::bigint held, 0::bigint block from (select distinct source from d) union all
 select d.source, d.i, d.doc_id, d.n_chars, case when held > 0 and held + d.n_chars > 20000 then d.n_chars else held + d.n_chars end, case when held > 0 and held + d.n_chars > 20000 then block + 1 else block end from r join d on d.source = r.source and d.i = r.i + 1)
 select source, doc_id, n_chars, block from r where i > 0""")
def pack_budget(t: Tables) -> DataFrame:
    return W.pack_budget(t.documents.where("source is not null"), "source", "doc_id", "n_chars", 20_000)


@R.add("q47_chunks", """with f as (select source, doc_id, n_chars, length(text) - length(replace(text, '!', '')) feats from documents), r as (select source, doc_id, row_number() over (partition by source order by feats desc, n_chars desc, doc_id) n from f) select source, (n - 1) // 14 block, min(n) "first", max(n) "last", count(*) "rows" from r group by 1, 2""")
def chunks(t: Tables) -> DataFrame:
    """Blocks of fourteen for a synthesis: those that bear most first, the rest by length."""
    feats = F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))
    return W.blocks(t.documents.select("source", "doc_id", "n_chars", feats.alias("feats")), ["source"], [F.desc("feats"), F.desc("n_chars"), "doc_id"], 14)


#: Weighted cues of the language classifier: (label, pattern, weight).
CUES = [("en", word("the"), 1), ("en", word("and"), 1), ("fr", word("les?"), 1), ("fr", word("des?"), 1), ("de", word("der|die"), 2), ("es", word("los|que"), 1)]
LABELS = ["en", "fr", "de", "es"]


def _cue_sql() -> str:
    sums = {label: " + ".join(f"{w} * len(regexp_extract_all(lower(text), '{p}'))" for lab, p, w in CUES if lab == label) for label in LABELS}
    scores = ", ".join(f"({s}) {label}" for label, s in sums.items())
    tests = " ".join(f"when {label} = greatest({', '.join(LABELS)}) then '{label}'" for label in LABELS)
    return f"""with s as (select doc_id, {scores} from documents), t as (select *, {' + '.join(LABELS)} total from s)
 select doc_id, case when total < 6 then 'unclassified' {tests} end label, case when total > 0 then greatest({', '.join(LABELS)}) / total::double end confidence from t"""


@R.add("q57_cue_classifier", _cue_sql())
def cue_classifier(t: Tables) -> DataFrame:
    """Top cue score; ties go to the label declared first; under a total of 6 nothing is claimed."""
    low = F.lower("text")
    score = {label: sum((F.regexp_count(low, F.lit(p)) * w for lab, p, w in CUES if lab == label), F.lit(0)) for label in LABELS}
    rows = t.documents.select("doc_id", *[s.alias(label) for label, s in score.items()])
    best, total = F.greatest(*LABELS), sum((F.col(x) for x in LABELS), F.lit(0))
    label = F.when(total < 6, "unclassified")
    for x in LABELS:
        label = label.when(F.col(x) == best, x)
    return rows.select("doc_id", label.alias("label"), F.try_divide(best.cast("double"), total.cast("double")).alias("confidence"))


@R.add("q58_host_fit", """with p as (select regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) host, regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1) lang from pages), c as (select count(*) filter (where lang = 'en') / count(*)::double control from p),
 h as (select host, count(*) n, count(*) filter (where lang = 'en') / count(*)::double rate from p group by host)
 select host, n, rate, rate - control lift, case when n < 5 then 'unverifiable' when rate < 0.05 then 'dead' when rate - control >= 0.25 then 'fits' when rate - control >= 0.05 then 'leans' else 'control' end verdict from h, c""")
def host_fit(t: Tables) -> DataFrame:
    p = t.pages.select(T.url_host("url").alias("host"), (F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z][a-z])/", 1) == "en").alias("hit"))
    hosts = p.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits"))
    control = hosts.agg((F.sum("hits") / F.sum("n")).alias("control"))
    rate = F.col("hits") / F.col("n")
    lift = rate - F.col("control")
    verdict = F.when(F.col("n") < 5, "unverifiable").when(rate < 0.05, "dead").when(lift >= 0.25, "fits").when(lift >= 0.05, "leans").otherwise("control")
    return hosts.crossJoin(control).select("host", "n", rate.alias("rate"), lift.alias("lift"), verdict.alias("verdict"))  # control is one row


@R.add("q74_empty_rate", f"""with p as (select regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) host, length({_HTML_SQL}) n from pages), r as (select host, count(*) pages, count(*) filter (where n < 1200) / count(*)::double rate from p group by 1)
 select host, pages, rate from r where rate >= 2 * 0.086::double""")
def empty_rate(t: Tables) -> DataFrame:
    rows = t.pages.select(T.url_host("url").alias("host"), (F.length(T.html_text("html")) < 1200).cast("double").alias("empty"))
    return rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.avg("empty").alias("rate")).where(F.col("rate") >= 2 * 0.086)


@R.add("q81_turn_delta", "select conv_id, turn, length(text) - lag(length(text)) over (partition by conv_id order by turn) delta, role = lag(role) over (partition by conv_id order by turn) same_role from conversations")
def turn_delta(t: Tables) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    n = F.length("text").cast("long")
    return t.conversations.select("conv_id", "turn", (n - F.lag(n).over(w)).alias("delta"), (F.col("role") == F.lag("role").over(w)).alias("same_role"))


@R.add("q82_stored_cut", "select doc_id, case when length(text) > 120 then left(text, 120) || ' [+' || (length(text) - 120) || ' chars]' else text end stored, length(text) = 120 at_cap from documents")
def stored_cut(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.stored_cut("text", 120).alias("stored"), (F.length("text") == 120).alias("at_cap"))


@R.add("q83_keys", r"""select p_partkey, regexp_replace(lower(regexp_replace(p_name, '\s*\([^)]*\)\s*$', '')), '[^a-z0-9]', '', 'g') key, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') slug, ceil(length(p_name) / 4.0::double)::bigint tokens from part""")
def keys(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", T.name_key("p_name").alias("key"), T.slug("p_type").alias("slug"), T.estimate_tokens("p_name").alias("tokens"))


@R.add("q84_dice", """with k as (select distinct regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') k from part), g as (select k, unnest(list_transform(range(1, length(k)), lambda i: k[i:i+1])) x from k), c as (select k, x, count(*) m from g group by 1, 2), s as (select k, sum(m) t from c group by 1)
 select a.k a, b.k b, 2.0::double * sum(least(a.m, b.m)) / (any_value(sa.t) + any_value(sb.t)) dice from c a join c b on a.x = b.x and a.k < b.k join s sa on sa.k = a.k join s sb on sb.k = b.k group by 1, 2 having 2.0::double * sum(least(a.m, b.m)) / (any_value(sa.t) + any_value(sb.t)) >= 0.5""")
def dice(t: Tables) -> DataFrame:
    """All pairs of name keys whose Dice coefficient is a half or more."""
    keys = t.part.select(T.name_key("p_name").alias("a")).distinct()
    pairs = dice_pairs(keys, keys.select(F.col("a").alias("b")), 0.5).where("a < b")
    return pairs.select("a", "b", T.dice("a", "b").alias("dice"))


@R.add("q85_first_text_wins", r"""with k as (select doc_id, source, sha256(regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g')) key, n_chars from documents), r as (select *, row_number() over (partition by source, key order by n_chars > 0 desc, doc_id) i from k) select doc_id, source, key from r where i = 1""")
def first_text_wins(t: Tables) -> DataFrame:
    keyed = t.documents.select("doc_id", "source", F.sha2(T.letters_key("text"), 256).alias("key"), "n_chars")
    return J.first_wins(keyed, ["source", "key"], [F.desc(F.col("n_chars") > 0), "doc_id"]).select("doc_id", "source", "key")
