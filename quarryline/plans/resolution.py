"""Queries that resolve entities, expand threads, check scales and describe worlds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions import lifecycle as L
from quarryline.functions import rules as K
from quarryline.functions import text as T
from quarryline.functions.spans import after_first_sentence
from quarryline.functions.subjects import Patterns, forms, subject_refusals
from quarryline.operators import joins as J
from quarryline.operators import mining as M
from quarryline.operators import stats as S
from quarryline.operators import windows as W
from quarryline.plans.base import Registry, Tables

R = Registry()

# --- attestations: parts as entries of their brand; continuity groups are the brands' first digit.
_HITS_SQL = "h as (select p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') key, case when p_partkey % 3 = 0 then upper(p_name) else p_name end nm, p_brand source, substr(p_brand, 7, 1) g, p_type topic, case when p_size % 4 = 0 then 'unassayed' else 'M' || p_size % 4 end magnitude from part)"


def _hits(t: Tables) -> DataFrame:
    k = F.col("p_size") % 4
    return t.part.select(
        "p_partkey", T.name_key("p_name").alias("key"), F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("nm"), F.col("p_brand").alias("source"),
        F.substring("p_brand", 7, 1).alias("g"), F.col("p_type").alias("topic"), F.when(k == 0, "unassayed").otherwise(F.concat(F.lit("M"), k.cast("string"))).alias("magnitude"),
    )


@R.add("q182_resolve", f"""with {_HITS_SQL}, n as (select key, g, nm, count(*) c, min(p_partkey) f from h group by 1, 2, 3), m as (select key, g, nm canonical, row_number() over (partition by key, g order by c desc, f) r from n),
 a as (select key, g, count(distinct source) attestations, string_agg(distinct topic, '|' order by topic) topics, coalesce(string_agg(distinct magnitude, '|' order by magnitude) filter (where magnitude <> 'unassayed'), '') bands, count(distinct magnitude) filter (where magnitude <> 'unassayed') > 1 conflict from h group by 1, 2), o as (select key, count(distinct g) > 1 homonym from h group by 1)
 select key, g, canonical, attestations, topics, bands, conflict, homonym from a join m using (key, g) join o using (key) where r = 1""")
def resolve(t: Tables) -> DataFrame:
    """One entity a key and continuity group: its most frequent name (the first of equals), sources, topics, bands and whether they conflict; a key of several groups is a homonym."""
    h = _hits(t)
    names = h.groupBy("key", "g", "nm").agg(F.count(F.lit(1)).alias("c"), F.min("p_partkey").alias("f"))
    canonical = names.groupBy("key", "g").agg(F.min_by("nm", F.struct(-F.col("c"), "f")).alias("canonical"))
    claim = F.when(F.col("magnitude") != "unassayed", F.col("magnitude"))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "|")  # noqa: E731  topics and bands are small vocabularies
    about = h.groupBy("key", "g").agg(F.count_distinct("source").alias("attestations"), listed("topic").alias("topics"), listed(claim).alias("bands"), (F.count_distinct(claim) > 1).alias("conflict"))
    homonym = h.groupBy("key").agg((F.count_distinct("g") > 1).alias("homonym"))
    return about.join(canonical, ["key", "g"]).join(homonym, "key").select("key", "g", "canonical", "attestations", "topics", "bands", "conflict", "homonym")


_DESCRIPTIONS = ["A quiet one of the hills.", "You can take it. You can use it twice.", "You can help out by providing more. It waits.", "You gain a +2 bonus to attack rolls.", "It has 30 hit points and an armor class of 12.", "You know it well, they said."]
_VOICE = r"(?i)you (?:can|gain|know|have|may|must|take)(?: [a-z]+)?"


@R.add("q183_filtered_index", "with d(k, d) as (values " + ", ".join(f"({k}, '{d}')" for k, d in enumerate(_DESCRIPTIONS)) + f"""), {_HITS_SQL}, x as (select key, source, d, regexp_replace(d, '{K.STUB_LINE}', ' ', 'g') s from h join part using (p_partkey) join d on k = (p_partkey + p_size) % 6),
 v as (select key, len(list_distinct(list_transform(regexp_extract_all(s, '{_VOICE}'), lambda z: lower(z)))) voices, regexp_matches(s, '{K.RULES_TERM}') term, regexp_matches(d, '{K.STATBLOCK}') stat from x)
 select key, count(*) hits, count(*) filter (where not (stat or voices >= 2 or (voices >= 1 and term))) kept from v group by 1""")
def filtered_index(t: Tables) -> DataFrame:
    """Attestations of an index that are no game mechanics: no stat block, and no rules voice (two phrases of it, or one beside a rules term). Keys without any left are told by ``kept = 0``."""
    d = F.get(F.array(*[F.lit(x) for x in _DESCRIPTIONS]), F.pmod(F.col("p_partkey") + F.col("p_size"), F.lit(6)).cast("int"))
    rows = t.part.select(T.name_key("p_name").alias("key"), d.alias("d")).withColumn("s", F.regexp_replace("d", K.STUB_LINE, " "))
    voices = F.size(L.banned_terms(F.col("s"), _VOICE))
    mechanic = F.col("d").rlike(K.STATBLOCK) | (voices >= 2) | ((voices >= 1) & F.col("s").rlike(K.RULES_TERM))
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("hits"), F.count_if(~mechanic).alias("kept"))


_THREADS_SQL = f"""with {_HITS_SQL}, c as (select distinct source, topic from h), e as (select p_partkey, source, topic, magnitude <> 'unassayed' claim from h)
 select p_partkey, 'T1' class, source target from e union all select e.p_partkey, 'T2', c.source from e join c on c.topic = e.topic and c.source <> e.source union all select p_partkey, 'T4', 'LAW' from e where claim"""


@R.add("q184_threads", _THREADS_SQL)
def threads(t: Tables) -> DataFrame:
    """All threads of each entry: its own source, the other sources that hold its category, and the law if it claims a magnitude. The store is by (source, category); only this expands it."""
    e = _hits(t).select("p_partkey", "source", "topic", L.asserts_magnitude(F.col("magnitude")).alias("claim"))
    cohorts = e.select(F.col("source").alias("target"), "topic").distinct()
    t1 = e.select("p_partkey", F.lit("T1").alias("class"), F.col("source").alias("target"))
    t2 = e.join(cohorts, "topic").where("target <> source").select("p_partkey", F.lit("T2").alias("class"), "target")
    return t1.union(t2).union(e.where("claim").select("p_partkey", F.lit("T4").alias("class"), F.lit("LAW").alias("target")))


@R.add("q185_edge_totals", f"select count(*) filter (where class = 'T1') entries, count(*) filter (where class = 'T2') t2, count(*) filter (where class = 'T4') t4, count(*) total, round(count(*) / (count(*) filter (where class = 'T1'))::double, 3) per_entry from ({_THREADS_SQL})")
def edge_totals(t: Tables) -> DataFrame:
    """What the graph expands to, by number of entries times degree, without expanding it."""
    e = _hits(t).select("source", "topic", L.asserts_magnitude(F.col("magnitude")).alias("claim"))
    held = e.groupBy("topic", "source").agg(F.count(F.lit(1)).alias("n"), F.count_if("claim").alias("claims"))
    degree = held.groupBy("topic").agg((F.count(F.lit(1)) - 1).alias("degree"))
    x = held.join(degree, "topic").agg(F.sum("n").alias("entries"), F.sum(F.col("n") * F.col("degree")).alias("t2"), F.sum("claims").alias("t4"))
    total = F.col("entries") + F.col("t2") + F.col("t4")
    return x.select("entries", "t2", "t4", total.alias("total"), F.round(total / F.col("entries"), 3).alias("per_entry"))


@R.add("q186_fold_family", """with n as (select p_partkey, replace(p_name, 'e', 'É') || ' “' || p_type || '” — ' || p_brand || '.' s from part) select p_partkey, regexp_replace(lower(s), '[^a-z0-9 ]', ' ', 'g') plain, trim(regexp_replace(regexp_replace(lower(s), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) joined, trim(regexp_replace(replace(replace(replace(s, '“', '"'), '”', '"'), '—', '-'), '\\s+', ' ', 'g')) quoted, lower(strip_accents(s)) folded from n""")
def fold_family(t: Tables) -> DataFrame:
    """A text under the four foldings: letters and digits only, the same with spaces joined, quotes and dashes made plain, diacritics off."""
    s = F.col("s")
    rows = t.part.select("p_partkey", F.concat(F.replace("p_name", F.lit("e"), F.lit("É")), F.lit(" “"), "p_type", F.lit("” — "), "p_brand", F.lit(".")).alias("s"))
    return rows.select("p_partkey", T.plain(s).alias("plain"), T.plain_joined(s).alias("joined"), T.plain_quotes(s).alias("quoted"), T.fold(s).alias("folded"))


@R.add("q187_clean_description", r"""with d as (select p_partkey, '[[' || p_type || '|' || p_name || ']] is ''''''' || p_brand || ''''''' {{cite|x}}<ref>r</ref> ( フランス, Furansu ? ) (Q Who?)  ' d from part)
 select p_partkey, p_name || ' is ' || p_brand || ' (Q Who?)' d from part where p_partkey in (select p_partkey from d)""")
def clean_description(t: Tables) -> DataFrame:
    """Markup off a description; a bracket that explains a foreign spelling goes, one in plain letters stays."""
    d = F.concat(F.lit("[["), "p_type", F.lit("|"), "p_name", F.lit("]] is '''"), "p_brand", F.lit("''' {{cite|x}}<ref>r</ref> ( フランス, Furansu ? ) (Q Who?)  "))
    return t.part.select("p_partkey", T.clean_description(d).alias("d"))


_CEILING_SQL = """with e as (select n_name nm, lower(n_name) low from nation), s as (select s_suppkey, trim(case s_suppkey % 6 when 0 then upper(n_name) when 1 then n_name || ' (of the hills)' when 2 then left(n_name, 6) when 3 then 'nobody at all' when 4 then '' else n_name || ' -- and more' end) ce from supplier join nation on n_nationkey = s_nationkey),
 h as (select *, trim(regexp_extract(ce, '^(.*?)(\\s*[/(,;:].*|\\s+--\\s.*|\\s+—\\s.*)?$', 1)) head from s), p as (select s_suppkey, count(*) n, min(nm) one from h join e on length(ce) >= 6 and starts_with(low, lower(ce)) group by 1)
 select h.s_suppkey, case when ce = '' then ce else coalesce(x.nm, y.nm, case when p.n = 1 then p.one end, ce) end ceiling, case when ce = '' then 'empty' when x.nm is not null then 'exact' when y.nm is not null then 'head' when p.n = 1 then 'prefix' when p.n > 1 then 'prefix-ambiguous' else 'unresolved' end how
 from h left join e x on x.low = lower(ce) left join e y on head <> '' and y.low = lower(head) left join p on p.s_suppkey = h.s_suppkey"""


@R.add("q188_clean_ceiling", _CEILING_SQL)
def clean_ceiling(t: Tables) -> DataFrame:
    """A prose ceiling as the entry it is about: the whole, its head before a delimiter, or the only entry that it begins; several such entries are a guess and refused."""
    k = F.col("s_suppkey") % 6
    n = F.col("n_name")
    prose = F.when(k == 0, F.upper(n)).when(k == 1, F.concat(n, F.lit(" (of the hills)"))).when(k == 2, F.left(n, F.lit(6))).when(k == 3, "nobody at all").when(k == 4, "").otherwise(F.concat(n, F.lit(" -- and more")))
    asked = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.trim(prose).alias("ce"))
    asked = asked.withColumn("head", F.trim(F.split("ce", r"\s*[/(,;:]|\s+--\s+|\s+—\s+")[0]))
    names = t.nation.select(F.col("n_name").alias("nm"), F.lower("n_name").alias("low"))
    exact = names.select(F.col("nm").alias("x"), F.col("low").alias("ex"))
    head = names.select(F.col("nm").alias("y"), F.col("low").alias("hd"))
    six = lambda c: F.left(c, F.lit(6))  # noqa: E731  a prefix of six letters is an equality key
    starts = asked.where(F.length("ce") >= 6).select("s_suppkey", F.lower("ce").alias("l"), six(F.lower("ce")).alias("k")).join(names.withColumn("k", six("low")), "k").where(F.startswith("low", "l"))
    starts = starts.groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n"), F.min("nm").alias("one"))
    rows = asked.join(exact, F.lower("ce") == F.col("ex"), "left").join(head, (F.col("head") != "") & (F.lower("head") == F.col("hd")), "left").join(starts, "s_suppkey", "left")
    how = F.when(F.col("ce") == "", "empty").when(F.col("x").isNotNull(), "exact").when(F.col("y").isNotNull(), "head").when(F.col("n") == 1, "prefix").when(F.col("n") > 1, "prefix-ambiguous").otherwise("unresolved")
    answer = F.when(F.col("ce") == "", F.col("ce")).otherwise(F.coalesce("x", "y", F.when(F.col("n") == 1, F.col("one")), "ce"))
    return rows.select("s_suppkey", answer.alias("ceiling"), how.alias("how"))


@R.add("q189_addresses", """select p_partkey, p_brand || '/' || trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') || case when p_size % 2 = 0 then '#' || p_size || '-' || (p_size + 9) else '' end address, 'Ω › ' || concat_ws(' › ', 'H' || p_size % 3, case when p_size % 5 > 0 then 'X' || p_size % 5 end, case when p_size % 7 > 0 then 'U-' || p_size % 7 end) mark from part""")
def addresses(t: Tables) -> DataFrame:
    """Address strings, and shelf marks that stop where the coordinate does."""
    k = F.col("p_size")
    tier = lambda label, n: F.when(k % n > 0, F.concat(F.lit(label), (k % n).cast("string")))
    page = F.when(k % 2 == 0, F.concat(F.lit("#"), k.cast("string"), F.lit("-"), (k + 9).cast("string"))).otherwise("")
    mark = F.concat(F.lit("Ω › "), F.concat_ws(" › ", F.concat(F.lit("H"), (k % 3).cast("string")), tier("X", 5), tier("U-", 7)))
    return t.part.select("p_partkey", F.concat("p_brand", F.lit("/"), T.slug("p_type"), page).alias("address"), mark.alias("mark"))


_SCALE_SQL = """with sc as (select s_nationkey host, 'cust ' || s_suppkey % 40 nm, max(s_acctbal) val from supplier group by 1, 2), ay as (select c_nationkey host, lower('Cust ' || c_custkey % 40) nm, c_acctbal val, c_custkey k from customer),
 u as (select host, nm, max_by(val, k) val, count(*) n from ay group by 1, 2), j as (select sc.host, sc.nm, sc.val a, u.val b, u.n from sc left join u using (host, nm)),
 r as (select host, b is not null m, n, rank() over (partition by host, b is not null order by a) + (count(*) over (partition by host, b is not null, a) - 1) / 2.0::double x, rank() over (partition by host, b is not null order by b) + (count(*) over (partition by host, b is not null, b) - 1) / 2.0::double y from j)
 select host, count(*) filter (where m) overlap, count(*) filter (where not m) unmatched, count(*) filter (where n > 1) collisions, case when count(*) filter (where m) >= 4 then round(corr(x, y) filter (where m), 9) end rho from r group by 1"""


@R.add("q190_scale_check", _SCALE_SQL)
def scale_check(t: Tables) -> DataFrame:
    """Each host's own scale against the assays of that host only: overlap, names without an assay, keys that several assays share, and rank correlation (null below four)."""
    nm = lambda k: F.concat(F.lit("cust "), (k % 40).cast("string"))
    scale = t.supplier.groupBy(F.col("s_nationkey").alias("host"), nm(F.col("s_suppkey")).alias("nm")).agg(F.max("s_acctbal").alias("a"))
    assays = t.customer.groupBy(F.col("c_nationkey").alias("host"), nm(F.col("c_custkey")).alias("nm")).agg(F.max_by("c_acctbal", "c_custkey").alias("b"), F.count(F.lit(1)).alias("n"))
    j = scale.join(assays, ["host", "nm"], "left")
    about = j.groupBy("host").agg(F.count("b").alias("overlap"), F.count_if(F.col("b").isNull()).alias("unmatched"), F.count_if(F.col("n") > 1).alias("collisions"))
    rho = S.spearman(j, ["host"], "a", "b").select("host", F.round("rho", 9).alias("rho"))
    return about.join(rho, "host", "left")


@R.add("q191_pair_lookup", "with e as (select least(c_nationkey, s_nationkey) a, greatest(c_nationkey, s_nationkey) b, count(*) w from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey where l_quantity = 50 and c_nationkey <> s_nationkey group by 1, 2), q as (select x.n_nationkey a, (x.n_nationkey * 7 + 3) % 25 b from nation x) select q.a, q.b, coalesce(w, 0) weight, w is not null in_resonance from q left join e on e.a = least(q.a, q.b) and e.b = greatest(q.a, q.b)")
def pair_lookup(t: Tables) -> DataFrame:
    """The weight of asked pairs, in whichever order they are asked; pairs without an edge have none."""
    rows = t.lineitem.where("l_quantity = 50").select("l_orderkey", "l_suppkey").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).where("c_nationkey <> s_nationkey")
    edges = rows.groupBy(F.least("c_nationkey", "s_nationkey").alias("lo"), F.greatest("c_nationkey", "s_nationkey").alias("hi")).agg(F.count(F.lit(1)).alias("w"))
    asked = t.nation.select(F.col("n_nationkey").alias("a"), ((F.col("n_nationkey") * 7 + 3) % 25).alias("b")).select("a", "b", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    return asked.join(edges, ["lo", "hi"], "left").select("a", "b", F.coalesce("w", F.lit(0)).alias("weight"), F.col("w").isNotNull().alias("in_resonance"))


@R.add("q192_regress_test", "select c_custkey, case when c_custkey % 3 = 0 or c_custkey % 7 = 0 or c_acctbal < 0 then 'DEMIURGE' when c_custkey % 2 = 0 then 'ONTOLOGICAL CLAIMANT' else 'ORDINARY AGENT' end verdict, not (c_custkey % 3 <> 0 and c_custkey % 7 <> 0 and c_acctbal >= 0 and c_custkey % 2 = 0) assayable from customer")
def regress_test(t: Tables) -> DataFrame:
    """Whatever has a before, a stage or a state space is in the domain; a claimant without any is declined."""
    k = F.col("c_custkey")
    marked = (k % 3 == 0) | (k % 7 == 0) | (F.col("c_acctbal") < 0)
    verdict = F.when(marked, "DEMIURGE").when(k % 2 == 0, "ONTOLOGICAL CLAIMANT").otherwise("ORDINARY AGENT")
    return t.customer.select("c_custkey", verdict.alias("verdict"), (verdict != "ONTOLOGICAL CLAIMANT").alias("assayable"))


@R.add("q193_calibration", "with g as (select c_mktsegment s, avg(c_acctbal) got, 1.96::double * stddev_pop(c_acctbal) / sqrt(count(*)) ci from customer group by 1), p as (select s, round(got / 100) * 100 + case when s = 'BUILDING' then 3000 else 0 end want, 50.0::double pci from g) select s, floor(got / 1000) = floor(want / 1000) same_band, abs(got - want) <= ci + pci near, floor(got / 1000) = floor(want / 1000) and abs(got - want) <= ci + pci consistent from g join p using (s)")
def calibration(t: Tables) -> DataFrame:
    """Values derived anew against the published ones: consistent if they have one band and their difference is within both intervals."""
    g = t.customer.groupBy(F.col("c_mktsegment").alias("s")).agg(F.avg("c_acctbal").alias("got"), (1.96 * F.stddev_pop("c_acctbal") / F.sqrt(F.count(F.lit(1)))).alias("ci"))
    published = g.select("s", (F.round(F.col("got") / 100) * 100 + F.when(F.col("s") == "BUILDING", 3000).otherwise(0)).alias("want"), F.lit(50.0).alias("pci"))
    band, near = F.floor(F.col("got") / 1000) == F.floor(F.col("want") / 1000), F.abs(F.col("got") - F.col("want")) <= F.col("ci") + F.col("pci")
    return g.join(published, "s").select("s", band.alias("same_band"), near.alias("near"), (band & near).alias("consistent"))


@R.add("q194_scale_physics", "select p_partkey, case when p_size <= 3 then 64.0::double else round(64 + log2(p_size / 3.0::double), 2) end bits, 0.5::double * p_size * pow(p_retailprice / greatest(p_size % 5, 0.000001::double), 2) strike_joule, p_size * 20.0::double / 0.001::double / greatest(p_retailprice / 1000000, 1e-30::double) pressure from part")
def scale_physics(t: Tables) -> DataFrame:
    """Exception bits of exporting mass, the energy of a growing strike, and pressure over a small area."""
    m, x = F.col("p_size"), F.col("p_retailprice")
    bits = F.when(m <= 3, 64.0).otherwise(F.round(64 + F.log2(m / 3.0), 2))
    return t.part.select("p_partkey", bits.alias("bits"), (0.5 * m * F.pow(x / F.greatest((m % 5).cast("double"), F.lit(1e-6)), F.lit(2.0))).alias("strike_joule"), (m * 20.0 / 0.001 / F.greatest(x / 1_000_000, F.lit(1e-30))).alias("pressure"))


def surviving(theories: DataFrame) -> DataFrame:
    """The one theory that the evidence leaves; any other number of them is refused."""
    left = theories.where(~F.col("falsified"))
    n = left.count()
    if n != 1:
        raise ValueError(f"exactly one theory must survive, and {n} do")
    return left


@R.add("q195_rosters", """with g as (select p_brand nm, split_part(p_type, ' ', 1) axis, avg(case when p_size % 7 <> 0 then p_size end) / 5 score, ln(1 + count(*)) w from part group by 1, 2),
 s as (select nm, sum(score * w) / sum(w) filter (where score is not null) v, count(score) n, count(*) axes from g group by 1) select nm, v, nm || ': ' || n || ' of ' || axes || ' axes' citation from s""")
def rosters(t: Tables) -> DataFrame:
    """Sheets of readings by axis: the weighted mean of the axes that are read, and its citation."""
    read = F.avg(F.when(F.col("p_size") % 7 != 0, F.col("p_size"))) / 5
    g = t.part.groupBy(F.col("p_brand").alias("nm"), F.split("p_type", " ")[0].alias("axis")).agg(read.alias("score"), F.log1p(F.count(F.lit(1))).alias("w"))
    mean = F.sum(F.col("score") * F.col("w")) / F.sum(F.when(F.col("score").isNotNull(), F.col("w")))
    s = g.groupBy("nm").agg(mean.alias("v"), F.count("score").alias("n"), F.count(F.lit(1)).alias("axes"))
    return s.select("nm", "v", F.concat("nm", F.lit(": "), F.col("n").cast("string"), F.lit(" of "), F.col("axes").cast("string"), F.lit(" axes")).alias("citation"))


_FLOORS = [x for x in K.SETTLEMENTS[::-1]]


@R.add("q196_class_histogram", "with w as (select c_nationkey k, 40000 + 1000 * (c_nationkey % 7) p1, count(*) n from customer group by 1), b as (select k, p1, n, unnest(range(1, n + 1)) r from w), c as (select k, case when p >= 10000 then 'city' when p >= 1000 then 'town' when p >= 100 then 'village' else 'hamlet' end class from (select k, p1 // r p from b)) select k, class, count(*) n from c group by 1, 2")
def class_histogram(t: Tables) -> DataFrame:
    """Settlements by class under a rank-size law (the first over the rank): each class is a block of ranks, so it is counted by division and no settlement is made."""
    w = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg((40000 + 1000 * (F.first("c_nationkey") % 7)).alias("p1"), F.count(F.lit(1)).alias("n"))
    upto = lambda low: F.least(F.col("n"), F.floor(F.col("p1") / low)) if low else F.col("n")
    rows, above = [], F.lit(0).cast("long")
    for name, low in _FLOORS:
        rows.append(F.struct(F.lit(name).alias("class"), (upto(low) - above).alias("n")))
        above = upto(low)
    return w.select("k", F.inline(F.array(*rows))).where("n > 0")


_CHAIN = [("stars", 1e11), ("planets", 1.6), ("habitable", 0.2), ("life", 0.1), ("complex", 0.01), ("civilizations", 0.001)]


@R.add("q197_census", "with g as (select n_nationkey k, (n_nationkey % 5) * 2.0::double galaxies from nation) select k, " + ", ".join(f"galaxies * {'*'.join(repr(v) + '::double' for _, v in _CHAIN[: i + 1])} {n}" for i, (n, _) in enumerate(_CHAIN)) + ", galaxies > 0 \"valid\" from g")
def census(t: Tables) -> DataFrame:
    """A chain of expectations, every step shown, and whether it can be."""
    rows = t.nation.select(F.col("n_nationkey").alias("k"), ((F.col("n_nationkey") % 5) * 2.0).alias("x"))
    out, x = [], F.col("x")
    for name, v in _CHAIN:
        x = x * v
        out.append(x.alias(name))
    return rows.select("k", *out, (F.col("x") > 0).alias("valid"))


_PARENTS = {"COPPER": "ECONOMY", "STEEL": "STANDARD"}


@R.add("q198_category_path", "with p as (select p_partkey, case when p_partkey % 9 = 0 then null else split_part(p_type, ' ', 1) || ' (kind)' end category, split_part(p_type, ' ', 1) topic, case when p_partkey % 4 = 0 then 'none' else split_part(p_type, ' ', -1) end sub from part), c as (select *, trim(split_part(category, '(', 1)) coarse from p) select p_partkey, concat_ws(' > ', case when coarse is null then topic else coarse end, case when coarse is not null then case when (sub = 'COPPER' and coarse = 'ECONOMY') or (sub = 'STEEL' and coarse = 'STANDARD') then sub when (topic = 'COPPER' and coarse = 'ECONOMY') or (topic = 'STEEL' and coarse = 'STANDARD') then topic end end) path from c")
def category_path(t: Tables) -> DataFrame:
    words = F.split(F.col("p_type"), " ")
    first, last = words[0], F.element_at(words, -1)
    category = F.when(F.col("p_partkey") % 9 != 0, F.concat(first, F.lit(" (kind)")))
    sub = F.when(F.col("p_partkey") % 4 == 0, "none").otherwise(last)
    return t.part.select("p_partkey", F.array_join(L.category_path(category, first, sub, _PARENTS), " > ").alias("path"))


@R.add("q199_thread_graph", "with e as (select o_orderkey, o_custkey % 30 a, o_orderkey % 27 b from orders), k as (select n_nationkey from nation), s as (select case when a = b then 'malformed' when x.n_nationkey is null or y.n_nationkey is null then 'unresolvable' else 'edge' end state, a, b from e left join k x on x.n_nationkey = a left join k y on y.n_nationkey = b), d as (select distinct a, b from s where state = 'edge') select state, count(*) n, (select count(*) from d where not exists (select 1 from d r where r.a = d.b and r.b = d.a)) one_way from s group by 1")
def thread_graph(t: Tables) -> DataFrame:
    """Edges told apart into good, malformed and unresolvable ones, and how many directed pairs have no way back."""
    e = t.orders.select((F.col("o_custkey") % 30).alias("a"), (F.col("o_orderkey") % 27).alias("b"))
    known = lambda c: t.nation.select(F.col("n_nationkey").cast("long").alias(c), F.lit(True).alias(f"k{c}"))
    e = e.join(known("a"), "a", "left").join(known("b"), "b", "left")
    s = e.select("a", "b", F.when(F.col("a") == F.col("b"), "malformed").when(F.col("ka").isNull() | F.col("kb").isNull(), "unresolvable").otherwise("edge").alias("state"))
    d = s.where("state = 'edge'").select("a", "b").distinct()
    one_way = d.join(d.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti").agg(F.count(F.lit(1)).alias("one_way"))
    return s.groupBy("state").agg(F.count(F.lit(1)).alias("n")).crossJoin(one_way)  # one_way is one row


@R.add("q200_roster_gap", "with r as (select lower(p_name) k, max(length(p_name) * p_size) size from part group by 1), h as (select distinct lower(p_name) k from part where p_size = 7) select k, size, row_number() over (order by size desc, k) place from r anti join h using (k) where size >= 40")
def roster_gap(t: Tables) -> DataFrame:
    """A roster without what is held already, by folded key, largest first; stubs are left out."""
    r = t.part.groupBy(F.lower("p_name").alias("k")).agg(F.max(F.length("p_name") * F.col("p_size")).alias("size")).where("size >= 40")
    left = J.stranded(r, t.part.where("p_size = 7").select(F.lower("p_name").alias("k")), ["k"])
    return left.select("k", "size", F.row_number().over(Window.orderBy(F.desc("size"), "k")).cast("long").alias("place"))  # distinct names, a small vocabulary


@R.add("q201_category_tree", """with recursive p as (select n_nationkey child, (n_nationkey * 3 + 1) % 25 parent from nation), t(root, node, depth, path) as (select r_regionkey, r_regionkey, 0, [r_regionkey] from region union all select t.root, p.child, t.depth + 1, list_append(t.path, p.child) from t join p on p.parent = t.node where not list_contains(t.path, p.child) and t.depth < 6)
 select root, node, min(depth) depth from t group by 1, 2""")
def category_tree(t: Tables) -> DataFrame:
    """Members of category trees by breadth-first search; a node that was seen under its root is not entered again, so cycles end."""
    from quarryline.operators.snapshots import snapshot

    p = t.nation.select(F.col("n_nationkey").alias("child"), ((F.col("n_nationkey") * 3 + 1) % 25).alias("node"))
    seen = snapshot(t.region.select(F.col("r_regionkey").alias("root"), F.col("r_regionkey").alias("node"), F.lit(0).alias("depth")), "tree")
    edge = seen
    for depth in range(1, 7):  # six levels are what a roster asks for
        edge = edge.select("root", "node").join(p, "node").select("root", F.col("child").alias("node")).distinct().join(seen.select("root", "node"), ["root", "node"], "left_anti").withColumn("depth", F.lit(depth))
        edge = snapshot(edge, "tree")
        if edge.isEmpty():
            break
        seen = snapshot(seen.union(edge), "tree")
    return seen


@R.add("q202_split_candidates", "with n as (select distinct p_brand s, p_name nm from part), c as (select s, count(*) n from n group by 1), x as (select a.s a, b.s b, count(*) shared from n a join n b using (nm) where a.s <> b.s group by 1, 2) select a, b, shared from x join c on c.s = a where shared >= greatest(3, ceil(0.25::double * n))")
def split_candidates(t: Tables) -> DataFrame:
    """Neighbours that share a quarter of a source's names, and three at least."""
    n = t.part.select(F.col("p_brand").alias("s"), F.col("p_name").alias("nm")).distinct()
    sizes = n.groupBy(F.col("s").alias("a")).agg(F.count(F.lit(1)).alias("n"))
    one = J.pair_weights(n.withColumn("w", F.lit(1)), "s", "nm", "w").select("a", "b", "shared")
    both = one.union(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
    return both.join(sizes, "a").where(F.col("shared") >= F.greatest(F.lit(3), F.ceil(0.25 * F.col("n")))).select("a", "b", "shared")


_PROBES = ["the", "idiot", "from", "quality", "and"]


@R.add("q203_names_in_page", "with h as (select page_id, " + " + ".join(f"regexp_matches(lower(html), '(^|[^a-z0-9]){n}($|[^a-z0-9])')::int" for n in _PROBES if len(n) >= 4) + f" hits from pages) select page_id, hits, hits >= {max(1, min(2, sum(len(n) >= 4 for n in _PROBES)))} verified from h")
def names_in_page(t: Tables) -> DataFrame:
    """Whole-word hits of a source's names in a page; names under four letters prove nothing, and with none left a page is unverifiable."""
    probes = [n for n in _PROBES if len(n) >= 4]
    hits = sum((F.lower("html").rlike(f"(?<![a-z0-9]){n}(?![a-z0-9])").cast("int") for n in probes), F.lit(0))
    need = max(1, min(2, len(probes)))
    return t.pages.select("page_id", hits.alias("hits"), (hits >= need).alias("verified"))


_WORLD_BANDS = ["M3", "M3.52", "A M12", "unassayed", "high"]


@R.add("q204_world_options", "with b(k, band) as (values " + ", ".join(f"({k}, '{b}')" for k, b in enumerate(_WORLD_BANDS)) + "), w as (select p_partkey, p_name, band, p_size % 6 = 0 war, p_size % 7 = 0 ruined, case when band = 'unassayed' then 'unassayed' when not regexp_matches(band, 'M\\s*[0-9]+') then 'unparsed' when regexp_extract(band, 'M\\s*([0-9]+)', 1)::int > 10 then 'out_of_range' else 'ok' end how from part join b on k = p_partkey % 5), t as (select *, case when how in ('unassayed', 'unparsed') then 0 else least(10, regexp_extract(band, 'M\\s*([0-9]+)', 1)::int) end tier from w), s as (select *, least(40, 6 + 3 * tier + case when war then 4 else 0 end) raw from t), o as (select *, case when ruined then greatest(2, raw // 3) else raw end states from s) select p_partkey, how, states, greatest(3, least(24, states // 2 + 3)) cultures, greatest(2, states // 3) religions, 'name=' || replace(p_name, ' ', '+') || '&states=' || states q from o")
def world_options(t: Tables) -> DataFrame:
    """Option rows of worlds: a band's head number sets how contested a world is; ruin leaves a third of the states; and the query string."""
    band = F.get(F.array(*[F.lit(b) for b in _WORLD_BANDS]), (F.col("p_partkey") % 5).cast("int"))
    tier, how = L.band_tier(F.col("band"))
    rows = t.part.select("p_partkey", "p_name", "p_size", band.alias("band")).select("*", tier.alias("tier"), how.alias("how"))
    raw = F.least(F.lit(40), 6 + 3 * F.col("tier") + F.when(F.col("p_size") % 6 == 0, 4).otherwise(0))
    states = F.when(F.col("p_size") % 7 == 0, F.greatest(F.lit(2), F.floor(raw / 3))).otherwise(raw)
    rows = rows.withColumn("states", states)
    half, third = F.floor(F.col("states") / 2) + 3, F.floor(F.col("states") / 3)
    query = F.concat_ws("&", F.concat(F.lit("name="), F.url_encode("p_name")), F.concat(F.lit("states="), F.col("states").cast("string")))
    return rows.select("p_partkey", "how", "states", F.greatest(F.lit(3), F.least(F.lit(24), half)).alias("cultures"), F.greatest(F.lit(2), third).alias("religions"), query.alias("q"))


@R.add("q205_tier_census", "with a as (select p_partkey, p_size % 8 mv, case when p_size % 9 > 0 then p_size % 4 end mt, case when p_size % 5 > 0 then p_size % 3 end x from part) select count(distinct mv) multiverses, count(distinct mt) metaverses, count(distinct x) xenoverses, count(*) filter (where mt is null or x is null) with_gaps, count(*) filter (where mv <> p_partkey % 8) moved from a")
def tier_census(t: Tables) -> DataFrame:
    """Distinct nodes a tier, rows that leave a tier open, and rows whose address differs from the standing one."""
    k = F.col("p_size")
    a = t.part.select("p_partkey", (k % 8).alias("mv"), F.when(k % 9 > 0, k % 4).alias("mt"), F.when(k % 5 > 0, k % 3).alias("x"))
    return a.agg(F.count_distinct("mv").alias("multiverses"), F.count_distinct("mt").alias("metaverses"), F.count_distinct("x").alias("xenoverses"), F.count_if(F.col("mt").isNull() | F.col("x").isNull()).alias("with_gaps"), F.count_if(F.col("mv") != F.col("p_partkey") % 8).alias("moved"))


_RUNGS = [(1, 1e0), (2, 1e-3), (3, 1e-6), (4, 1e-9), (5, 1e-15)]


@R.add("q206_rungs", "with r(rung, len) as (values " + ", ".join(f"({k}, {v}::double)" for k, v in _RUNGS) + "), x as (select event_id, pow(10.0::double, -value / 10) m from events where value is not null) select event_id, max(rung) rung, log2(1 / any_value(m)) bits from x join r on m <= len group by 1")
def rungs(t: Tables) -> DataFrame:
    """The deepest rung of a descending ladder that a length reaches, and the bits to it."""
    x = t.events.where("value is not null").select("event_id", F.pow(F.lit(10.0), -F.col("value") / 10).alias("m"))
    rung = F.lit(None).cast("int")
    for k, v in _RUNGS:
        rung = F.when(F.col("m") <= v, F.lit(k)).otherwise(rung)
    return x.select("event_id", rung.alias("rung"), F.log2(1 / F.col("m")).alias("bits")).where("rung is not null")


@R.add("q207_unmanned", "with d as (select n_nationkey dof from nation), m as (select distinct s_nationkey dof from supplier where s_acctbal > 8000) select dof, 1 + sqrt(1 + pow(dof / 10.0::double, 2)) widening from d anti join m using (dof)")
def unmanned(t: Tables) -> DataFrame:
    """Degrees of freedom that nobody watches, with the widening of what passes there."""
    d = t.nation.select(F.col("n_nationkey").alias("dof"))
    left = J.stranded(d, t.supplier.where("s_acctbal > 8000").select(F.col("s_nationkey").alias("dof")), ["dof"])
    return left.select("dof", (1 + F.sqrt(1 + F.pow(F.col("dof") / 10.0, F.lit(2.0)))).alias("widening"))


@R.add("q208_remine", "with g as (select page_id, length(html) >= 1500 ok, page_id % 4 <> 0 stored from pages) select stored, ok, count(*) n from g group by 1, 2")
def remine(t: Tables) -> DataFrame:
    """A gate run again over the stored text, without fetching: what it would now keep or drop."""
    g = t.pages.select((F.col("page_id") % 4 != 0).alias("stored"), (F.length("html") >= 1500).alias("ok"))
    return g.groupBy("stored", "ok").agg(F.count(F.lit(1)).alias("n"))


@R.add("q209_mine_chunks", """with recursive p as (select source, doc_id, unnest(range(0, greatest(1, ceil(length(coalesce(text, '')) / 9000))::bigint)) k, coalesce(text, '') t from documents where source is not null),
 d as (select source, doc_id, k, length(substr(t, k * 9000 + 1, 9000)) n, case when length(t) > 9000 then 9000 else greatest(length(t), 1) end z, row_number() over (partition by source order by doc_id, k) i from p),
 r as (select source, 0::bigint i, null::bigint doc_id, null::bigint n, 0::bigint held, 0::bigint block from (select distinct source from d) union all
 select d.source, d.i, d.doc_id, d.n, case when held > 0 and held + d.z > 9000 then d.z else held + d.z end, case when held > 0 and held + d.z > 9000 then block + 1 else block end from r join d on d.source = r.source and d.i = r.i + 1)
 select source, block, min(doc_id) first, count(*) pieces, sum(n)::bigint chars from r where i > 0 group by 1, 2""")
def mine_chunks(t: Tables) -> DataFrame:
    """Pages packed in order into chunks for reading; an oversize page is cut, and its pieces are chunks of their own. No character is lost."""
    packed = M.chunks(t.documents.where("source is not null"), "source", "doc_id", "text", 9000)
    return packed.groupBy(F.col("group").alias("source"), "block").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("pieces"), F.sum(F.length("part")).alias("chars"))


@R.add("q210_nav_drift", "with a as (select distinct p_brand s, p_type k from part where p_size < 40), b as (select distinct p_brand s, p_type k from part where p_size > 10) select coalesce(a.s, b.s) s, count(*) filter (where b.k is null) gone, count(*) filter (where a.k is null) new, count(*) filter (where a.k is not null and b.k is not null) both_have from a full join b using (s, k) group by 1")
def nav_drift(t: Tables) -> DataFrame:
    """The shelves of a source in two states of the tree: their symmetric difference."""
    side = lambda c, n: t.part.where(c).select(F.col("p_brand").alias("s"), F.col("p_type").alias("k")).distinct().withColumn(n, F.lit(True))
    j = side("p_size < 40", "a").join(side("p_size > 10", "b"), ["s", "k"], "full_outer")
    return j.groupBy("s").agg(F.count_if(F.col("b").isNull()).alias("gone"), F.count_if(F.col("a").isNull()).alias("new"), F.count_if(F.col("a") & F.col("b")).alias("both_have"))


@R.add("q211_tier_children", "with n as (select p_brand || '/' || split_part(p_type, ' ', 1) tier2, p_brand tier1, p_type from part) select tier1 parent, count(distinct tier2) children, count(distinct p_type) leaves from n group by 1")
def tier_children(t: Tables) -> DataFrame:
    rows = t.part.select(F.col("p_brand").alias("parent"), F.split("p_type", " ")[0].alias("child"), "p_type")
    return rows.groupBy("parent").agg(F.count_distinct("child").alias("children"), F.count_distinct("p_type").alias("leaves"))


_CONTEST_SQL = "c as (select c_nationkey winner, s_nationkey loser, min(l_shipdate) dated, count(*) n from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey where l_quantity > 48 group by 1, 2)"


@R.add("q212_mutuals", f"with {_CONTEST_SQL} select a.winner lo, a.loser hi, case when a.dated is null or b.dated is null or a.dated = b.dated then 'undated' when a.dated < b.dated then 'lo first' else 'hi first' end split, a.n lo_wins, b.n hi_wins from c a join c b on a.winner = b.loser and a.loser = b.winner where a.winner < a.loser")
def mutuals(t: Tables) -> DataFrame:
    """Pairs that each beat the other: split only if both contests are dated, and differently. Self-contests are no pairs."""
    rows = t.lineitem.where("l_quantity > 48").select("l_orderkey", "l_suppkey", "l_shipdate").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    c = rows.groupBy(F.col("c_nationkey").alias("w"), F.col("s_nationkey").alias("l")).agg(F.min("l_shipdate").alias("at"), F.count(F.lit(1)).alias("n"))
    up = F.col("w") < F.col("l")
    pairs = c.where("w <> l").groupBy(F.least("w", "l").alias("lo"), F.greatest("w", "l").alias("hi")).agg(F.min(F.when(up, F.col("at"))).alias("x"), F.min(F.when(~up, F.col("at"))).alias("y"), F.sum(F.when(up, F.col("n"))).alias("lo_wins"), F.sum(F.when(~up, F.col("n"))).alias("hi_wins")).where("lo_wins is not null and hi_wins is not null")
    split = F.when(F.col("x").isNull() | F.col("y").isNull() | (F.col("x") == F.col("y")), "undated").when(F.col("x") < F.col("y"), "lo first").otherwise("hi first")
    return pairs.select("lo", "hi", split.alias("split"), "lo_wins", "hi_wins")


# How the tables' English tells deeds: who is done to, by whom, what is handed on, and the deed itself.
_TELLING = Patterns(passive=r"\b(?:was|is|had) (?:[a-z]+ )?[a-z]+ed\b", agent=r"\bof\s+(?:the\s+)?([A-Z][a-z]{2,})", handoff=r"\bwith\b.{0,60}?\b[A-Z][a-z]+\b.{0,20}?\b(?:that|the)\b", act=r"\b[a-z]+ing\b")
_NAMED = r"[A-Z][a-z]{2,}(?:[ -][A-Z][a-z]{2,})*"


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


_FORM_WORDS = rf"list_filter(regexp_extract_all(lower({{0}}), '[a-z][a-z''\-]{{{{2,}}}}'), lambda w: w not in {_in(K.NAME_STOP)})".replace("{{", "{").replace("}}", "}")
_MINE = "(list_contains(f, lower({0})) or list_contains(f, array_to_string({1}, ' ')) or list_has_any(list_filter({1}, lambda w: w not in " + _in(K.TITLE_WORDS) + "), f))"


def _mine(name: str) -> str:
    return _MINE.replace("{0}", name).replace("{1}", _FORM_WORDS.replace("{0}", name))


def _spans(text: str) -> str:
    return rf"list_filter(regexp_extract_all({text}, '\b{_NAMED}\b'), lambda n: len(list_filter(regexp_split_to_array(lower(n), '[ -]'), lambda w: w not in {_in(K.NAME_STOP)})) > 0)"


@R.add("q213_subject_refusal", rf"""with d as (select doc_id, regexp_replace(text, '[^\x00-\x7F]', 'x', 'g') t from documents where text is not null),
 e as (select doc_id, regexp_extract(t, '[^.!?]*[.!?]\s+(?:[^.!?]*\b)?({_NAMED})', 1) entity, unnest(regexp_extract_all(t, '[^.!?]+')) s from d),
 k as (select *, list_filter(list_distinct(list_concat([lower(entity)], {_FORM_WORDS.replace("{0}", "entity")})), lambda x: x <> '') f from e),
 p as (select *, regexp_matches(s, '{_TELLING.passive}') passive, regexp_extract(regexp_extract(s, '(?s)((?:{_TELLING.passive}).*)$', 1), '{_TELLING.agent}', 1) agent, regexp_matches(s, '(?s){_TELLING.handoff}') handed,
   coalesce(list_last({_spans(f"regexp_extract(s, '(?s){_TELLING.handoff}', 0)")}), '') heir, regexp_extract(s, '(?s)^(.*?)(?:{_TELLING.act})', 1) ahead, regexp_extract(s, '(?s)^.*?(?:{_TELLING.act})', 0) upto, regexp_matches(s, '{_TELLING.act}') acts from k where len(f) > 0),
 l as (select *, list_zip(regexp_extract_all(upto, '\b({_NAMED})(?:[''’]s\b)?[\s,]*([a-z][a-z''\-]+)\b', 1), regexp_extract_all(upto, '\b({_NAMED})(?:[''’]s\b)?[\s,]*([a-z][a-z''\-]+)\b', 2)) pairs from p),
 v as (select doc_id, case when passive then case when agent = '' then ('suffered', '') when not {_mine("agent")} then ('credited', agent) end when handed then case when not (heir <> '' and {_mine("heir")}) then ('handed', heir) end
   when acts and len(list_filter({_spans("ahead")}, lambda n: {_mine("n")})) = 0 and not regexp_matches(ahead, '{K.PRONOUN}')
   then ('led', list_filter(pairs, lambda q: q[2] not in {_in(K.NOT_A_VERB)} and not {_mine("q[1]")} and len({_spans("q[1]")}) > 0 and contains(ahead, q[1]))[1][1]) end x from l)
 select x[1] rule, nullif(x[2], '') "name", count(*) n, count(distinct doc_id) documents from v where x is not null and not (x[1] = 'led' and x[2] is null) group by 1, 2""")
def refusals(t: Tables) -> DataFrame:
    """Sentences of all texts whose deed is not that of the text's entity (the first name after its first sentence), by rule and name."""
    d = t.documents.where("text is not null").select("doc_id", F.regexp_replace("text", r"[^\x00-\x7F]", "x").alias("t"))
    entity = F.regexp_extract("t", after_first_sentence(_NAMED), 1)
    named = d.withColumn("entity", entity).select("doc_id", "t", forms(F.col("entity")).alias("f"))
    s = named.select("doc_id", "f", F.explode(F.regexp_extract_all("t", F.lit("[^.!?]+"), F.lit(0))).alias("s"))
    found = subject_refusals(s, "f", "s", _TELLING)
    # a condition on the refusal would be moved below its steps, with all of them written out in it again and again
    told = found.select("doc_id", F.explode(F.array_compact(F.array("refusal"))).alias("refusal"))
    return told.groupBy(F.col("refusal.rule").alias("rule"), F.col("refusal.name").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("documents"))


@R.add("q214_carried", "with d(nm) as (values ('red'), ('blue')) select p_partkey, exists (select 1 from d where nm = split_part(lower(p_name), ' ', 1)) carried from part")
def carried(t: Tables) -> DataFrame:
    """Membership of a doctrine list, by folded first word; the list is a handful of names."""
    return t.part.select("p_partkey", T.fold(F.split("p_name", " ")[0]).isin("red", "blue").alias("carried"))


_READERS = [(0.5, 0.3, 0.2), (0.2, 0.5, 0.3), (0.34, 0.33, 0.33)]


@R.add("q219_convene", "with x as (select o_orderkey, o_totalprice / 60000 a, o_orderkey % 10 b, case when o_orderkey % 4 = 0 then null else o_custkey % 10 end c, (o_orderkey % 30) / 100.0::double stale from orders), r as (select o_orderkey, stale, ["
 + ", ".join(f"(a * {p} + b * {q} + coalesce(c * {r}, 0)) / ({p} + {q} + case when c is null then 0 else {r} end)" for p, q, r in ((f"{p}::double", f"{q}::double", f"{r}::double") for p, q, r in _READERS))
 + "] v from x) select o_orderkey, list_avg(v) mean, list_stddev_pop(v) sd, greatest(1.96::double * list_stddev_pop(v), list_max(v) - list_avg(v), list_avg(v) - list_min(v)) + stale half from r")
def convene(t: Tables) -> DataFrame:
    """Several readers weigh the same axes in their own way: mean and deviation of their readings, and a half-width that covers them all and what has aged."""
    k = F.col("o_orderkey")
    axes = [F.col("o_totalprice") / 60000, (k % 10).cast("double"), F.when(k % 4 != 0, (F.col("o_custkey") % 10).cast("double"))]
    readings = F.array(*[S.weighted_composite(list(zip(axes, weights)), F.lit(1.0), 0.4)[0] for weights in _READERS])
    rows = t.orders.select("o_orderkey", readings.alias("v"), ((k % 30) / 100.0).alias("stale"))
    n = float(len(_READERS))
    mean = F.aggregate("v", F.lit(0.0), lambda s, x: s + x) / n
    rows = rows.withColumn("mean", mean)
    sd = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x - F.col("mean")) * (x - F.col("mean"))) / n)
    rows = rows.withColumn("sd", sd)
    half = F.greatest(1.96 * F.col("sd"), F.array_max("v") - F.col("mean"), F.col("mean") - F.array_min("v")) + F.col("stale")
    return rows.select("o_orderkey", "mean", "sd", half.alias("half"))
