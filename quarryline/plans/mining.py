"""Spans, contests and mining over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions import lifecycle as L
from quarryline.functions.spans import after_first_sentence, outermost_rows
from quarryline.operators import harvest as H
from quarryline.operators.matching import best_only, overlap_pairs
from quarryline.plans.base import Registry, Tables

R = Registry()

#: Words that tell a contest in the tables' English, and in how many documents a word must stand to be a name.
_TELLING = H.Telling(won=r"\bthing\b", lost=r"\b(?:ating|tioning)\b")
_NAME_DOCUMENTS = 12


def _sentences(t: Tables) -> DataFrame:
    plain = F.regexp_replace("text", r"[^\x00-\x7F]", "x")
    return t.documents.where("text is not null").select(F.col("source").alias("entity"), F.explode(F.regexp_extract_all(plain, F.lit("[^.!?]+"), F.lit(0))).alias("text"))


def _names(t: Tables) -> DataFrame:
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.regexp_replace("text", r"[^\x00-\x7F]", "x")), F.lit("[a-z]{7,}"), F.lit(0)))
    counted = t.documents.select(F.explode(words).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= _NAME_DOCUMENTS).select("name", F.col("name").alias("key"))


_CONTESTS = rf"""d as (select source entity, regexp_replace(text, '[^\x00-\x7F]', 'x', 'g') t from documents where text is not null),
 nm as (select w from (select unnest(list_distinct(regexp_extract_all(lower(t), '[a-z]{{7,}}'))) w from d) group by w having count(*) >= {_NAME_DOCUMENTS}),
 s as (select distinct entity, lower(unnest(regexp_extract_all(t, '[^.!?]+'))) s from d),
 v as (select entity, s, regexp_extract(s, '(?s)^(.*?)({_TELLING.won}|{_TELLING.lost})', 1) a, regexp_extract(s, '(?s)^.*?({_TELLING.won}|{_TELLING.lost})', 1) said, regexp_extract(s, '(?s)^.*?(?:{_TELLING.won}|{_TELLING.lost})(.*)$', 1) b from s where regexp_matches(s, '{_TELLING.won}|{_TELLING.lost}')),
 l as (select row_number() over () i, * from v),
 x as (select i, unnest(regexp_extract_all(a, '[a-z0-9]+')) w, generate_subscripts(regexp_extract_all(a, '[a-z0-9]+'), 1) k from l), y as (select i, unnest(regexp_extract_all(b, '[a-z0-9]+')) w, generate_subscripts(regexp_extract_all(b, '[a-z0-9]+'), 1) k from l),
 p as (select i, arg_max(w, k) w from x where w in (select w from nm) group by i), q as (select i, arg_min(w, k) w from y where w in (select w from nm) group by i),
 c as (select entity, s, case when said = 'thing' then p.w else q.w end winner, case when said = 'thing' then q.w else p.w end loser from l left join p using (i) left join q using (i))"""


@R.add("q220_harvest", f"with {_CONTESTS} select winner, loser, count(*) n from (select distinct entity, s, winner, loser from c where winner is not null and loser is not null and winner <> loser) group by 1, 2")
def harvest(t: Tables) -> DataFrame:
    """Who beat whom in all sentences: the nearest names (common long words) on the two sides of the word that tells it."""
    return H.edges(H.contests(_sentences(t), _names(t), _TELLING))


@R.add("q221_harvest_sides", f"with {_CONTESTS} select case when winner is null and loser is null then 'neither' when winner is null then 'no winner' when loser is null then 'no loser' when winner = loser then 'self' else 'resolved' end state, count(*) n from (select distinct entity, s, winner, loser from c) group by 1")
def harvest_sides(t: Tables) -> DataFrame:
    """Told contests by what is known of their sides."""
    return H.sides(H.contests(_sentences(t), _names(t), _TELLING))


_TELLS = (("pair", r"\bof the\b"), ("frame", r"\bof the [a-z]+ing\b"), ("noun", r"[a-z]+ing"), ("tail", r"ing"))


@R.add("q222_tell_spans", r"""with d as (select doc_id, lower(regexp_replace(text, '[^\x00-\x7F]', 'x', 'g')) t from documents where text is not null),
 g as (""" + " union all ".join(rf"select doc_id, '{name}' kind, regexp_extract_all(t, '{p}') f, regexp_split_to_array(t, '{p}') b from d" for name, p in _TELLS) + r"""),
 u as (select doc_id, kind, unnest(f) found, unnest(b[1:len(f)]) gap, generate_subscripts(f, 1) k from g),
 s as (select doc_id, kind, found, sum(length(gap) + length(found)) over (partition by doc_id, kind order by k)::bigint e, length(found) n from u),
 w as (select doc_id, kind, e - n st, e, max(e) over (partition by doc_id order by e - n, e desc, kind rows between unbounded preceding and 1 preceding) reach from s)
 select kind, count(*) shown, count(distinct doc_id) documents, sum(st)::bigint starts from w where reach is null or e > reach group by kind""")
def tell_spans(t: Tables) -> DataFrame:
    """Turns of phrase with their places, those inside longer ones left out."""
    text = F.lower(F.regexp_replace("text", r"[^\x00-\x7F]", "x"))
    d = t.documents.where("text is not null").select("doc_id", text.alias("t"))
    # a word that no match starts in at its first letter has none at a later one
    found = outermost_rows(d, "doc_id", "t", [(name, "(?<![a-z])" + p if p.startswith("[a-z]+") else p) for name, p in _TELLS])
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("shown"), F.count_distinct("doc_id").alias("documents"), F.sum("start").alias("starts"))


@R.add("q223_token_overlap", r"""with i as (select item_id, list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda w: length(w) > 1 and w not in ('the', 'and', 'of'))) t from benchmark),
 d as (select doc_id, list_distinct(list_filter(regexp_extract_all(lower(regexp_extract(text, '^[^.!?]*')), '[a-z0-9]+'), lambda w: length(w) > 1 and w not in ('the', 'and', 'of'))) t from documents where text is not null),
 p as (select doc_id a, item_id b, len(list_intersect(d.t, i.t)) / least(len(d.t), len(i.t)) score from d, i where len(d.t) > 0 and len(i.t) > 0),
 m as (select a, b, score, max(score) over (partition by a) top from p where score >= 0.8 - 1e-9),
 g as (select a, min(b) b, max(b) last, max(score) score from m where score = top group by a) select a doc_id, b item_id, score from g where b = last""")
def token_overlap_stage(t: Tables) -> DataFrame:
    """A text's first sentence against benchmark items by words: four fifths of the smaller set, the best alone, ties refused."""
    words = lambda c: F.array_distinct(F.filter(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0)), lambda w: (F.length(w) > 1) & ~w.isin("the", "and", "of")))
    items = t.benchmark.select(F.col("item_id").alias("b"), words(F.col("text")).alias("tokens"))
    first = t.documents.where("text is not null").select(F.col("doc_id").alias("a"), words(F.regexp_extract("text", r"^[^.!?]*", 0)).alias("tokens"))
    best = best_only(overlap_pairs(first, items), "a", "b", "score")
    return best.select(F.col("a").alias("doc_id"), F.col("b").alias("item_id"), "score")


_SECOND = r"[^.!?]*[.!?]\s+(?:[^.!?]*\b)?([A-Z][a-z]{2,})"


@R.add("q225_names_in_texts", rf"""with d as (select doc_id, regexp_replace(text, '[^\x00-\x7F]', 'x', 'g') t from documents where text is not null),
 s as (select doc_id, lower(regexp_extract(t, '{_SECOND}', 1)) nm, lower(unnest(regexp_extract_all(t, '[^.!?]+'))) s from d),
 w as (select *, case when length(nm) > 3 then [nm] else [] end parts, list_filter(regexp_split_to_array(s, '[^a-z0-9_]+'), lambda x: x <> '') said from s),
 n as (select doc_id, len(list_filter(parts, lambda p: len(list_filter(said, lambda x: starts_with(x, p))) > 0)) > 0
   or (len(parts) = 0 and nm <> '' and (contains(' ' || array_to_string(said, ' ') || ' ', ' ' || nm || ' ') or contains(' ' || array_to_string(said, ' ') || ' ', ' ' || nm || 's ')))
   or list_has_any(said, ['he', 'she', 'they', 'his', 'her', 'their', 'him', 'himself', 'herself', 'themselves']) named from w)
 select doc_id, count(*) sentences, count(*) filter (where named) named from n group by doc_id""")
def names_in_texts(t: Tables) -> DataFrame:
    """How many sentences of each text speak of its entity (the first name after its first sentence), by name or pronoun."""
    plain = t.documents.where("text is not null").select("doc_id", F.regexp_replace("text", r"[^\x00-\x7F]", "x").alias("t"))
    entity = F.regexp_extract("t", after_first_sentence("[A-Z][a-z]{2,}"), 1)
    low = plain.select("doc_id", F.lower(entity).alias("entity"), F.lower("t").alias("t"))  # folded, as only ASCII is left
    s = low.select("doc_id", "entity", F.explode(F.regexp_extract_all("t", F.lit("[^.!?]+"), F.lit(0))).alias("s"))
    told = s.select("doc_id", L.names_folded(F.col("s"), F.col("entity")).alias("named"))
    return told.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sentences"), F.count_if("named").alias("named"))
