"""The numbered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm import chat_format, conversation_repair, decontamination, exact_dedup, html_extraction, lm_scoring, packing, secret_scan, sharding, simhash, spelling, substring_dedup, toxicity

TOKENIZER = "byte_bpe_50k.json"
SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(_table(spark, sf_dir, "documents"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extraction.extract(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    words = secret_scan.language(docs)
    model = secret_scan.train(secret_scan.labelled_findings(spark, common=words.common), words)
    return secret_scan.scan(docs, model, words, path="source")


def op3_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old shards are those of a layout by source, which the flow evens out."""
    docs = _table(spark, sf_dir, "documents")
    out = sharding.reshard(docs, F.pmod(F.xxhash64("source"), F.lit(SHARDS)), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old", "moved")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.render(_table(spark, sf_dir, "conversations"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    out = toxicity.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", toxicity.in_fold().alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(_table(spark, sf_dir, "conversations"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_secret_scan": op2_secret_scan,
    "op3_resharding": op3_resharding,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_simhash": op5_simhash,
    "op6_decontamination": op6_decontamination,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_chat_format": op8_chat_format,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op4_substring_dedup": r"""
with w as (
  select doc_id, unnest(l) word, generate_subscripts(l, 1) pos, len(l) n
  from (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') l from documents)),
win as (select doc_id, pos, n, list(word) over (partition by doc_id order by pos rows between current row and 19 following) g from w),
marked as (
  select doc_id, pos from (
    select doc_id, pos, row_number() over (partition by hash(g), g order by doc_id, pos) r from win where pos + 19 <= n) where r > 1),
gone as (
  select w.doc_id, w.pos, w.word,
    coalesce(max(m.pos) over (partition by w.doc_id order by w.pos rows between unbounded preceding and current row) >= w.pos - 19, false) x
  from w left join marked m on m.doc_id = w.doc_id and m.pos = w.pos)
select d.doc_id, count(g.word) n_words, count(*) filter (where g.x) n_removed,
  sha256(coalesce(string_agg(g.word, ' ' order by g.pos) filter (where not g.x), '')) kept_sha256
from documents d left join gone g on g.doc_id = d.doc_id group by d.doc_id
""",
    "op7_exact_dedup": """
select doc_id, max(doc_id) over g keep_id, count(*) over g group_size, doc_id = max(doc_id) over g kept, sha256(coalesce(text, '')) text_sha256
from documents window g as (partition by coalesce(text, ''))
""",
    "op6_decontamination": r"""
with d as (select doc_id id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w from documents),
i as (select item_id id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w from benchmark),
sd as (select distinct id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) s from d),
si as (select distinct id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) s from i),
n as (select id, count(*) n from si group by id)
select sd.id doc_id, si.id item_id, count(*) n_shared, any_value(n.n) n_item, count(*) / any_value(n.n) containment
from sd join si using (s) join n on n.id = si.id group by sd.id, si.id having count(*) >= 0.8 * any_value(n.n)
""",
    "op8_chat_format": """
with c as (select conv_id, list(struct_pack(r := coalesce(role, 'unknown'), t := coalesce(text, '')) order by turn nulls first, role nulls first, text nulls first) l from conversations group by conv_id)
select conv_id, len(l) n_turns, array_to_string(list_transform(l, lambda x: '<|' || x.r || E'|>\\n' || x.t || E'\\n<|end|>'), E'\\n') text
from c where not exists (select 1 from c d where len(d.l) > len(c.l) and d.l[1:len(c.l)] = c.l)
""",
    "op13_spelling_variants": r"""
with recursive crc_table as (
  select list(c order by b) t from (
    select b, list_reduce([b, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, s: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) c
    from (select unnest(range(0, 256)) b))),
runs as (
  select key, run, count(*) m from (
    select coalesce(doc_id::varchar, '') key, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) run
    from documents) group by key, run),
hashed as (
  select run, m, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, 1 + strlen(key || ':' || run)),
    lambda k: ('0x' || substr(hex(encode(key || ':' || run)), 2 * k - 1, 2))::bigint)), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]))) h
  from runs, crc_table),
words as (
  select word, sum(m)::bigint n from (
    select case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end word, m from hashed)
  where length(word) >= 6 group by word having sum(m) >= 5),
deletions as (select word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) key from (select word, n, unnest(range(1, length(word) + 1)) k from words)),
pairs as (
  select distinct a.word, a.n, b.word other, b.n other_n from deletions a join deletions b using (k, key) where a.word <> b.word
  union select a.word, a.n, b.word, b.n from deletions a join words b on b.word = a.key
  union select b.word, b.n, a.word, a.n from deletions a join words b on b.word = a.key),
best as (
  select word, count(*) n_near, first(other order by other_n desc, other) other, max(other_n) other_n, any_value(n) n from pairs group by word),
form as (select word, n_near, case when other_n >= 5 * n then other end form, case when other_n >= 5 * n then other_n end form_n from best),
way as (
  select word, form cur from form where form is not null
  union all select way.word, f.form from way join form f on f.word = way.cur where f.form is not null),
root as (select word, cur root from way where not exists (select 1 from form f where f.word = way.cur and f.form is not null))
select w.word, f.form, coalesce(r.root, w.word) root, w.n, coalesce(f.n_near, 0)::bigint n_near, f.form_n
from words w left join form f using (word) left join root r using (word)
""",
    "op11_conversation_repair": r"""
with recursive crc_table as (
  select list(c order by b) t from (
    select b, list_reduce([b, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, s: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) c
    from (select unnest(range(0, 256)) b))),
named as (
  select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') k from conversations),
coded as (
  select conv_id, turn, role, text, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, 1 + strlen(k)),
    lambda j: ('0x' || substr(hex(encode(k)), 2 * j - 1, 2))::bigint)), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]))) % 20 code
  from named, crc_table),
damaged as (
  select conv_id, turn, case when code = 4 then 'user' else role end role,
    case code when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text, unnest(case when code = 3 then [1, 2] else [1] end) copy
  from coded where code <> 0),
ordered as (
  select coalesce(conv_id::varchar, '') c, turn, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) i from damaged),
placed as (
  select c, turn, role, text, i, row_number() over (partition by c, role, text order by i) > 1 again, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) last from ordered),
turns as (
  select c, turn, role, text, i, left(role, 1) initial, case when last = '' then 'blank' when again then 'duplicate' when last not in ('.', '!', '?') then 'truncated' else '' end fault from placed),
moves(p, q, e, cost, wants, before, role) as (values
  (0, 0, 'D', 3, null, null, null), (1, 1, 'D', 3, null, null, null), (2, 2, 'D', 3, null, null, null), (3, 3, 'D', 3, null, null, null),
  (0, 1, 'K', 0, 's', null, null), (0, 2, 'K', 0, 'u', null, null), (1, 2, 'K', 0, 'u', null, null), (3, 2, 'K', 0, 'u', null, null), (2, 3, 'K', 0, 'a', null, null),
  (0, 2, 'R', 2, null, null, 'user'), (1, 2, 'R', 2, null, null, 'user'), (3, 2, 'R', 2, null, null, 'user'), (2, 3, 'R', 2, null, null, 'assistant'),
  (0, 3, 'IK', 2, 'a', 'user', null), (1, 3, 'IK', 2, 'a', 'user', null), (3, 3, 'IK', 2, 'a', 'user', null), (2, 2, 'IK', 2, 'u', 'assistant', null),
  (0, 3, 'IR', 4, null, 'user', 'assistant'), (1, 3, 'IR', 4, null, 'user', 'assistant'), (3, 3, 'IR', 4, null, 'user', 'assistant'), (2, 2, 'IR', 4, null, 'assistant', 'user')),
walk as (
  select distinct coalesce(conv_id::varchar, '') c, 0::bigint i, 0 q, {'cost': 0::bigint, 's': '', 't': ''} b from conversations
  union all
  select c, i, q, b from (
    select w.c, w.i + 1 i, m.q, min({'cost': w.b.cost + m.cost + case when m.e <> 'D' and r.fault = 'truncated' then 1 else 0 end, 's': w.b.s || m.e,
      't': w.b.t || coalesce(chr(10) || m.before || ':', '') || case when m.e = 'D' then '' else chr(10) || coalesce(m.role, r.role) || ':' || r.text end}) b
    from walk w join turns r on r.c = w.c and r.i = w.i + 1 join moves m on m.p = w.q
      and (m.e = 'D' or r.fault not in ('blank', 'duplicate') and (m.wants is null or m.wants = r.initial))
    group by w.c, w.i, m.q)),
ended as (
  select w.c, min({'cost': b.cost + case q when 1 then 4 when 2 then 2 else 0 end, 's': b.s || case q when 1 then 'II' when 2 then 'I' else '' end,
    't': b.t || case q when 1 then chr(10) || 'user:' || chr(10) || 'assistant:' when 2 then chr(10) || 'assistant:' else '' end}) b
  from walk w left join (select c, max(i) n from turns group by c) z on z.c = w.c where w.i = coalesce(z.n, 0) group by w.c),
counts as (
  select c, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (where fault = 'blank') blank, count(*) filter (where fault = 'duplicate') duplicate,
    count(*) filter (where fault = 'truncated') truncated, count(*) filter (where i > 1 and pair not in ('su', 'ua', 'au')) illegal
  from (select *, lag(initial) over (partition by c order by i) || initial pair from turns) group by c)
select v.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0)::bigint blank, coalesce(duplicate, 0)::bigint duplicate, coalesce(truncated, 0)::bigint truncated,
  coalesce(illegal, 0)::bigint illegal, e.b.cost::bigint "cost", e.b.s audit, sha256(substr(e.b.t, 2)) repaired_sha256
from (select distinct conv_id from conversations) v join ended e on e.c = coalesce(v.conv_id::varchar, '') left join counts n on n.c = e.c
""",
}
