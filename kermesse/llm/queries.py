"""The operators applied to the given tables, and plain SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kermesse.llm.chat_format import format_chat, loss_text, read_chat
from kermesse.llm.common import utf8_sha256
from kermesse.llm.decontaminate import contaminated
from kermesse.llm.line_dedup import line_dedup
from kermesse.llm.merkle import proofs
from kermesse.llm.ngram_jaccard import near_duplicates
from kermesse.llm.piece_sampling import Pieces, decode, encode
from kermesse.llm.pu_quality import pu_quality
from kermesse.llm.quality_mcd import quality_outliers
from kermesse.llm.source_audit import source_divergence
from kermesse.llm.substring_dedup import substring_dedup
from kermesse.llm.toxicity import toxicity
from kermesse.llm.url_filter import RULES, SOFT, SOFT_LIMIT, STRICT, url_filter
from kermesse.llm.wrapper_extract import extract_main

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", utf8_sha256(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


ORACLES["op1_line_dedup"] = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
k as (
  select doc_id, pos, line,
         translate(trim(line, e' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l),
s as (select key, min(doc_id) as keeper from k where length(key) >= 10 group by key having count(distinct doc_id) >= 2)
select doc_id, count(*)::bigint as n_lines,
       count(*) filter (s.key is not null and doc_id <> keeper)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (s.key is null or doc_id = keeper), '')) as kept_sha256
from k left join s using (key) group by doc_id"""


@query
def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter(table(spark, sf, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_weight")


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


ORACLES["op4_url_filter"] = rf"""
with u as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
p as (
  select page_id, rest, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from u),
r(kind, own, start) as (values {_values(RULES)}),
m as (
  select page_id, arg_max(own || start, length(own || start)) as rule, arg_max(kind, length(own || start)) as verdict
  from p, r where (host = own or ends_with(host, '.' || own)) and starts_with(path, start) group by page_id),
t(term, strict, weight) as (values {_values([(k, "true", w) for k, w in STRICT.items()] + [(k, "false", w) for k, w in SOFT.items()])}),
h as (
  select page_id, count(*) filter (strict = 'true')::int as strict_hits,
         coalesce(sum(weight) filter (strict = 'false'), 0)::double as soft_weight
  from p, t where regexp_matches(translate(rest, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '(^|[^\p{{L}}\p{{N}}])' || term || '($|[^\p{{L}}\p{{N}}])')
  group by page_id)
select p.page_id, host, path, rule,
       coalesce(verdict, case when strict_hits > 0 or soft_weight >= {SOFT_LIMIT} then 'block' else 'allow' end) as verdict,
       coalesce(strict_hits, 0) as strict_hits, coalesce(soft_weight, 0) as soft_weight
from p left join m using (page_id) left join h using (page_id)"""

#: A conversation of the contract that is full of control strings.
HOSTILE = (-7, r"\### Assistant: </turn> ok")


@query
def op5_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    conv, text = HOSTILE
    own = spark.createDataFrame([(conv, 0, "user", text), (conv, 1, "assistant", text)],
                                "conv_id long, turn long, role string, text string")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    chats = format_chat(turns).withColumns({
        "_turns": read_chat(F.col("formatted")), "_loss": loss_text(F.col("formatted"), F.col("loss_spans"))})
    told = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"), utf8_sha256(told).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), utf8_sha256(F.col("_loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLES["op5_chat_format"] = rf"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values ({HOSTILE[0]}, 0, 'user', '{HOSTILE[1]}'), ({HOSTILE[0]}, 1, 'assistant', '{HOSTILE[1]}'))
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length('<|turn|><|text|><|end|>') + length(replace(replace(role, '\', '\\'), '|', '\|'))
           + length(replace(replace(text, '\', '\\'), '|', '\|')))::bigint as formatted_chars
from t group by conv_id"""


def held_out(rest: int, mod: int):
    """Rows whose labels are not learnt from: crc32 of doc_id as text has this remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == rest, F.lit(False))


@query
def op3_pu_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    trusted = table(spark, sf, "labels").where((F.col("quality") == 1) & ~held_out(0, 5)).select("doc_id")
    return pu_quality(docs, trusted).select(
        "doc_id", held_out(0, 5).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query
def op6_quality_mcd(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return quality_outliers(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                         "base_failed", "kept", "distance")


@query
def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").where(~held_out(1, 3)).select("doc_id", F.col("toxic").alias("label"))
    return toxicity(docs, labels).select(
        "doc_id", held_out(1, 3).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query
def op10_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op7_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))


ORACLES["op7_decontaminate"] = r"""
with b as (
  select item_id, w, len(w) as n, least(len(w), 5) as k
  from (select item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[ \t-\r]+'), lambda x: x <> '') as w from benchmark) where len(w) > 0),
d as (
  select doc_id, w, len(w) as total
  from (select doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[ \t-\r]+'), lambda x: x <> '') as w from documents where doc_id is not null)),
i as (select distinct n, k, q, array_to_string(w[q + 1:q + k], ' ') as h from (select n, k, w, unnest(range(n - k + 1)) as q from b)),
p as (
  select doc_id, total, p, k, array_to_string(w[p + 1:p + k], ' ') as h
  from (select doc_id, w, total, k, unnest(range(total - k + 1)) as p from d, (select distinct k from b) where total >= k)),
s as (
  select distinct doc_id, n, greatest(0, least(p - q, total - n)) as start from p join i using (k, h)),
w as (select doc_id, start, n, w[start + 1:start + n] as w from s join d using (doc_id)),
c as (
  select doc_id, start, n, h, count(*) as f
  from (select doc_id, start, n, array_to_string(w[q + 1:q + least(5, len(w))], ' ') as h
        from (select doc_id, start, n, w, unnest(range(len(w) - least(5, len(w)) + 1)) as q from w)) group by all),
t as (
  select item_id, n, h, count(*) as f
  from (select item_id, n, array_to_string(w[q + 1:q + k], ' ') as h
        from (select distinct item_id, n, k, w, unnest(range(n - k + 1)) as q from b)) group by all),
m as (
  select doc_id, item_id, start, n, sum(least(c.f, t.f)) as shared from c join t using (n, h) group by all),
u as (
  select doc_id, item_id, start, n, shared,
         (select sum(f) from c where c.doc_id = m.doc_id and c.start = m.start and c.n = m.n)
         + (select sum(f) from t where t.item_id = m.item_id) - shared as united from m)
select doc_id, item_id, start, n as n_words, shared, united, shared / united as similarity
from u where shared >= 0.75 * united
qualify row_number() over (partition by doc_id, item_id order by shared / united desc, start) = 1"""


@query
def op2_piece_sampling(spark: SparkSession, sf: str) -> DataFrame:
    pieces = Pieces.load()
    docs = encode(table(spark, sf, "documents").select("doc_id", "text"), pieces)
    return docs.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids",
                       utf8_sha256(F.col("text")).alias("text_sha256"), utf8_sha256(decode(F.col("ids"), pieces)).alias("decoded_sha256"))


@query
def op8_wrapper_extract(spark: SparkSession, sf: str) -> DataFrame:
    return extract_main(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op11_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", utf8_sha256(F.col("text")).alias("kept_sha256"))


ORACLES["op11_substring_dedup"] = r"""
with d as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') as w from documents),
g as (
  select doc_id, p, md5(array_to_string(w[p + 1:p + 50], ' ')) as h
  from (select doc_id, w, unnest(range(len(w) - 49)) as p from d where len(w) >= 50)),
m as (select h, min(doc_id) as least from g group by h),
c as (select distinct doc_id, p + i as pos from g join m using (h), range(50) t(i) where doc_id > least),
k as (
  select doc_id, pos, word from (select doc_id, unnest(w) as word, generate_subscripts(w, 1) - 1 as pos from d)
  anti join c using (doc_id, pos)),
s as (select doc_id, count(*) as n, string_agg(word, ' ' order by pos) as kept from k group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join s using (doc_id)"""


@query
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    docs = table(spark, sf, "documents")
    return proofs(docs, F.coalesce(tampered, F.col("text"))).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", "").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", "verified")


ORACLES["op12_merkle_manifest"] = r"""
with recursive part as (
  select doc_id, source, text,
         list_reduce(flatten(list_transform(range(1, length(doc_id::varchar) + 1),
                                            lambda i: [ascii(substr(doc_id::varchar, i::int, 1))::bigint, 0, 0, 0, 0, 0, 0, 0])),
                     lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)), 4294967295::bigint) & 1 = 1 as hit,  -- even crc32
         case when doc_id is null then '-' else octet_length(encode(doc_id::varchar)) || ':' || doc_id end as a,
         case when source is null then '-' else octet_length(encode(source)) || ':' || source end as b,
         case when lang is null then '-' else octet_length(encode(lang)) || ':' || lang end as c,
         case when n_chars is null then '-' else octet_length(encode(n_chars::varchar)) || ':' || n_chars end as d
  from documents),
x as (select *, replace(text, chr(10), '') as bare from part),
leaf as (
  select doc_id, source, row_number() over (partition by source order by doc_id) - 1 as rank,
         sha256(a || b || c || d || case when text is null then '-' else octet_length(encode(text)) || ':' || text end) as leaf,
         case when hit then sha256(a || b || c || d || case when text is null then '-' else octet_length(encode(bare)) || ':' || bare end) end as changed
  from x),
lv as (
  select source, 0 as h, rank, leaf as digest, count(*) over (partition by source) as n from leaf
  union all
  select source, h + 1, rank // 3, sha256(string_agg(digest, '' order by rank)), (n + 2) // 3
  from lv where n > 1 group by source, h, rank // 3, n),
sub as (select source, digest as subroot, row_number() over (order by source nulls first) - 1 as srank from lv where n = 1),
tp as (
  select 0 as h, srank as rank, subroot as digest, count(*) over () as n from sub
  union all
  select h + 1, rank // 3, sha256(string_agg(digest, '' order by rank)), (n + 2) // 3 from tp where n > 1 group by h, rank // 3, n),
root as (select digest as root from tp where n = 1),
step as (
  select l.doc_id, v.h, string_agg(v.digest, '' order by v.rank) filter (v.rank < l.rank // (3 ** v.h)::bigint) as l,
         string_agg(v.digest, '' order by v.rank) filter (v.rank > l.rank // (3 ** v.h)::bigint) as r
  from leaf l join lv v on l.source is not distinct from v.source and v.n > 1 and v.rank // 3 = l.rank // (3 ** (v.h + 1))::bigint
  group by all
  union all
  select l.doc_id, 100 + v.h, string_agg(v.digest, '' order by v.rank) filter (v.rank < s.srank // (3 ** v.h)::bigint),
         string_agg(v.digest, '' order by v.rank) filter (v.rank > s.srank // (3 ** v.h)::bigint)
  from leaf l join sub s on l.source is not distinct from s.source
  join tp v on v.n > 1 and v.rank // 3 = s.srank // (3 ** (v.h + 1))::bigint
  group by all),
o as (select *, row_number() over (partition by doc_id order by h) as k from step),
f as (
  select doc_id, 0 as k, coalesce(changed, leaf) as own from leaf
  union all
  select f.doc_id, o.k, sha256(coalesce(o.l, '') || own || coalesce(o.r, '')) from f join o on f.doc_id = o.doc_id and o.k = f.k + 1),
e as (select doc_id, arg_max(own, k) as folded_root from f group by doc_id),
p as (select doc_id, sha256(coalesce(string_agg(coalesce(l, '') || coalesce(r, ''), '' order by h), '')) as proof_sha256 from step group by doc_id)
select leaf.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root, folded_root = root as verified
from leaf join sub on leaf.source is not distinct from sub.source cross join root join e using (doc_id) left join p using (doc_id)"""


@query
def op13_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return source_divergence(table(spark, sf, "documents").select("lang", "source", "text"))


ORACLES["op13_source_divergence"] = r"""
with d as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
t as (select row, lang, source, unnest(terms) as term from d),
kept as (select lang, term, count(*) as of_lang from t group by lang, term having count(distinct row) >= 10),
v as (select lang, count(*) as v, sum(of_lang) as lang_total from kept group by lang),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from t join kept using (lang, term) group by all),
s as (select lang, source, sum(n) as total from c group by all),
p as (
  select g.lang, g.source, term, coalesce(n, 0) as n, of_lang, lang_total, v,
         1 + (1000000000::hugeint * (coalesce(n, 0) + 2)) // (coalesce(total, 0) + 2 * v) as p,
         1 + (1000000000::hugeint * (of_lang + 2)) // (lang_total + 2 * v) as q
  from g join kept using (lang) join v using (lang) left join s using (lang, source) left join c using (lang, source, term)),
pair as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
every as (
  select a.lang, a.source, b.source as item, coalesce(value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join pair on pair.lang = a.lang and pair.source = a.source and pair.item = b.source),
ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item)::int as rank from every
  union all
  select lang, source, 'term', term, value, row_number() over (partition by lang, source order by value desc, term)::int
  from (select *, ((p - q) * (p - q) // (p + q))::bigint as value from p where n > 0 and p > q) qualify row_number() over (partition by lang, source order by value desc, term) <= 10)
select * from ranked"""
