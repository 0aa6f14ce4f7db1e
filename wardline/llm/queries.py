"""Registered queries of the training-data operators, over the whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe_codec, centroid_clustering, chat_tree, exact_dedup, language_id, line_dedup, packing, quality_classifier, quality_rules, simhash,
    source_divergence, substring_dedup, token_counts,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_exact_dedup", r"""
with prepared as (
  select doc_id, length(coalesce(text, '')) as points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as content
  from documents
), ranked as (
  select doc_id, content,
         first_value(doc_id) over w as keep_id,
         row_number() over w as nth,
         count(*) over (partition by content) as group_size
  from prepared window w as (partition by content order by points desc, doc_id)
)
select doc_id, keep_id, group_size, nth = 1 as kept, sha256(content) as text_sha256 from ranked
""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.classes(_table(spark, folder, "documents"))


@query("op2_chat_format", r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), said as (
  select *, case when role = 'assistant' then text else '' end as learned,
         length(regexp_replace(role || text, '[^<\[|\\]', '', 'g')) as escapes
  from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       sum(length(learned))::bigint as loss_chars,
       sha256(string_agg(learned, '' order by turn, role, text)) as loss_sha256,
       sum(13 + length(role) + length(text) + escapes)::bigint as formatted_chars
from said group by conv_id
""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    table = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return chat_tree.read_back(chat_tree.tokenized(chat_tree.prefix_trees(table.unionByName(extra)), tokenizer), tokenizer)


@query("op3_substring_dedup", r"""
with worded as (
  select row_number() over () as id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), places as (
  select id, unnest(range(1, len(words) - 33)) as first from worded
), windows as (
  select id, first, array_to_string(words[first:first + 34], ' ') as content from places join worded using (id)
), repeated as (
  select id, first from (select *, count(*) over (partition by content) as n from windows) where n > 1
), gone as (
  select distinct id, unnest(range(first, first + 35)) as place from repeated
), each as (
  select id, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from worded
), kept as (
  select id, count(*) as n, string_agg(word, ' ' order by place) as text from each anti join gone using (id, place) group by id
)
select doc_id, len(words) as n_words, len(words) - coalesce(n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from worded left join kept using (id)
""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digests(_table(spark, folder, "documents"))


@query("op4_best_fit_packing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_pieces(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_byte_bpe")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_codec.round_trip(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN)


@query("op6_quality_classifier")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality_classifier.scores(docs, quality_classifier.fit(docs, _table(spark, folder, "labels")))


@query("op7_line_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.summary(_table(spark, folder, "documents"))


@query("op8_quality_rules")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality_rules.verdicts(docs, quality_rules.fit(docs, _table(spark, folder, "labels")))


@query("op9_token_counts")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_simhash_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.classes(_table(spark, folder, "documents"))


#: Distances and means in whole numbers, one pair of steps for each round.
_ROUND = """
), near{n} as materialized (
  select p.id, p.place, p.x, p.vec_id, s.num from parts p join (
    select id, arg_min(num, d * 8 + num) as num from (
      select a.id, c.num, sum((a.x - c.x) * (a.x - c.x))::bigint as d from parts a join centre{n} c using (place) group by 1, 2) group by id) s using (id)
), centre{m} as materialized (
  select c.num, c.place, case when t.n is null then c.x else (t.s - ((t.s % t.n) + t.n) % t.n) // t.n end as x
  from centre{n} c left join (select num, place, sum(x)::bigint as s, count(*) as n from near{n} group by 1, 2) t using (num, place)"""


@query("op11_centroid_clustering", """
with kept as materialized (
  select row_number() over () as id, vec_id, embedding as v from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), parts as materialized (
  select id, vec_id, unnest(range(1, 65)) as place, unnest(list_transform(v, lambda x: floor(1024 * x::double)::bigint)) as x from kept
), first as (
  select id, row_number() over (order by sha256('3:' || vec_id)) - 1 as num from kept order by num limit 8
), centre0 as materialized (
  select num, place, x from parts join first using (id)""" + "".join(_ROUND.format(n=n, m=n + 1) for n in range(10)) + """
), last as (
  select id, any_value(vec_id) as vec_id, num, sum((a.x - c.x) * (a.x - c.x))::bigint as d
  from parts a join centre10 c using (place) group by id, num
), best as (
  select id, any_value(vec_id) as vec_id, arg_min(num, d * 8 + num) as cluster, min(d) as distance from last group by id
), named as (
  select num as cluster, sha256(string_agg(x::varchar, ',' order by place)) as centroid_sha256 from centre10 group by num
)
select vec_id, cluster::int as cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia,
       (sum(distance) over ())::bigint as inertia, centroid_sha256
from best join named using (cluster)
""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clustering.report(_table(spark, folder, "embeddings"))


@query("op12_language_id")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return language_id.identify(docs, language_id.fit(docs))


@query("op13_source_divergence", r"""
with docs as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
), said as (
  select id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
), counts as materialized (
  select lang, source, term, count(*) as n, count(distinct id) as docs from said group by all
), kept as materialized (
  select lang, term, sum(n)::hugeint as total from counts group by all having sum(docs) >= 30
), grp as materialized (
  select lang, source, coalesce(n, 0)::hugeint as n, coalesce(v, 0)::hugeint as v, coalesce(nl, 0)::hugeint as nl
  from (select distinct lang, source from docs)
  left join (select lang, source, sum(n) as n from counts join kept using (lang, term) group by all) using (lang, source)
  left join (select lang, count(*) as v, sum(total) as nl from kept group by all) using (lang)
), share as materialized (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as c, 1 + (1000000000 * (coalesce(c.n, 0) + 5)::hugeint) // (g.n + 5 * g.v) as p,
         1 + (1000000000 * (k.total + 5)) // (g.nl + 5 * g.v) as q
  from grp g join kept k using (lang) left join counts c using (lang, source, term)
), terms as (
  select lang, source, 'term' as part, term as item, (p - q)::bigint as value,
         row_number() over (partition by lang, source order by p - q desc, term) as rank
  from share where c > 0 and p > q
), pairs as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from share a join share b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), valued as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from grp a join grp b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
)
select lang, source, part, item, value, rank::int as rank from terms where rank <= 50
union all
select lang, source, part, item, value, (row_number() over (partition by lang, source order by value desc, item))::int as rank from valued
""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.audit(_table(spark, folder, "documents"))
