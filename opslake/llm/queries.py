"""The thin queries over the given tables: each runs its operator over the whole table and
derives the columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.llm import bpe, kneser_ney
from opslake.llm.collocations import mine_phrases, top_phrases
from opslake.llm.common import ROW, load, lower_ascii
from opslake.llm.decontaminate import benchmark_hits, hit_words
from opslake.llm.exact_dedup import exact_dedup
from opslake.llm.hard_negatives import mine_hard_negatives
from opslake.llm.html_text import extract_main_text
from opslake.llm.language_id import detect_language, fold, train
from opslake.llm.line_dedup import dedup_lines
from opslake.llm.quality import quality_scores
from opslake.llm.registry import ORACLES, QUERIES, SQL_LOWER, register
from opslake.llm.simhash import simhash_groups
from opslake.llm.substring_dedup import substring_dedup
from opslake.llm.warc import warc_round_trip

__all__ = ["ORACLES", "QUERIES"]

OP1_SQL = f"""
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
  doc_id = max(doc_id) over g as kept, sha256(norm) as text_sha256
from (select doc_id, {SQL_LOWER} as norm from documents)
window g as (partition by norm)
"""


@register("op1_exact_dedup", OP1_SQL)
def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    norm = lower_ascii(F.coalesce("text", F.lit("")))
    docs = load(spark, sf, "documents").select(
        "doc_id", "text", F.sha2(norm.cast("binary"), 256).alias("text_sha256")
    )
    return exact_dedup(docs, carry=["text_sha256"]).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


OP6_SQL = r"""
with lines as (
  select doc_id, generate_subscripts(ls, 1) as pos, unnest(ls) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents)),
keyed as (
  select doc_id, pos, line, translate(
    trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
repeated as (select k from keyed where k <> '' group by k having count(distinct doc_id) >= 10),
marked as (
  select doc_id, pos, line, k in (select k from repeated) as gone from keyed)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""


@register("op6_line_dedup", OP6_SQL)
def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_lines(load(spark, sf, "documents")).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


OP4_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
bw as (
  select distinct item_id, least(10, len(ws)) as n,
    array_to_string(list_slice(ws, s, s + least(10, len(ws)) - 1), ' ') as w
  from (select item_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 9))) as s
        from b where len(ws) > 0)),
dw as (
  select doc_id, s, n, array_to_string(list_slice(ws, s, s + n - 1), ' ') as w
  from (select doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) as s
        from d, (select distinct n from bw) where len(ws) >= n)),
h as (select doc_id, s, dw.n as n, item_id from dw join bw using (w)),
hw as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(generate_series(s, s + n - 1)) as p from h) group by doc_id),
hi as (
  select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as ids
  from (select distinct doc_id, cast(item_id as varchar) as i from h) group by doc_id)
select doc_id, coalesce(len(ws), 0) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join hw using (doc_id) left join hi using (doc_id)
"""


@register("op4_decontaminate", OP4_SQL)
def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    hits = benchmark_hits(load(spark, sf, "documents"), load(spark, sf, "benchmark"))
    names = F.array_sort(F.transform("items", lambda item: item.cast("string")))
    return hits.select(
        "doc_id",
        "n_words",
        hit_words(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
    )


@register("op10_simhash")
def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_groups(load(spark, sf, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


OP3_SQL = """
with p as (
  select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as digest from pages),
f as (select *, case when n >= 100 then min(page_id) over (partition by digest, n)
  else page_id end as first_id from p)
select page_id, n as payload_bytes, digest as payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id = first_id then null else first_id end as refers_to
from f
"""


@register("op3_warc", OP3_SQL)
def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc_round_trip(load(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@register("op5_language_id")
def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = train(docs.where(~held_out))
    return detect_language(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


@register("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(False)).alias("held_out")
    docs = load(spark, sf, "documents").select("doc_id", held_out, "text")
    model = kneser_ney.train(docs.where(~F.col("held_out")))
    scored = kneser_ney.score_documents(docs, model, keep=("doc_id", "held_out"))
    return scored.withColumn("train_tokens", F.lit(model.train_tokens).cast("long"))


@register("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = load(spark, sf, "documents")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, with_decoded=True)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def acceptable() -> Column:
    """What the quality classifier learns to keep: good and not toxic, over ``labels``."""
    return (F.col("quality") == 1) & (F.col("toxic") == 0)


@register("op8_quality")
def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = load(spark, sf, "documents"), load(spark, sf, "labels")
    return quality_scores(docs, labels, acceptable()).drop(ROW)


@register("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = substring_dedup(load(spark, sf, "documents"), links=False)
    return found.select(
        "doc_id",
        "class_id",
        hit_words(F.col("spans")).alias("n_repeated_words"),
        "spans",
        "repeated",
    )


OP12_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as e
  from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select a.vec_id as anchor_id, c.vec_id as other_id, a.label = c.label as same,
    cast(coalesce(list_sum([p[1] * p[2] for p in list_zip(a.e, c.e)]), 0) as bigint) as score
  from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
p as (
  select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, p.positive_id,
  cast(row_number() over (partition by p.anchor_id, p.positive_id
    order by s.score desc, s.other_id) as integer) as rank,
  s.other_id as negative_id, p.positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same
  and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id
  order by s.score desc, s.other_id) <= 10
"""


@register("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    vectors = load(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0, label=moved)


OP11_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
f as (
  select lang, k, phrase, count(*) as f from (
    select lang, k,
      unnest([array_to_string(ws[i:i + k - 1], ' ') for i in generate_series(1, len(ws) - k + 1)]) as phrase
    from w, (select unnest([1, 2, 3, 4]) as k) where len(ws) >= k)
  group by all),
n as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by lang),
c as (select *, string_split(phrase, ' ') as ws from f where k >= 2 and f >= 30),
inside as (
  select lang, j, array_to_string(ws[i:i + j - 1], ' ') as phrase, f
  from (select *, unnest(generate_series(1, k - j + 1)) as i
        from (select *, unnest(generate_series(2, k - 1)) as j from c where k > 2))),
around as (select lang, phrase, max(f) as most from inside group by all),
cuts as (
  select c.lang, c.phrase, c.f as a, j, x.f as l, y.f as r,
    cast(cast(2000000 as hugeint) * c.f // (cast(x.f as hugeint) + y.f) as bigint) as score
  from (select *, unnest(generate_series(1, k - 1)) as j from c) c
  join f x on x.lang = c.lang and x.phrase = array_to_string(c.ws[1:j], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.ws[j + 1:], ' ')
  left join around o on o.lang = c.lang and o.phrase = c.phrase
  where o.most is null or cast(100 as hugeint) * o.most < cast(80 as hugeint) * c.f),
best as (
  select * from cuts
  qualify row_number() over (partition by lang, phrase order by score, j) = 1)
select lang, row_number() over g as rank, phrase, a, l, r, n, score
from best join n using (lang)
window g as (partition by lang order by score desc, a desc, phrase)
qualify row_number() over g <= 2000
"""


@register("op11_collocations", OP11_SQL)
def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    phrases = top_phrases(mine_phrases(load(spark, sf, "documents")))
    return phrases.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@register("op13_html_text")
def op13_html_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = extract_main_text(load(spark, sf, "pages"))
    n_chars = F.char_length("main_text").cast("long").alias("n_chars")
    return pages.select("page_id", "url", F.col("main_text").alias("text"), n_chars)
