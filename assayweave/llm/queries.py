"""Registered queries of the operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (
    decontaminate,
    html_extract,
    imatch,
    langid,
    mixing,
    negatives,
    pii,
    recompression,
    simhash,
    spelling,
    token_counts,
    token_output,
    toxicity,
)
from .common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_likeness(table(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.main_text(pages, html_extract.fit(pages)).withColumn("n_chars", F.length("text").cast("bigint"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = toxicity.held_out(F.col("doc_id"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels, ~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    found = langid.predict(docs, langid.fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_output.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.digests(spark, path)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.spans(docs, pii.fit(docs))

    def listed(column: str) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s.kind, s.begin, s.end)), ",")

    def counted(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [counted(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = recompression.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.usable(table(spark, sf_dir, "embeddings")))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", n_bytes)
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_text=False)
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_decontaminate": op2_decontaminate,
    "op3_imatch": op3_imatch,
    "op4_html": op4_html,
    "op5_toxicity": op5_toxicity,
    "op6_langid": op6_langid,
    "op7_mix": op7_mix,
    "op8_tokens": op8_tokens,
    "op9_pii": op9_pii,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_spelling": op11_spelling,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_counts": op13_token_counts,
}

_A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"


def _shingles(name: str, key: str, source: str) -> str:
    """Distinct (row, shingle) of five words of a table, with the row's key."""
    words = _WORDS.format(f"translate(text, {_A_Z})")
    return f"""
{name}_words as (select row_number() over () as r, {key}, {words} as w from {source}),
{name}_shingles as (
  select distinct r, {key}, array_to_string(w[i:i + 4], ' ') as s
  from (select r, {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from {name}_words where len(w) > 0))"""


SQL: dict[str, str] = {
    "op2_decontaminate": f"""
with {_shingles("doc", "doc_id", "documents")}, {_shingles("item", "item_id", "benchmark")},
sizes as (select r, count(*) as n_item from item_shingles group by r),
shared as (
  select d.r as dr, d.doc_id, i.r as ir, i.item_id, count(*) as n_shared
  from doc_shingles d join item_shingles i using (s) group by all)
select doc_id, item_id, n_item, n_shared, n_shared / n_item as containment
from shared join sizes on ir = sizes.r where n_shared >= 0.8 * n_item
""",
    "op7_mix": f"""
with sized as (select doc_id, source, len({_WORDS.format("text")}) as size from documents),
sources as (
  select source, sum(size)::bigint as source_size, least(ceil(count(*) / 4096), 4096)::bigint as shards,
    [3.0, 1.0, 2.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w
  from sized group by source),
capped as (select *, 2.0 * source_size as cap, sum(source_size) over () * 1.5 as total from sources),
levels as (
  select *, (total - coalesce(sum(cap) over (order by cap / w, source nulls last
      rows between unbounded preceding and 1 preceding), 0))
    / sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following) as level
  from capped),
aimed as (select *, least(cap, coalesce(w * max(level) filter (level * w <= cap) over (), cap)) as target from levels),
seats as (select *, round(sum(target) over () / 16)::bigint as n, sum(target) over () as goal from aimed),
quotients as (
  select source, k, target / (2 * k + 1) as q, n
  from (select *, unnest(range(0, (target * n / goal)::bigint + 60)) as k from seats where target > 0)),
quotas as (
  select source, count(*) as quota
  from (select source, n, row_number() over (order by q desc, source nulls last, k) as place from quotients)
  where place <= n group by source),
dealt as (
  select d.doc_id, d.size, s.source, s.source_size, s.target, coalesce(q.quota, 0) as quota,
    ('0x' || substr(md5('0|' || coalesce(d.doc_id::varchar, '')), 1, 15))::bigint % s.shards as shard
  from sized d join seats s on d.source is not distinct from s.source
    left join quotas q on s.source is not distinct from q.source),
shards as (
  select source, shard, quota, sum(size)::bigint as words, sum(sum(size)) over (partition by source) as goal
  from dealt group by source, shard, quota),
shard_quotients as (
  select source, shard, k, words / (2 * k + 1) as q, quota
  from (select *, unnest(range(0, (words * quota / goal)::bigint + 60)) as k from shards where words > 0)),
shard_quotas as (
  select source, shard, count(*) as blocks
  from (select source, shard, quota,
          row_number() over (partition by source order by q desc, shard, k) as place from shard_quotients)
  where place <= quota group by source, shard),
placed as (
  select d.doc_id, d.size, d.source, d.shard, d.source_size, d.target, ceil(s.words / 16)::bigint as n,
    least(coalesce(b.blocks, 0), 2 * ceil(s.words / 16)::bigint) as q,
    sum(d.size) over (partition by d.source, d.shard
      order by ('0x' || substr(md5('1|' || coalesce(d.doc_id::varchar, '')), 1, 15))::bigint, d.doc_id nulls first, d.size
      rows unbounded preceding)::bigint as e
  from dealt d join shards s on d.source is not distinct from s.source and d.shard = s.shard
    left join shard_quotas b on d.source is not distinct from b.source and d.shard = b.shard),
parts as (
  select *, q // n as whole, q - (q // n) * n as rest,
    ('0x' || substr(md5('2|' || coalesce(source, '') || '|' || shard::varchar), 1, 15))::bigint % n as start
  from placed where n > 0),
blocks as (
  select *, unnest(range((e - size) // 16, (e + 15) // 16)) as b from parts where size > 0),
extra as (
  select doc_id, size, source_size, target, whole, source, shard, e,
    sum((least(e, 16 * b + 16) - greatest(e - size, 16 * b))
      * (((b + 1) * rest + start) // n - (b * rest + start) // n)) as more
  from blocks group by all)
select doc_id, size, source_size, target, (whole * size + more)::bigint as taken from extra
union all
select doc_id, size, source_size, target, 0::bigint from dealt where size = 0
""",
    "op10_substring_dedup": f"""
with docs as (select row_number() over (order by doc_id, text) as r, doc_id, {_WORDS.format("text")} as w from documents),
windows as (
  select r, i, md5(array_to_string(w[i:i + 19], ' ')) as h
  from (select r, w, unnest(range(1, len(w) - 18)) as i from docs where len(w) >= 20)),
later as (select r, i from windows qualify row_number() over (partition by h order by r, i) > 1),
covered as (select distinct r, unnest(range(i, i + 20)) as i from later),
kept as (
  select d.r, string_agg(d.w[p], ' ' order by p) as text, count(*) as n
  from (select r, w, unnest(range(1, len(w) + 1)) as p from docs) d
    anti join covered c on d.r = c.r and d.p = c.i group by d.r)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256
from docs left join kept using (r)
""",
    "op11_spelling": f"""
with recursive crc as (
  select list(c order by b) as t
  from (select b, list_reduce(list_prepend(b, range(8)),
          lambda c, k: case when c & 1 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end) as c from range(256) r(b))),
runs as (
  select doc_id, run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(translate(text, {_A_Z}), '[a-z\u00C0-\u00FF]{{6,}}')) as run from documents)
  group by all),
coded as (
  select run, n, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
      lambda x: case when unicode(x) < 128 then [unicode(x)::bigint] else [195::bigint, unicode(x)::bigint - 64] end)) as b
  from runs),
hashed as (
  select run, n, xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, b),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) as h
  from coded, crc),
written as (
  select case when h % 199 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n
  from hashed),
words as (select word, sum(n)::bigint as n from written where length(word) >= 6 group by word having sum(n) >= 5),
cuts as (
  select word, p, left(word, p - 1) || substr(word, p + 1) as v
  from (select word, unnest(range(1, length(word) + 1)) as p from words)),
near as (
  select a.word, b.word as other from cuts a join cuts b on a.v = b.v and a.p = b.p and a.word <> b.word
  union select c.word, w.word from cuts c join words w on c.v = w.word
  union select w.word, c.word from cuts c join words w on c.v = w.word),
best as (
  select near.word, count(*) over (partition by near.word) as n_near, other as form, w.n as form_n
  from near join words w on w.word = other
  qualify row_number() over (partition by near.word order by w.n desc, other) = 1),
formed as (
  select words.word, words.n, coalesce(n_near, 0)::bigint as n_near,
    case when form_n >= 5 * words.n then form end as form, case when form_n >= 5 * words.n then form_n end as form_n
  from words left join best on words.word = best.word),
way as (
  select word, word as root from formed where form is null
  union all select formed.word, way.root from formed join way on formed.form = way.word)
select formed.word, form, root, n, n_near, form_n from formed join way on formed.word = way.word
""",
    "op12_hard_negatives": """
with sound as (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label, embedding from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
rows as (select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from sound),
scored as (
  select a.r, a.vec_id as anchor_id, b.r as other, b.vec_id as id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from rows a join rows b on a.r <> b.r where a.vec_id % 100 = 0),
positives as (
  select r, anchor_id, other, id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by r order by score desc, id, other) <= 5),
ranked as (
  select p.anchor_id, positive_id, positive_score, s.id as negative_id, s.score as negative_score,
    row_number() over (partition by p.r, p.other order by s.score desc, s.id, s.other) as rank
  from positives p join scored s on p.r = s.r and not s.same
    and 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from ranked where rank <= 5
""",
}
