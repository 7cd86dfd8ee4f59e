"""Registered queries of the subpackage: one per operator, and the pipeline.

Each reads the whole table it is for (``documents``, ``pages`` or ``embeddings``)
with production parameters.
"""
from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (divergence, exact_dedup, hard_negatives, licenses, line_dedup, mixing, ngram_join, packing, quality,
               sharding, substring_dedup, token_output, warc)
from .common import documents


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_lines(documents(spark, sf_dir))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(documents(spark, sf_dir)) \
        .select("doc_id", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"), "n_removed_words")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(documents(spark, sf_dir), words=3, percent=90)


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_output.token_output(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if top not in sys.path:
        sys.path.insert(0, top)
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_quality_rules, op3_sharding, op4_license_scan, op5_line_dedup, op6_exact_dedup,
    op7_best_fit_packing, op8_substring_dedup, op9_ngram_jaccard, op10_token_output,
    op11_source_divergence, op12_warc, op13_hard_negatives, pipeline)}

ORACLE = {
    "op6_exact_dedup": r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents),
g as (select norm, min(doc_id) as keep_id, count(*) as group_size from n group by norm)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from n join g using (norm)""",
    "op11_source_divergence": r"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as row,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
w as (select lang, source, row, unnest(terms) as term from d),
kept as (select lang, term, count(*)::hugeint as lang_n from w group by lang, term having count(distinct row) >= 30),
langs as (select lang, count(*) as v, sum(lang_n) as lang_own from kept group by lang),
c as (select lang, source, term, count(*)::hugeint as n from w join kept using (lang, term) group by lang, source, term),
own as (select lang, source, sum(n) as own from c group by lang, source),
g as (select d.lang, d.source, coalesce(own, 0) + 5 * coalesce(v, 0) as total, coalesce(lang_own, 0) + 5 * coalesce(v, 0) as lang_total
    from (select distinct lang, source from d) d left join own using (lang, source) left join langs using (lang)),
p as (select g.lang, g.source, k.term, coalesce(n, 0) as n, 1 + (1000000000 * (coalesce(n, 0) + 5)) // total as p,
    1 + (1000000000 * (lang_n + 5)) // lang_total as q
    from g join kept k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pair as (select a.lang, a.source, b.source as item, coalesce(sum(abs(x.p - y.p)), 0) as value
    from g a join g b on a.lang = b.lang and a.source <> b.source
    left join p x on x.lang = a.lang and x.source = a.source
    left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term group by all),
term as (select lang, source, term as item, p - q as value from p where n > 0 and p > q),
r as (select lang, source, 'pair' as part, item, value::bigint as value,
    row_number() over (partition by lang, source order by value desc, item)::int as rank from pair
    union all select lang, source, 'term', item, value::bigint,
    row_number() over (partition by lang, source order by value desc, item)::int from term)
select * from r where part = 'pair' or rank <= 50""",
    "op12_warc": r"""
with p as (select page_id, encode(coalesce(html, '')) as body, row_number() over () as row, url from pages),
k as (select *, octet_length(body)::bigint as payload_bytes, sha1(body) as payload_digest from p),
r as (select *, payload_bytes >= 1000 and row_number() over (partition by body order by page_id desc nulls last, url nulls first, row) > 1 as again,
    max(page_id) over (partition by body) as first_id from k)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type,
    case when again then first_id end as refers_to from r""",
    "op13_hard_negatives": r"""
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end::bigint as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as vec, row_number() over () as row from embeddings
    where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
a as (select * from v where vec_id % 100 = 0),
s as (select a.row as anchor, a.vec_id as anchor_id, a.label = v.label as same, v.vec_id, v.row,
    list_inner_product(a.vec, v.vec)::bigint as score from a join v on a.row <> v.row),
p as (select *, row_number() over (partition by anchor order by score desc, vec_id, row) as k from s where same),
n as (select p.anchor, p.k, p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score,
    s.score as negative_score, row_number() over (partition by p.anchor, p.k order by s.score desc, s.vec_id, s.row)::int as rank
    from p join s on s.anchor = p.anchor and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score where p.k <= 5)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 5""",
}
