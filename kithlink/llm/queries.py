"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kithlink.llm.common import scratch_path, table

WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kithlink.llm.passages import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kithlink.llm.sstable import read_shards, write_shards

    return read_shards(write_shards(table(spark, sf_dir, "documents"), scratch_path(spark, "token-shards"), WORD_VOCABULARY, end_id=1))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kithlink.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), WORD_VOCABULARY, limit=2048)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kithlink.llm.grades import classify_quality

    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kithlink.llm.decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5_SQL = r"""
with d as (
  select doc_id, row_number() over () as r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), b as (
  select item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null and item_id is not null
), win as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') as t
  from b, unnest(range(1, len(w) - least(len(w), 10) + 2)) as u(i) where len(w) > 0
), spans as (
  select r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as t
  from d, (select distinct n from win) s, unnest(range(1, len(w) - n + 2)) as u(i)
), found as (
  select r, i, s.n, item_id from spans s join win on s.n = win.n and s.t = win.t
), hit as (
  select r, count(distinct p) as n_hit from found, unnest(range(i, i + n)) as u(p) group by r
), named as (
  select r, count(*) as n_items, string_agg(x, ',' order by x) as items from (select distinct r, cast(item_id as varchar) as x from found) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join named using (r)
"""


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kithlink.llm.jaccard import near_duplicate_groups

    return near_duplicate_groups(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), s as (
  select distinct doc_id, array_to_string(list_slice(w, i, i + least(len(w), 5) - 1), ' ') as t
  from d, unnest(range(1, len(w) - least(len(w), 5) + 2)) as u(i) where len(w) > 0
), n as (
  select doc_id, count(*) as n from s group by doc_id
), link as (
  select a.doc_id as x, b.doc_id as y
  from s a join s b on a.t = b.t and a.doc_id <> b.doc_id join n p on p.doc_id = a.doc_id join n q on q.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, p.n, q.n
  having 100 * count(*) >= 75 * (p.n + q.n - count(*))
), reach(x, y) as (
  select doc_id, doc_id from d
  union
  select r.x, l.y from reach r join link l on r.y = l.x
)
select d.doc_id, coalesce(n.n, 0) as n_shingles, min(r.y) as component_id
from d left join n on n.doc_id = d.doc_id join reach r on r.x = d.doc_id group by d.doc_id, n.n
"""


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from kithlink.llm.topk import exact_top_k

    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP7_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.vec_id as query_id, b.vec_id as vec_id,
    cast(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q)
  where a.vec_id % 50 = 0
), ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
  from pairs
)
select * from ranked where rank <= 5
"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kithlink.llm.grades import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kithlink.llm.lines import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents"), min_words=1)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kithlink.llm.pieces import piece_digests

    return piece_digests(table(spark, sf_dir, "documents"), PIECE_VOCABULARY)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_passages, op2_token_shards, op3_token_counts, op4_quality, op5_decontaminate, op6_jaccard, op7_top_k, op8_toxicity, op9_lines, op10_sentencepiece)}


def oracle_sql() -> dict[str, str]:
    return {"op5_decontaminate": OP5_SQL, "op6_jaccard": OP6_SQL, "op7_top_k": OP7_SQL}
