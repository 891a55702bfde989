"""Queries that search a corpus and measure the results. The query set is every document whose id is divisible by 100
and that has a vector; its title is the lexical query, its vector the dense one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.text import snippet, terms
from skein.functions.vectors import usable
from skein.operators import evaluate, retrieval
from skein.runtime import cut, join_small
from skein.plans.sql import narrow
from skein.sources.tables import table

VERSION = "st-base@r5+fmt2"


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    """Usable vectors of the active version, of documents that can be searched."""
    active = table(spark, d, "documents").filter("is_active and trim(text) <> ''").select(F.col("doc_id").alias("document_id"))
    rows = table(spark, d, "document_embeddings").join(active, "document_id", "left_semi").filter((F.col("embedding_version") == VERSION) & usable(F.col("embedding"), 768))
    return rows.groupBy("document_id").agg(F.max_by("embedding", "created_at").alias("vector")).withColumnRenamed("document_id", "doc_id")


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("is_active and trim(text) <> ''").select("doc_id", "title", "text")


def _titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), F.col("title").alias("text"))


def nearest_items(spark: SparkSession, d: str) -> DataFrame:
    """Exact top 10 among the labelled vectors for every id divisible by 100."""
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    return retrieval.dense_top_k(rows.filter("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id"), rows, 10)


def dense(spark: SparkSession, d: str) -> DataFrame:
    vectors = _vectors(spark, d)
    return retrieval.dense_top_k(vectors.filter("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id"), vectors, 50)


def lexical(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.bm25_top_k(_titles(spark, d), _texts(spark, d), 50)


def all_terms(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold every word of the topic of a profile whose id ends in 00."""
    topics = table(spark, d, "author_candidates").filter("author_id like '%00'").select(F.explode("topics").alias("text")).distinct().select(F.col("text").alias("query_id"), "text")
    return retrieval.matching_all(topics, _texts(spark, d))


def fused(spark: SparkSession, d: str) -> DataFrame:
    return traced(spark, d).drop("rank_dense", "rank_lexical")


def traced(spark: SparkSession, d: str) -> DataFrame:
    """Fused results with the rank that each channel gave."""
    return retrieval.fuse({"dense": dense(spark, d), "lexical": lexical(spark, d)}, trace=True)


def owners(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "faculty").groupBy("faculty_id").agg(F.min("name").alias("owner_name"))
    documents = table(spark, d, "documents").join(names, "faculty_id", "left").select("doc_id", F.col("faculty_id").alias("owner_id"), "owner_name", "document_type", "external_id")
    return retrieval.rank_owners(fused(spark, d), documents)


def _judgments(spark: SparkSession, d: str) -> DataFrame:
    """Grades for the query set: 3 for a document of the same person and type, 1 for another of the same person."""
    rows = table(spark, d, "documents").filter("faculty_id is not null").select("doc_id", "faculty_id", F.col("document_type").alias("t"))
    q = rows.filter("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "faculty_id", F.col("t").alias("own"))
    return join_small(rows, q, ["faculty_id"]).filter("query_id <> doc_id").select("query_id", "doc_id", F.when(F.col("t") == F.col("own"), 3).otherwise(1).alias("grade"))


def retrieval_measures(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.measures(fused(spark, d), _judgments(spark, d))


def mean_measures(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.macro(retrieval_measures(spark, d), ["recall_5", "recall_10", "recall_20", "reciprocal_rank", "ndcg_5", "ndcg_10"])


def channel_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Mean measures of each channel alone, of both, and of both within the depth of one (50 results in all)."""
    a, b, truth = cut(dense(spark, d)), cut(lexical(spark, d)), cut(_judgments(spark, d))
    half = retrieval.fuse({"d": a.filter("rank <= 25"), "l": b.filter("rank <= 25")}, keep=50)
    runs = {"dense": retrieval.single(a), "lexical": retrieval.single(b), "fused": retrieval.fuse({"d": a, "l": b}), "fused_50": half}
    parts = [evaluate.macro(evaluate.measures(r, truth), ["recall_10", "reciprocal_rank", "ndcg_10"]).withColumn("channel", F.lit(name)) for name, r in runs.items()]
    return reduce(DataFrame.unionByName, parts)


def bootstrap(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.bootstrap(cut(retrieval_measures(spark, d)), "reciprocal_rank")


def evidence(spark: SparkSession, d: str) -> DataFrame:
    """The best document of each query with the passage that shows why."""
    top = fused(spark, d).filter("rank = 1").join(_titles(spark, d).withColumnRenamed("text", "asked"), "query_id")
    return join_small(_texts(spark, d), top, ["doc_id"]).select("query_id", "doc_id", snippet(F.col("text"), terms(F.col("asked"), 4)).alias("passage"))


def _words(column: str) -> str:
    """The words of a text, as far as DuckDB can fold them."""
    return f"list_filter(string_split(trim(regexp_replace(replace(lower(strip_accents({narrow(column)})), chr(223), 'ss'), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')), ' '), lambda x: x <> '')"



_FOLDED = "trim(regexp_replace(replace(lower(strip_accents(owner_name)), chr(223), 'ss'), '[^\\p{L}\\p{N}_]+', ' ', 'g'))"


def _top(pairs: str, k: int) -> str:
    return f"select query_id, doc_id, score, (row_number() over (partition by query_id order by score desc, doc_id))::int as rank from ({pairs}) qualify rank <= {k}"


_DENSE = _top(
    """
  with v as (select document_id as doc_id, list_transform(embedding, lambda x: x::double) as e from document_embeddings where embedding_version = 'st-base@r5+fmt2' and document_id in (select doc_id from documents where is_active and trim(text) <> '') and len(embedding) = 768 and list_sum(list_transform(embedding, lambda x: abs(x))) > 0
    qualify row_number() over (partition by document_id order by created_at desc) = 1),
  u as (select doc_id, e, sqrt(list_inner_product(e, e)) as n from v)
  select q.doc_id as query_id, u.doc_id, round(list_inner_product(q.e, u.e) / (q.n * u.n), 6) as score from u q, u where q.doc_id % 100 = 0 and q.doc_id <> u.doc_id""",
    50,
)
_POSTINGS = f"""
  fields as (select doc_id, {_words("coalesce(title, '')")} as a, {_words("text")} as b from documents where is_active and trim(text) <> ''),
  posts as (select doc_id, len(a) * 2.5::double + len(b) as length, unnest(list_concat(list_transform(a, lambda x: {{{{'term': x, 'n': 2.5::double}}}}), list_transform(b, lambda x: {{{{'term': x, 'n': 1::double}}}}))) as x from fields),
  tf as (select x.term as term, doc_id, length, sum(x.n) as tf from posts group by all)""".replace("{{", "{").replace("}}", "}")
_LEXICAL = _top(
    f"""
  with {_POSTINGS}, df as (select term, count(*) as df from tf group by 1), s as (select avg(length) as mean from (select distinct doc_id, length from tf)), n as (select count(*) as n from documents where is_active and trim(text) <> ''),
  asked as (select distinct doc_id as query_id, unnest({_words("title")}) as term from documents where doc_id % 100 = 0)
  select query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 6) as score
  from asked join df using (term) join tf using (term), s, n group by 1, 2""",
    50,
)
_FUSED = f"""
select query_id, doc_id, score, best_rank, (row_number() over (partition by query_id order by score desc, best_rank, doc_id))::int as rank from (
  select query_id, doc_id, round(sum(1.0::double / (60 + rank)), 9) as score, min(rank) as best_rank from (select query_id, doc_id, rank from ({_DENSE}) union all select query_id, doc_id, rank from ({_LEXICAL})) group by 1, 2)
qualify rank <= 100"""
_TRUTH = """
  select q.doc_id as query_id, r.doc_id, case when r.document_type = q.document_type then 3 else 1 end as grade
  from documents q join documents r on q.faculty_id = r.faculty_id where q.doc_id % 100 = 0 and q.doc_id <> r.doc_id"""


def _ndcg(k: int) -> str:
    return f"case when n_relevant > 0 then round(coalesce(gain_{k}, 0) / ideal_{k}, 6) end as ndcg_{k}"


_PER_QUERY = f"""
with judged as ({_TRUTH}), ranked as ($ranked),
ideal as (select query_id, count(*) filter (grade >= 2) as n_relevant, sum((2.0 ** grade - 1) / log2(i + 1)) filter (i <= 5) as ideal_5, sum((2.0 ** grade - 1) / log2(i + 1)) filter (i <= 10) as ideal_10
  from (select *, row_number() over (partition by query_id order by grade desc, doc_id) as i from judged) group by 1),
found as (select r.query_id, count(*) filter (grade >= 2 and rank <= 5) as hit_5, count(*) filter (grade >= 2 and rank <= 10) as hit_10, count(*) filter (grade >= 2 and rank <= 20) as hit_20,
    min(rank) filter (grade >= 2) as first, sum(coalesce(2.0 ** grade - 1, 0) / log2(rank + 1)) filter (rank <= 5) as gain_5, sum(coalesce(2.0 ** grade - 1, 0) / log2(rank + 1)) filter (rank <= 10) as gain_10,
    avg((grade is not null)::int) filter (rank <= 5) as judged_5, avg((grade is not null)::int) filter (rank <= 10) as judged_10, avg((grade is not null)::int) filter (rank <= 20) as judged_20
  from ranked r left join judged j using (query_id, doc_id) group by 1)
select query_id, n_relevant, {", ".join(f"case when n_relevant > 0 then round(coalesce(hit_{k}, 0) / n_relevant, 6) end as recall_{k}" for k in (5, 10, 20))},
  case when n_relevant > 0 then round(coalesce(1 / first, 0), 6) end as reciprocal_rank, {_ndcg(5)}, {_ndcg(10)},
  {", ".join(f"round(coalesce(judged_{k}, 0), 6) as judged_{k}" for k in (5, 10, 20))} from ideal left join found using (query_id)"""
_MEASURES = _PER_QUERY.replace("$ranked", _FUSED)
_HALF = f"""
select query_id, doc_id, score, (row_number() over (partition by query_id order by score desc, best_rank, doc_id))::int as rank from (
  select query_id, doc_id, round(sum(1.0::double / (60 + rank)), 9) as score, min(rank) as best_rank from (select query_id, doc_id, rank from ({_DENSE}) where rank <= 25 union all select query_id, doc_id, rank from ({_LEXICAL}) where rank <= 25) group by 1, 2)
qualify rank <= 50"""

SQL = {
    "nearest_items": _top(
        """
  with u as (select vec_id as doc_id, list_transform(embedding, lambda x: x::double) as e, sqrt(list_inner_product(list_transform(embedding, lambda x: x::double), list_transform(embedding, lambda x: x::double))) as n from embeddings)
  select q.doc_id as query_id, u.doc_id, round(list_inner_product(q.e, u.e) / (q.n * u.n), 6) as score from u q, u where q.doc_id % 100 = 0 and q.doc_id <> u.doc_id""",
        10,
    ),
    "dense": _DENSE,
    "lexical": _LEXICAL,
    "all_terms": f"""
with {_POSTINGS}, asked as (select distinct t as query_id, unnest({_words("t")}) as term from (select distinct unnest(topics) as t from author_candidates where author_id like '%00')),
need as (select query_id, count(*) as n from asked group by 1)
select query_id, doc_id from (select query_id, doc_id, count(*) as have from asked join tf using (term) group by 1, 2) join need using (query_id) where have = n""",
    "fused": _FUSED,
    "traced": f"with f as ({_FUSED}), d as ({_DENSE}), l as ({_LEXICAL}) select f.*, d.rank as rank_dense, l.rank as rank_lexical from f left join d using (query_id, doc_id) left join l using (query_id, doc_id)",
    "channel_comparison": " union all ".join(
        f"select '{c}' as measure, round(avg({c}), 6) as mean, count({c}) as n_queries, '{name}' as channel from ({_PER_QUERY.replace('$ranked', ranked)})"
        for name, ranked in (("dense", _DENSE), ("lexical", _LEXICAL), ("fused", _FUSED), ("fused_50", _HALF)) for c in ("recall_10", "reciprocal_rank", "ndcg_10")),
    "owners": f"""
with o as (select faculty_id as owner_id, min(name) as owner_name from faculty group by 1),
d as (select f.*, faculty_id as owner_id, document_type, external_id from ({_FUSED}) f join documents using (doc_id) where faculty_id is not null),
once as (select * from d qualify row_number() over (partition by query_id, owner_id, document_type, external_id order by rank) = 1),
top as (select *, row_number() over (partition by query_id, owner_id order by rank) as p from once qualify p <= 3)
select query_id, owner_id, score, best_rank, n_evidence, (row_number() over (partition by query_id order by score desc, best_rank, k nulls last, owner_id))::int as rank from (
  select query_id, owner_id, min({_FOLDED}) as k, round(sum(score * case p when 1 then 0.6::double when 2 then 0.3::double else 0.1::double end), 9) as score, min(rank) as best_rank, count(*) as n_evidence from top left join o using (owner_id) group by 1, 2)
qualify rank <= 10""",
    "retrieval_measures": _MEASURES,
    "mean_measures": f"""
with m as ({_MEASURES})
{" union all ".join(f"select '{c}' as measure, round(avg({c}), 6) as mean, count({c}) as n_queries from m" for c in ("recall_5", "recall_10", "recall_20", "reciprocal_rank", "ndcg_5", "ndcg_10"))}""",
    "bootstrap": f"""
with v as (select (row_number() over (order by query_id) - 1)::bigint as i, reciprocal_rank as v from ({_MEASURES}) where reciprocal_rank is not null), n as (select count(*) as n from v),
draws as (select b, ((b * 7919 + v.i * 104729 + 12345) * 48271 % 2147483647) % n as i from v, n, range(200) r(b)),
means as (select b, avg(v.v) as m from draws join v using (i) group by 1), placed as (select m, row_number() over (order by m) as p from means)
select (select round(avg(v), 6) from v) as mean, round(max(m) filter (p = 5), 6) as low, round(max(m) filter (p = 195), 6) as high from placed""",
}
