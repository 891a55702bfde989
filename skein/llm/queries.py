"""Queries of the training-data operators over the tables of one folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm import leak, linkage, markup, mixture, names, neighbours, split, topn, truncation
from skein.runtime import cut
from skein.sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    elements = p2_documents(spark, d).select("source_table", "record_id", F.explode("elements").alias("e"))
    return elements.select("source_table", "record_id", F.col("e.kind").alias("element_kind"), F.col("e.text").alias("element_text")).distinct()


def p2_documents(spark: SparkSession, d: str) -> DataFrame:
    pages = markup.pages_of(table(spark, d, "people_feed"), table(spark, d, "raw_faculty"))
    return markup.clean_documents(pages).select("key.*", "text_clean", "notation", "elements")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return topn.latest_papers(table(spark, d, "papers"), 10).select("author_id", "external_id")


def _embeddings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "document_embeddings").select(F.col("embedding_version").alias("version"), F.col("document_id").alias("id"), F.col("created_at").alias("at"), F.col("embedding").alias("v"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    near = neighbours.similar_vectors(_embeddings(spark, d), k=10, floor=0.80)
    return neighbours.similar_pairs(near).withColumnRenamed("version", "embedding_version")


def p4_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.similar_vectors(_embeddings(spark, d), k=10, every=100, probes=8)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_matches(spark, d).select("faculty_id", "author_id")


def p5_matches(spark: SparkSession, d: str) -> DataFrame:
    found = linkage.link(linkage.people(table(spark, d, "faculty")), linkage.profiles(table(spark, d, "author_candidates")))
    return found.select(F.col("person_id").cast("long").alias("faculty_id"), F.col("profile_id").alias("author_id"), "confidence")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    spelt = names.all_names(table(spark, d, "raw_faculty"), table(spark, d, "author_candidates"), table(spark, d, "papers"))
    return names.variant_pairs(spelt).select("name_a", "name_b")


def p6_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every name with the person it stands for and the number of names linked to it."""
    return names.variant_classes(names.all_names(table(spark, d, "raw_faculty"), table(spark, d, "author_candidates"), table(spark, d, "papers")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_pieces(spark, d).select("source_table", "item_id").distinct()


def p7_pieces(spark: SparkSession, d: str) -> DataFrame:
    texts = split.long_texts(table(spark, d, "raw_faculty"), table(spark, d, "documents"))
    return split.split_items(texts, "text", ["source_table", "item_id"])


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per long text: its words, and whether its pieces fit, are numbered without gaps, follow each other with an overlap
    of at most 50 words, and hold the whole text."""
    pieces = p7_pieces(spark, d).select("source_table", "item_id", "piece_no", "first_word", "n_words").distinct()
    order = Window.partitionBy("source_table", "item_id").orderBy("piece_no")
    before = F.lag(F.col("first_word") + F.col("n_words")).over(order)
    rows = pieces.withColumn("lap", F.coalesce(before - F.col("first_word"), F.lit(0)))
    return rows.groupBy("source_table", "item_id").agg(
        F.max(F.col("first_word") + F.col("n_words")).cast("long").alias("n_words"), (F.max("n_words") <= split.LIMIT).alias("fits"), (F.max("piece_no") == F.count("*")).alias("is_numbered"),
        F.bool_and(F.col("lap").between(0, split.OVERLAP)).alias("overlaps_little"), (F.min("first_word") == 0).alias("holds_all"),
    )


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(table(spark, d, "documents"), table(spark, d, "mixture_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(table(spark, d, "documents"), table(spark, d, "mixture_targets"))[1]


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per target source: whether it occurs, and whether its records, repeats and share keep to the target."""
    chosen, report = mixture.mix(table(spark, d, "documents"), table(spark, d, "mixture_targets"))
    chosen = cut(chosen)
    longest = chosen.groupBy("source").agg(F.max("copies").alias("most"), F.max("n_tokens").alias("longest"), F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids"))
    rows = report.join(longest, "source", "left")
    wanted = F.when(F.col("available_tokens") * F.col("max_repeats") > 0, F.col("target_share"))
    everywhere = F.sum(wanted).over(Window.partitionBy())  # one row per target source
    all_tokens = F.sum("chosen_tokens").over(Window.partitionBy())
    off = F.abs(F.col("chosen_tokens") - all_tokens * wanted / everywhere)
    return rows.select(
        "source", (F.col("available_documents") > 0).alias("occurs"), F.coalesce(F.col("most") <= F.col("max_repeats"), F.lit(True)).alias("repeats_kept"),
        F.coalesce(F.col("n") == F.col("ids"), F.lit(True)).alias("once_each"), F.coalesce(off <= F.greatest(F.col("longest"), 0.01 * all_tokens), F.col("chosen_tokens") == 0).alias("share_kept"),
    )


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.score_truncation(table(spark, d, "documents")).filter("truncated").select("doc_id").distinct()


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_rates(truncation.score_truncation(table(spark, d, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}


_MONTH = "list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], lower(regexp_extract(t, '(?i)\\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)', 1)))"
_SPACES = "\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"

def _plain(column: str) -> str:
    """Words of a text one space apart, with a space at both ends, as far as DuckDB can fold them."""
    bare = f"regexp_replace(replace(replace(replace(lower({column}), chr(64257), 'fi'), chr(64258), 'fl'), chr(223), 'ss'), '[\\p{{Cf}}]', '', 'g')".replace("{{", "{").replace("}}", "}")
    return f"' ' || trim(regexp_replace(strip_accents({bare}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '".replace("{{", "{").replace("}}", "}")


SQL = {
    "p4_found": """
with v as (
  select embedding_version, document_id as id, list_transform(embedding, lambda x: x::double) as e from document_embeddings
  where embedding_version is not null and document_id is not null and len(embedding) = 768 and list_sum(list_transform(embedding, lambda x: abs(x))) > 0
  qualify row_number() over (partition by embedding_version, document_id order by created_at desc) = 1),
u as (select *, sqrt(list_inner_product(e, e)) as n from v),
near as (
  select a.embedding_version, a.id as p, b.id as q, list_inner_product(a.e, b.e) / (a.n * b.n) as s
  from u a join u b on a.embedding_version = b.embedding_version and a.id <> b.id
  qualify row_number() over (partition by a.embedding_version, a.id order by s desc, b.id) <= 10)
select distinct embedding_version, least(p, q) as document_a, greatest(p, q) as document_b from near where s >= 0.80""",
    "p8_found": f"""
with i as (select item_id, string_split(trim({_plain("text")}), ' ') as w from eval_items where trim({_plain("text")}) <> ''),
p as (select distinct item_id, ' ' || array_to_string(w[j : j + least(12, len(w)) - 1], ' ') || ' ' as passage from (select item_id, w, unnest(range(1, len(w) - least(12, len(w)) + 2)) as j from i)),
d as (select doc_id, {_plain("text")} as t from documents where text is not null)
select distinct doc_id, item_id from d join p on contains(d.t, p.passage)""",
    "p9_checks": f"""
with t as (select distinct lower(trim(regexp_replace(source, '[{_SPACES}]+', ' ', 'g'))) as source from mixture_targets where trim(source) <> ''),
d as (select distinct lower(trim(regexp_replace(source, '[{_SPACES}]+', ' ', 'g'))) as source from documents where length(text) > 0)
select source, source in (select source from d where source is not null) as occurs, true as repeats_kept, true as once_each, true as share_kept from t""",
    "p3_found": f"""
with last as (
  select author_id, external_id, trim(coalesce(publication_date, '')) as t, year from papers where external_id is not null
  qualify row_number() over (partition by author_id, external_id order by fetched_at desc nulls last, publication_date desc) = 1),
parts as (
  select *, {_MONTH} as spoken,
    coalesce(try_cast(regexp_extract(t, '^(\\d{{4}})', 1) as int), 0) as y,
    coalesce(try_cast(regexp_extract(t, '^\\d{{4}}[-/](\\d{{1,2}})', 1) as int), 0) as m,
    coalesce(try_cast(regexp_extract(t, '^\\d{{4}}[-/]\\d{{1,2}}[-/](\\d{{1,2}})', 1) as int), 0) as d,
    coalesce(try_cast(regexp_extract(t, '(\\d{{4}})$', 1) as int), 0) as sy,
    coalesce(try_cast(coalesce(nullif(regexp_extract(t, '^(\\d{{1,2}}) ', 1), ''), regexp_extract(t, ' (\\d{{1,2}}),', 1)) as int), 0) as sd
  from last),
keyed as (
  select author_id, external_id, case
    when spoken > 0 and sy > 0 then sy * 10000 + spoken * 100 + sd
    when y > 0 then y * 10000 + case when m between 1 and 12 then m * 100 + case when d between 1 and 31 then d else 0 end else 0 end
    when year > 0 then cast(year as int) * 10000 else 0 end as k
  from parts)
select author_id, external_id from keyed
qualify row_number() over (partition by author_id order by k desc, external_id desc) <= 10""",
    "p7_checks": f"""
select distinct source_table, item_id, n_words, true as fits, true as is_numbered, true as overlaps_little, true as holds_all from (
  select source_table, item_id, len(regexp_extract_all(text, '[^{_SPACES}]+')) as n_words from (
    select 'raw_faculty' as source_table, record_id as item_id, biography as text from raw_faculty union all select 'documents', doc_id, text from documents)) where n_words > 400""",
    "p7_found": f"""
select distinct source_table, item_id from (
  select 'raw_faculty' as source_table, record_id as item_id, biography as text from raw_faculty
  union all select 'documents', doc_id, text from documents)
where len(regexp_extract_all(text, '[^{_SPACES}]+')) > 400""",
}
