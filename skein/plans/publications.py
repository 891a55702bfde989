"""Queries on publications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions import urls
from skein.operators import dedupe, matching
from skein.sources.tables import table

CUTOFF = 2025


def dois(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "papers").filter("doi is not null").select("doi").distinct().select("doi", urls.doi(F.col("doi")).alias("bare"))


def paper_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Of the rows of one paper and author the one with an abstract that was fetched last."""
    rows = table(spark, d, "papers")
    order = F.struct((F.coalesce(F.trim("abstract"), F.lit("")) != "").cast("int"), F.col("fetched_at"), F.coalesce("publication_date", F.lit("")))
    return rows.groupBy("author_id", "external_id").agg(F.max_by(F.struct("title", "year", "fetched_at"), order).alias("x")).select("author_id", "external_id", "x.*")


def works(spark: SparkSession, d: str) -> DataFrame:
    """One row per work of an author, with all its aliases."""
    found = dedupe.representatives(_once(table(spark, d, "papers")))
    ids = F.flatten(F.transform(F.map_entries("provider_ids"), lambda e: F.transform(e["value"], lambda v: F.concat(e["key"], F.lit(":"), v))))
    return found.select("author_id", "record", F.array_join("aliases", "; ").alias("aliases"), F.array_join(ids, "; ").alias("provider_ids"), "n_records")


def _once(papers: DataFrame) -> DataFrame:
    last = Window.partitionBy("author_id", "external_id").orderBy(F.col("fetched_at").desc(), F.col("publication_date").desc())
    return papers.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def recent_selection(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.select_recent(_once(table(spark, d, "papers")), CUTOFF).select("author_id", "external_id", "tier", "place")


def selection_counts(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.selection_counts(_once(table(spark, d, "papers")), CUTOFF)


def favourite_venues(spark: SparkSession, d: str) -> DataFrame:
    """The venue in which an author published most, with the lead over the second."""
    counts = _once(table(spark, d, "papers")).filter("venue is not null").groupBy("author_id", "venue").agg(F.count("*").cast("double").alias("score"))
    return matching.best_with_margin(counts, "author_id", "venue").select("author_id", "venue", "score", "second", "margin")


_ONCE = "(select * from papers qualify row_number() over (partition by author_id, external_id order by fetched_at desc, publication_date desc) = 1)"

_TITLE = "trim(regexp_replace(replace(lower(strip_accents(title)), chr(223), 'ss'), '[^\\p{L}\\p{N}_]+', ' ', 'g'))"
_BARE = "nullif(regexp_replace(trim(regexp_replace(regexp_replace(lower(trim(doi)), '^https?://(dx\\.)?doi\\.org/', ''), '^doi:\\s*', '')), '[\\s.]+$', ''), '')"

SQL = {
    "works": f"""
with recursive k as (
  select *, author_id || '|' || source_name || '|' || external_id as record,
    list_distinct(list_filter(['doi:' || {_BARE}, source_name || ':' || lower(external_id), case when {_TITLE} <> '' and year > 0 then 'title-year|' || {_TITLE} || '|' || year::int::varchar end], lambda x: x is not null)) as aliases
  from {_ONCE} where external_id is not null and title is not null),
e as (select distinct record, author_id || '|' || unnest(aliases) as alias from k),
r as (select record, record as other from k union select r.record, y.record from r join e x on r.other = x.record join e y on x.alias = y.alias),
c as (select record, min(other) as component from r group by 1),
j as (select k.*, component, row_number() over (partition by component order by {_BARE} is not null and trim(coalesce(doi, '')) <> '' desc, trim(coalesce(abstract, '')) <> '' desc,
    coalesce(nullif(trim(publication_date), ''), case when year > 0 then lpad(year::int::varchar, 4, '0') end, '') desc, record desc) as n from k join c using (record)),
g as (select component, array_to_string(list_sort(list_distinct(flatten(list(aliases)))), '; ') as aliases, string_agg(distinct source_name || ':' || external_id, '; ' order by source_name || ':' || external_id) as provider_ids, count(*) as n_records from j group by 1)
select author_id, record, g.aliases, g.provider_ids, g.n_records from j join g using (component) where n = 1""",
    "dois": "select distinct doi, nullif(regexp_replace(trim(regexp_replace(regexp_replace(lower(trim(doi)), '^https?://(dx\\.)?doi\\.org/', ''), '^doi:\\s*', '')), '[\\s.]+$', ''), '') as bare from papers where doi is not null",
    "paper_precedence": """
select author_id, external_id, title, year, fetched_at from papers
qualify row_number() over (partition by author_id, external_id order by (trim(coalesce(abstract, '')) <> '') desc, fetched_at desc, coalesce(publication_date, '') desc) = 1""",
    "recent_selection": f"""
select author_id, external_id, tier::int as tier, place::int as place from (
  select *, row_number() over (partition by author_id order by tier, date desc, source_name || ':' || external_id desc) as place from (
    select *, case when trim(coalesce(abstract, '')) <> '' then 1 when length(trim(regexp_replace(lower(strip_accents(title)), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))) >= 12 then 2 end as tier,
      coalesce(nullif(trim(publication_date), ''), lpad(year::int::varchar, 4, '0') || '-00-00') as date
    from {_ONCE} where year between {CUTOFF - 6} and {CUTOFF}) where tier is not null) where place <= 15""",
    "selection_counts": f"""
select author_id, count(*) filter (year is null) as without_year, count(*) filter (not (year between {CUTOFF - 6} and {CUTOFF})) as outside, count(*) filter (year between {CUTOFF - 6} and {CUTOFF}) as inside,
  greatest(0, count(*) filter (year between {CUTOFF - 6} and {CUTOFF}) - 15) as beyond from {_ONCE} group by 1""",
    "favourite_venues": f"""
with c as (select author_id, venue, count(*)::double as score from {_ONCE} where venue is not null group by 1, 2)
select author_id, venue, score, coalesce(second, 0) as second, score - coalesce(second, 0) as margin from (
  select *, lead(score) over w as second, row_number() over w as n from c window w as (partition by author_id order by score desc, venue)) where n = 1""",
}
