"""Queries on people: names, addresses, affiliations, histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions import urls
from skein.functions.text import name_key
from skein.operators import dedupe, matching
from skein.operators.components import resolve_redirects
from skein.operators.snapshots import canonical_key, complete_snapshots
from skein.operators.state import absence_after, affiliations_of, preferred
from skein.sources.landing import plain_text
from skein.runtime import meet
from skein.sources.tables import table

#: Words of affiliations that count as the persons' own institution, in the data these queries run on.
HOME = ["northvale"]


def canonical_urls(spark: SparkSession, d: str) -> DataFrame:
    feed = table(spark, d, "people_feed").select(F.col("profile_url").alias("url"))
    raw = table(spark, d, "raw_faculty").select(F.col("source_url").alias("url"))
    return feed.unionByName(raw).filter("url is not null").distinct().select("url", urls.canonical_url(F.col("url")).alias("canonical"))


def url_matches(spark: SparkSession, d: str) -> DataFrame:
    """Records and the one record whose source address is their profile address."""
    raw = table(spark, d, "raw_faculty")
    return matching.unique_url_match(raw.select("record_id", "profile_url"), raw.select(F.col("record_id").alias("source_record"), "source_url"), "record_id", "source_record", "profile_url", "source_url")


def name_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "faculty").select("name").distinct().select("name", name_key(F.col("name")).alias("key"))


def reconciled(spark: SparkSession, d: str) -> DataFrame:
    """Directory records against the people feed, by address or else by name."""
    listing = table(spark, d, "raw_faculty").select(F.col("record_id").alias("listing_id"), F.col("profile_url").alias("url"), "name")
    feed = table(spark, d, "people_feed").select(F.col("wp_person_id").alias("feed_id"), F.col("profile_url").alias("url"), "name")
    return matching.reconcile(listing, feed)


def feed_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "people_feed").select("wp_person_id", "feed_page", plain_text(F.col("content_html")).alias("text"))


def merged_listings(spark: SparkSession, d: str) -> DataFrame:
    """One row per person of each source, from all its records."""
    rows = table(spark, d, "raw_faculty").withColumn("key", canonical_key(F.col("source_faculty_key")))
    merged = dedupe.merge_listings(rows, ["source_name", "key"], ["record_id"], ["name", "title"], ["research_areas"])
    return merged.select("source_name", "key", "name", "title", F.concat_ws("; ", "research_areas").alias("research_areas"), "n_rows")


def primary_affiliations(spark: SparkSession, d: str) -> DataFrame:
    found = affiliations_of(table(spark, d, "raw_faculty"), "record_id", [F.col("source_name")])
    return found.filter("is_primary").select("record_id", "school", F.lower(F.coalesce("department", F.lit(""))).alias("department"))


def preferred_observations(spark: SparkSession, d: str) -> DataFrame:
    """For each key the snapshot row with a summary that was loaded last, else the last one."""
    rows = table(spark, d, "faculty_snapshots").withColumn("key", canonical_key(F.col("source_faculty_key")))
    order = [F.col("research_summary").isNotNull().desc(), F.col("loaded_at").desc(), F.col("snapshot_id").desc(), F.col("name")]
    return preferred(rows, ["source_name", "key"], order).select("source_name", "key", "snapshot_id", "loaded_at")


def absences(spark: SparkSession, d: str) -> DataFrame:
    """Misses and state of every key after the last complete snapshot of its source."""
    timeline = complete_snapshots(table(spark, d, "ingestion_runs"))
    return absence_after(table(spark, d, "faculty_snapshots"), timeline, canonical_key(F.col("source_faculty_key")))


def identifiers(spark: SparkSession, d: str) -> DataFrame:
    """Distinct external identifiers by kind, over all records."""
    pairs = table(spark, d, "raw_faculty").select("record_id", F.explode("external_identifiers").alias("kind", "value"))
    return pairs.groupBy("kind").agg(F.count_distinct("value").alias("n_values"), F.count_distinct("record_id").alias("n_records"), F.min("value").alias("least"), F.max("value").alias("greatest"))


def profile_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Names that several profiles of one catalogue carry."""
    return matching.several_ids(table(spark, d, "author_candidates").filter("name is not null"), ["source_name", "name"], "author_id")


def shared_titles(spark: SparkSession, d: str) -> DataFrame:
    """Persons and profiles that share a title, and how many."""
    key = lambda c: F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))
    a = table(spark, d, "faculty").select("faculty_id", F.explode("known_publication_titles").alias("t")).select("faculty_id", key(F.col("t")).alias("t")).filter("t <> ''").distinct()
    b = table(spark, d, "author_candidates").select("author_id", F.explode("known_papers.title").alias("t")).select("author_id", key(F.col("t")).alias("t")).distinct()
    return a.join(b, "t").groupBy("faculty_id", "author_id").agg(F.count("*").alias("n_titles"))


def scored_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The best profile for each person by the weighted signals, among those with the same surname and initial."""
    words = lambda c: F.split(name_key(c), " ")
    block = lambda c: F.concat_ws("|", F.element_at(words(c), -1), F.substring(name_key(c), 1, 1))
    a = table(spark, d, "faculty").dropDuplicates(["faculty_id"]).select(F.col("faculty_id").alias("person_id"), "name", "affiliations", F.col("known_publication_titles").alias("titles"), "research_text", block(F.col("name")).alias("block"))
    b = table(spark, d, "author_candidates").dropDuplicates(["author_id"]).select(F.col("author_id").alias("candidate_id"), F.col("name").alias("candidate_name"), F.col("affiliations").alias("candidate_affiliations"), F.col("known_papers.title").alias("candidate_titles"), "topics", block(F.col("name")).alias("block"))
    pairs = meet(a, b, ["block"]).join(_persisted(spark, d), ["person_id", "candidate_id"], "left").withColumn("direct", F.col("stored").isNotNull())
    scored = matching.score_candidates(pairs, HOME)
    best = matching.decide(matching.best_with_margin(scored, "person_id", "candidate_id"))
    return best.select("person_id", "candidate_id", "score", "second", "margin", "decision")


def _persisted(spark: SparkSession, d: str) -> DataFrame:
    """(person_id, candidate_id, stored): the profile that shares most titles with a person, as an earlier run stored it."""
    shared = shared_titles(spark, d)
    best = shared.groupBy("faculty_id").agg(F.max_by("author_id", F.struct("n_titles", "author_id")).alias("candidate_id"))
    return best.select(F.col("faculty_id").alias("person_id"), "candidate_id", F.lit(True).alias("stored"))


def stored_links(spark: SparkSession, d: str) -> DataFrame:
    """Stored links of persons to profiles, and whether the profile is still delivered with a compatible name."""
    last = lambda c: F.element_at(F.split(name_key(F.col(c)), " "), -1)
    names = table(spark, d, "faculty").filter("name is not null").groupBy(F.col("faculty_id").alias("person_id")).agg(F.collect_set(last("name")).alias("a"))
    now = table(spark, d, "author_candidates").filter("name is not null").groupBy(F.col("author_id").alias("candidate_id")).agg(F.collect_set(last("name")).alias("b"))
    return matching.validate_links(_persisted(spark, d).join(names, "person_id", "left").join(now, "candidate_id", "left"), F.col("b").isNotNull(), F.arrays_overlap("a", "b")).select("person_id", "candidate_id", "outcome")


def redirect_ends(spark: SparkSession, d: str) -> DataFrame:
    """Every piece of a document redirects to the piece before it; the chains end at the first pieces."""
    pieces = table(spark, d, "documents").filter("chunk_key is not null and external_id is not null")
    before = F.lag("doc_id").over(Window.partitionBy("external_id").orderBy("chunk_key", "doc_id"))
    return resolve_redirects(pieces.select(F.col("doc_id").alias("from_id"), before.alias("to_id")))


_KEY = "lower(regexp_replace(trim(source_faculty_key), '[\\s/]+$', ''))"
_TIMELINE = """timeline as (
  select source_name, snapshot_id, row_number() over (partition by source_name order by min(started_at), snapshot_id) as ordinal
  from ingestion_runs where membership_complete and snapshot_id is not null group by 1, 2)"""
_CANON = """
  case when url ~ '(?i)^\\s*https?://[^/]' then
    lower(regexp_extract(trim(url), '(?i)^(https?://[^/?#]+)', 1)) ||
    (case when p = '' then '/' else p end) ||
    (case when q = '' then '' else '?' || q end) end"""
_PARTS = """
  select url, regexp_replace(regexp_replace(regexp_extract(trim(url), '(?i)^https?://[^/?#]+([^?#]*)', 1), '/+', '/', 'g'), '/$', '') as p,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> '' and not lower(x) ~ '^(utm_.*|fbclid=.*|gclid=.*|mc_cid=.*|mc_eid=.*)')), '&') as q from ({})"""
_FOLD = "trim(regexp_replace(replace(lower(strip_accents({})), chr(223), 'ss'), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"


def _matched(column: str, t: str, key: str) -> str:
    return f"select distinct {key}, lower(regexp_replace({_CANON}, '/+$', '')) as u from (select * from {t}) t join ({_PARTS.format(f'select distinct {column} as url from {t} where {column} is not null')}) s on t.{column} = s.url"


SQL = {
    "canonical_urls": f"select url, {_CANON} as canonical from ({_PARTS.format('select distinct profile_url as url from people_feed where profile_url is not null union select distinct source_url from raw_faculty where source_url is not null')})",
    "url_matches": f"""
select a.record_id, b.source_record from ({_matched("profile_url", "raw_faculty", "record_id")}) a
join (select u, min(record_id) as source_record from ({_matched("source_url", "raw_faculty", "record_id")}) group by 1 having count(distinct record_id) = 1) b using (u)""",
    "name_keys": f"select distinct name, {_FOLD.format('name')} as key from faculty",
    "merged_listings": f"""
select source_name, key, name, title, coalesce(areas, '') as research_areas, n_rows from (
  select source_name, {_KEY} as key, arg_min(name, record_id) filter (trim(coalesce(name, '')) <> '') as name, arg_min(title, record_id) filter (trim(coalesce(title, '')) <> '') as title, count(*) as n_rows
  from raw_faculty group by 1, 2)
left join (select source_name, key, string_agg(area, '; ' order by record_id, i) as areas from (
  select * from (select source_name, {_KEY} as key, record_id, unnest(research_areas) as area, generate_subscripts(research_areas, 1) as i from raw_faculty)
  qualify row_number() over (partition by source_name, key, area order by record_id, i) = 1) group by 1, 2) using (source_name, key)""",
    "primary_affiliations": """
select distinct on (record_id) record_id, a.school as school, lower(coalesce(a.department, '')) as department
from (select record_id, unnest(affiliations) as a from raw_faculty) where trim(coalesce(a.school, '')) <> '' order by record_id, a.school, lower(coalesce(a.department, ''))""",
    "preferred_observations": f"""
select distinct on (source_name, key) source_name, {_KEY} as key, snapshot_id, loaded_at from faculty_snapshots
order by source_name, key, research_summary is not null desc, loaded_at desc, snapshot_id desc, name""",
    "absences": f"""
with {_TIMELINE}, seen as (select s.source_name, {_KEY} as key, max(ordinal) as last_ordinal from faculty_snapshots s join timeline t using (source_name, snapshot_id) group by 1, 2)
select source_name, key, least(last - last_ordinal, 2)::int as missed, last - last_ordinal < 2 as is_active, last_ordinal
from seen join (select source_name, max(ordinal) as last from timeline group by 1) using (source_name)""",
    "identifiers": """
select e.key as kind, count(distinct e.value) as n_values, count(distinct record_id) as n_records, min(e.value) as least, max(e.value) as greatest
from (select record_id, unnest(map_entries(external_identifiers)) as e from raw_faculty) group by 1""",
    "profile_conflicts": "select source_name, name, count(distinct author_id) as n_ids from author_candidates where name is not null group by 1, 2 having count(distinct author_id) > 1",
    "shared_titles": """
with a as (select distinct faculty_id, trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) as t from (select faculty_id, unnest(known_publication_titles) as t from faculty) where trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) <> ''),
b as (select distinct author_id, trim(regexp_replace(lower(p.title), '[^a-z0-9]+', ' ', 'g')) as t from (select author_id, unnest(known_papers) as p from author_candidates))
select faculty_id, author_id, count(*) as n_titles from a join b using (t) group by 1, 2""",
    "stored_links": f"""
with a as (select distinct faculty_id, trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) as t from (select faculty_id, unnest(known_publication_titles) as t from faculty) where trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) <> ''),
b as (select distinct author_id, trim(regexp_replace(lower(p.title), '[^a-z0-9]+', ' ', 'g')) as t from (select author_id, unnest(known_papers) as p from author_candidates)),
l as (select distinct on (faculty_id) faculty_id as person_id, author_id as candidate_id from (select faculty_id, author_id, count(*) as n from a join b using (t) group by 1, 2) order by faculty_id, n desc, author_id desc),
f as (select distinct faculty_id as person_id, string_split({_FOLD.format('name')}, ' ')[-1] as w from faculty where name is not null), c as (select distinct author_id as candidate_id, string_split({_FOLD.format('name')}, ' ')[-1] as w from author_candidates where name is not null)
select person_id, candidate_id, case when candidate_id not in (select candidate_id from c) then 'lost' when exists (select 1 from f join c using (w) where f.person_id = l.person_id and c.candidate_id = l.candidate_id) then 'kept' else 'unclear' end as outcome from l""",
    "redirect_ends": """
select doc_id as from_id, first_value(doc_id) over w as to_id from documents where chunk_key is not null and external_id is not null
window w as (partition by external_id order by chunk_key, doc_id) qualify row_number() over w > 1""",
}
