"""Queries that carry state over a batch: snapshots, sections, entities, publications, merges.

The last snapshot of every source is applied to the state that its complete snapshots before left behind. A record's
owner is the last part of its key; its documents are its summary and its title; a record without a profile address came
with a profile error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions import urls
from skein.functions.text import name_key
from skein.operators import state
from skein.operators.report import source_key
from skein.operators.snapshots import canonical_key
from skein.runtime import cut, join_small
from skein.sources.tables import table

RECORD = ["source_name", "key"]
PAYLOAD = ["owner_id", "name", "title", "research_summary"]
#: Papers fetched from then on are the batch, those fetched before are the stored ones.
SPLIT = "2025-01-01"


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """(source_name, snapshot_id, started, complete, place): snapshots of every source, the last one at place 1."""
    runs = table(spark, d, "ingestion_runs").filter("snapshot_id is not null").groupBy("source_name", "snapshot_id").agg(F.min("started_at").alias("started"), F.bool_or(F.coalesce("membership_complete", F.lit(False))).alias("complete"))
    return runs.withColumn("place", F.row_number().over(Window.partitionBy("source_name").orderBy(F.col("started").desc(), F.col("snapshot_id").desc())))


def _rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "faculty_snapshots").withColumn("key", canonical_key(F.col("source_faculty_key"))).withColumn("owner_id", F.regexp_extract("key", "[^/]+$", 0))
    place = F.struct("loaded_at", *[F.coalesce(c, F.lit("")) for c in ("name", "title", "research_summary", "profile_url")])
    return rows.groupBy("source_name", "snapshot_id", "key").agg(F.max_by(F.struct("owner_id", "name", "title", "research_summary", "profile_url"), place).alias("x")).select("source_name", "snapshot_id", "key", "x.*")


def _sections(records: DataFrame) -> DataFrame:
    parts = F.array(*[F.struct(F.lit(k).alias("document_type"), F.col(c).alias("text")) for k, c in (("summary", "research_summary"), ("title", "title"))])
    return records.withColumn("s", F.explode(parts)).filter(F.trim("s.text") != "").withColumn("document_type", F.col("s.document_type")).withColumn("content_hash", F.sha2("s.text", 256)).drop("s")


def _order() -> list:
    return [F.col("research_summary").isNotNull().desc(), F.col("last_seen").desc(), F.col("source_name"), F.col("key")]


def _applied(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    runs = cut(_runs(spark, d))
    rows = cut(_rows(spark, d))
    last = runs.filter("place = 1")
    before = runs.filter("complete and place > 1").withColumn("ordinal", F.row_number().over(Window.partitionBy("source_name").orderBy("started", "snapshot_id")))
    seen = state.absence_after(rows, before, F.col("key"))
    stored = join_small(rows, before.select("source_name", "snapshot_id", F.col("ordinal").alias("last_ordinal"), F.col("started").alias("last_seen")), ["source_name", "snapshot_id"]).join(seen, [*RECORD, "last_ordinal"])
    records = cut(stored.select(*RECORD, *PAYLOAD, "is_active", "missed", "last_seen"))
    batch = cut(join_small(rows, last.select("source_name", "snapshot_id"), ["source_name", "snapshot_id"]).withColumn("has_error", F.col("profile_url").isNull()))
    nothing = records.select("owner_id", "name").limit(0).withColumn("is_active", F.lit(True))
    tables = {
        "records": records,
        "documents": _sections(records).select(*RECORD, "document_type", "content_hash", "is_active"),
        "entities": state.rebuild_entities(nothing, records, "owner_id", ["name"], _order()),
    }
    return state.apply_snapshot(tables, batch, last.select("source_name", "complete", F.col("started").alias("now")), _sections(batch).select(*RECORD, "document_type", "content_hash"), RECORD, PAYLOAD, "owner_id", ["name"], _order())


def applied_records(spark: SparkSession, d: str) -> DataFrame:
    return _applied(spark, d)["records"].select(*RECORD, "name", "is_active", "missed", "last_seen")


def applied_documents(spark: SparkSession, d: str) -> DataFrame:
    return _applied(spark, d)["documents"].select(*RECORD, "document_type", "is_active", "changed")


def applied_entities(spark: SparkSession, d: str) -> DataFrame:
    return _applied(spark, d)["entities"].select("owner_id", "name", "is_active")


def applied_counts(spark: SparkSession, d: str) -> DataFrame:
    return _applied(spark, d)["counts"]


def applied_publications(spark: SparkSession, d: str) -> DataFrame:
    """Papers of an author after the batch of those fetched last; a batch with an untitled paper is incomplete, and
    papers from before 2015 have been missed once already."""
    rows = table(spark, d, "papers").filter("author_id is not null and external_id is not null").withColumn("id", F.concat_ws(":", "source_name", "external_id"))
    rows = rows.withColumn("_doi", urls.doi(F.col("doi"))).select("author_id", "id", "title", "year", "_doi", "fetched_at", (F.col("fetched_at") >= F.lit(SPLIT).cast("timestamp_ntz")).alias("late"))
    one = rows.groupBy("author_id", "id", "late").agg(F.max_by(F.struct("title", "year", "_doi", "fetched_at"), F.struct("fetched_at", F.coalesce("title", F.lit("")), F.coalesce("_doi", F.lit("")))).alias("x")).select("author_id", "id", "late", "x.*")
    one = cut(one.withColumn("aliases", F.array_compact(F.array(F.concat(F.lit("doi:"), "_doi"), F.lower("id")))).withColumn("providers", F.array("id")))
    stored = one.filter("not late").select("author_id", "id", "title", "aliases", "providers", F.col("title").isNotNull().alias("is_active"), F.when(F.col("year") < 2015, 1).otherwise(0).alias("missed"), F.col("fetched_at").alias("created_at"))
    batch = one.filter("late").select("author_id", "id", "title", "aliases", "providers")
    complete = batch.groupBy("author_id").agg(F.bool_and(F.col("title").isNotNull()).alias("complete"))
    found = state.apply_publications(stored, batch, complete, ["title"], owner="author_id")
    return found.select("author_id", "id", "title", F.array_join("aliases", "; ").alias("aliases"), "is_active", "missed", "matched")


def _merges(spark: SparkSession, d: str) -> DataFrame:
    """Persons with the same last word of their name, merged into the one of them with the smallest id."""
    word = F.element_at(F.split(name_key(F.col("name")), " "), -1)
    people = table(spark, d, "faculty").filter("faculty_id is not null and name is not null").groupBy("faculty_id").agg(F.min(word).alias("w"))
    return people.withColumn("to_id", F.min("faculty_id").over(Window.partitionBy("w"))).filter("to_id <> faculty_id").select(F.col("faculty_id").alias("from_id"), "to_id")


def merged_documents(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select(F.col("doc_id").alias("document_id"), F.col("faculty_id").alias("owner_id"), "document_type", "external_id", "chunk_key", "is_active")
    found = state.merge_entities(documents, _merges(spark, d))
    return found.select("document_id", "owner_id", "is_active", "folded_into", F.concat_ws(";", F.col("absorbed").cast("array<string>")).alias("absorbed"))


def _links(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "faculty").select(F.col("faculty_id").alias("owner_id"), F.explode("external_identifiers").alias("provider", "provider_id"))
    return pairs.groupBy("owner_id", "provider").agg(F.min("provider_id").alias("provider_id"))


def merged_links(spark: SparkSession, d: str) -> DataFrame:
    return state.merge_links(_links(spark, d), _merges(spark, d))


def refused_merges(spark: SparkSession, d: str) -> DataFrame:
    return state.merge_conflicts(_links(spark, d), _merges(spark, d))


def corpus_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The corpus over the last run with complete membership of every source."""
    runs = table(spark, d, "ingestion_runs").filter("status in ('complete', 'partial')").groupBy("run_id", "source_name", "status", "membership_complete").agg(F.max("started_at").alias("s"))
    last = runs.filter("membership_complete").groupBy(source_key(F.col("source_name")).alias("k")).agg(F.max_by("run_id", F.struct("s", "run_id")).alias("run_id"))
    return state.corpus_snapshot(runs, last)


_KEY = "lower(regexp_replace(trim(source_faculty_key), '[\\s/]+$', ''))"
_BASE = f"""
with r as (select source_name, snapshot_id, min(started_at) as s, bool_or(coalesce(membership_complete, false)) as c from ingestion_runs where snapshot_id is not null group by 1, 2),
l as (select * from r qualify row_number() over (partition by source_name order by s desc, snapshot_id desc) = 1),
t as (select r.*, row_number() over (partition by source_name order by r.s, r.snapshot_id) as n, count(*) over (partition by source_name) as k from r where c and (source_name, snapshot_id) not in (select source_name, snapshot_id from l)),
f as (select source_name, snapshot_id, {_KEY} as key, regexp_extract({_KEY}, '[^/]+$') as owner_id, name, title, research_summary, profile_url from faculty_snapshots
  qualify row_number() over (partition by source_name, snapshot_id, {_KEY} order by loaded_at desc, coalesce(name, '') desc, coalesce(title, '') desc, coalesce(research_summary, '') desc, coalesce(profile_url, '') desc) = 1),
o as (select f.*, least(k - n, 2)::int as missed, k - n < 2 as is_active, s as last_seen from f join t using (source_name, snapshot_id) qualify row_number() over (partition by source_name, key order by n desc) = 1),
b as (select f.*, l.c, l.s from f join l using (source_name, snapshot_id)),
a as (
  select coalesce(b.source_name, o.source_name) as source_name, coalesce(b.key, o.key) as key, b.key is not null as here, o.key is not null as known, o.is_active as was, b.profile_url is null as bad,
    case when b.key is not null then b.owner_id else o.owner_id end as owner_id, case when b.key is not null then b.name else o.name end as name, case when b.key is not null then b.research_summary else o.research_summary end as research_summary,
    case when b.key is not null then 0 when o.is_active and l.c then o.missed + 1 else o.missed end as missed,
    case when b.key is not null then true when o.is_active and l.c and o.missed + 1 >= 2 then false else o.is_active end as is_active,
    case when b.key is not null and (b.c or o.key is null) then b.s else o.last_seen end as last_seen
  from o full join b on o.source_name = b.source_name and o.key = b.key left join l on l.source_name = coalesce(b.source_name, o.source_name)),
od as (select source_name, key, is_active, unnest([{{'k': 'summary', 't': research_summary}}, {{'k': 'title', 't': title}}]) as x from o),
bd as (select source_name, key, unnest([{{'k': 'summary', 't': research_summary}}, {{'k': 'title', 't': title}}]) as x from b),
d as (
  select source_name, key, document_type, o.was, case when n.t is not null then true when (here and not bad) or (a.was and not a.is_active) then false else coalesce(o.was, false) end as is_active,
    n.t is not null and (o.t is null or o.t <> n.t) as changed
  from (select source_name, key, x.k as document_type, x.t as t, is_active as was from od where trim(x.t) <> '') o
  full join (select source_name, key, x.k as document_type, x.t as t from bd where trim(x.t) <> '') n using (source_name, key, document_type) join (select source_name, key, here, bad, is_active, was from a) a using (source_name, key))"""
_FIRST = "order by research_summary is not null desc, last_seen desc, source_name, key"
_MERGES = """
with p as (select faculty_id, min(string_split(trim(regexp_replace(lower(strip_accents(name)), '[^\\p{L}\\p{N}_]+', ' ', 'g')), ' ')[-1]) as w from faculty where faculty_id is not null and name is not null group by 1),
m as (select faculty_id as from_id, min(faculty_id) over (partition by w) as to_id from p qualify to_id <> faculty_id)"""
_LINKS = "links as (select owner_id, e.key as provider, min(e.value) as provider_id from (select faculty_id as owner_id, unnest(map_entries(external_identifiers)) as e from faculty) group by 1, 2)"

SQL = {
    "applied_records": f"{_BASE} select source_name, key, name, is_active, missed, last_seen from a",
    "applied_documents": f"{_BASE} select source_name, key, document_type, is_active, changed from d",
    "applied_entities": f"""{_BASE},
e as (select distinct on (owner_id) owner_id, name from o where is_active {_FIRST.replace("order by", "order by owner_id,")}),
g as (select distinct on (owner_id) owner_id, name from a where is_active {_FIRST.replace("order by", "order by owner_id,")})
select owner_id, case when g.owner_id is not null then g.name else e.name end as name, g.owner_id is not null as is_active
from (select owner_id from a union select owner_id from o) x left join g using (owner_id) left join e using (owner_id)""",
    "applied_counts": f"""{_BASE},
m as (select source_name, count(*) filter (not known) as added, count(*) filter (known and here) as refreshed, count(*) filter (not here and is_active and missed > 0) as missing, count(*) filter (was and not is_active) as retired from a group by 1),
w as (select source_name, count(*) filter (changed) as sections_changed, count(*) filter (was and not is_active) as sections_retired from d group by 1)
select m.*, coalesce(sections_changed, 0) as sections_changed, coalesce(sections_retired, 0) as sections_retired from m left join w using (source_name)""",
    "applied_publications": f"""
with p as (select author_id, source_name || ':' || external_id as id, title, year, fetched_at,
    nullif(regexp_replace(trim(regexp_replace(regexp_replace(lower(trim(doi)), '^https?://(dx\\.)?doi\\.org/', ''), '^doi:\\s*', '')), '[\\s.]+$', ''), '') as doi, fetched_at >= '{SPLIT}' as late
  from papers where author_id is not null and external_id is not null),
u as (select *, list_filter(['doi:' || doi, lower(id)], lambda x: x is not null) as aliases from p qualify row_number() over (partition by author_id, id, late order by fetched_at desc, coalesce(title, '') desc, coalesce(doi, '') desc) = 1),
s as (select *, title is not null as is_active, case when year < 2015 then 1 else 0 end as missed from u where not late),
i as (select * from u where late),
ia as (select author_id, id, unnest(aliases) as x from i), sa as (select author_id, id, is_active, fetched_at, unnest(aliases) as x from s),
m as (select distinct on (ia.author_id, ia.id) ia.author_id, ia.id, sa.id as to_id from ia join sa on ia.author_id = sa.author_id and ia.x = sa.x order by ia.author_id, ia.id, sa.is_active desc, sa.fetched_at, sa.id),
n as (select author_id, coalesce(to_id, id) as id, arg_min({{'t': title}}, id).t as title, list_sort(list_distinct(flatten(list(aliases)))) as aliases, bool_or(to_id is not null) as matched from i left join m using (author_id, id) group by 1, 2),
c as (select author_id, bool_and(title is not null) as complete from i group by 1)
select author_id, id, case when n.id is not null then n.title else s.title end as title, array_to_string(list_sort(list_distinct(list_concat(coalesce(s.aliases, []), coalesce(n.aliases, [])))), '; ') as aliases,
  case when n.id is not null then true when s.is_active and coalesce(complete, false) and s.missed + 1 > 1 then false else s.is_active end as is_active,
  case when n.id is not null then 0 when s.is_active and coalesce(complete, false) then s.missed + 1 else s.missed end as missed, coalesce(matched, false) as matched
from s full join n using (author_id, id) left join c using (author_id)""",
    "merged_documents": f"""{_MERGES},
v as (select doc_id as document_id, coalesce(to_id, faculty_id) as owner_id, document_type, external_id, chunk_key, is_active, to_id is null as own from documents left join m on from_id = faculty_id),
w as (select *, first_value(document_id) over (partition by owner_id, document_type, external_id, chunk_key, is_active order by own desc, document_id) as f from v),
x as (select document_id, owner_id, is_active and f = document_id as is_active, case when is_active and f <> document_id then f end as folded_into from w)
select document_id, owner_id, is_active, folded_into, coalesce(absorbed, '') as absorbed from x
left join (select folded_into as document_id, string_agg(document_id, ';' order by document_id) as absorbed from x where folded_into is not null group by 1) using (document_id)""",
    "merged_links": f"""{_MERGES}, {_LINKS}
select distinct on (coalesce(to_id, owner_id), provider) coalesce(to_id, owner_id) as owner_id, provider, provider_id from links left join m on from_id = owner_id order by coalesce(to_id, owner_id), provider, to_id is not null, owner_id, provider_id""",
    "refused_merges": f"""{_MERGES}, {_LINKS}, g as (select from_id, to_id from m union select to_id, to_id from m)
select to_id as owner_id, provider from links join g on from_id = owner_id where provider_id is not null group by 1, 2 having count(distinct provider_id) > 1""",
    "corpus_snapshot": """
with r as (select distinct on (source_name) run_id from ingestion_runs where membership_complete and status in ('complete', 'partial') order by source_name, started_at desc, run_id desc),
b as (select sha256(run_id)[1:3] as b, sha256(string_agg(sha256(run_id), '' order by run_id)) as d from r group by 1)
select (select sha256(string_agg(d, '' order by b)) from b) as snapshot_id, run_id from r""",
}
