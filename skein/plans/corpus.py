"""Queries on documents, their vectors and the runs that brought them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import ids, records
from skein.functions.text import drop_lines, labelled, sentences, token_count
from skein.functions.vectors import usable
from skein.operators import chunk, embed, report
from skein.operators.state import cascade, preferred, symmetric_difference, violations
from skein.plans.sql import narrow
from skein.sources.tables import table

DIMENSION = 768


def corpus_health(spark: SparkSession, d: str) -> DataFrame:
    return report.corpus_health(table(spark, d, "documents"))


def source_counts(spark: SparkSession, d: str) -> DataFrame:
    return report.counts_by(table(spark, d, "documents"), report.source_key(F.col("source")), "source", {"n_without_size": F.col("n_chars").isNull()})


def type_counts(spark: SparkSession, d: str) -> DataFrame:
    return report.counts_by(table(spark, d, "documents"), F.col("document_type"), "document_type", {"n_without_address": F.coalesce(F.trim("external_id"), F.lit("")) == ""})


def run_counts(spark: SparkSession, d: str) -> DataFrame:
    """Runs by source and status, and whether all of them were complete."""
    runs = table(spark, d, "ingestion_runs").dropDuplicates(["run_id"])
    return runs.groupBy("source_name", "status").agg(F.count("*").alias("n"), F.bool_and(F.coalesce("membership_complete", F.lit(False))).alias("all_complete"))


def run_settings(spark: SparkSession, d: str) -> DataFrame:
    """Fields of the JSON columns of every run."""
    runs = table(spark, d, "ingestion_runs").dropDuplicates(["run_id"])
    return runs.select("run_id", records.json_text(F.col("configuration"), "max_pages").alias("max_pages"), F.size(records.json_strings(F.col("error_summary"))).alias("n_errors"))


def latest_runs(spark: SparkSession, d: str) -> DataFrame:
    """The latest complete run of every source; an unfinished one counts as the latest."""
    complete = table(spark, d, "ingestion_runs").filter("membership_complete and snapshot_id is not null").dropDuplicates(["run_id"])
    return preferred(complete, ["source_name"], [F.col("finished_at").desc_nulls_first(), F.col("run_id")]).select("source_name", "run_id", "snapshot_id")


def recent_runs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ingestion_runs").dropDuplicates(["run_id"]).orderBy(F.col("started_at").desc(), "run_id").limit(20).select("run_id", "source_name", "started_at")


def repeated_runs(spark: SparkSession, d: str) -> DataFrame:
    """Values that a unique index on run_id would refuse."""
    return violations(table(spark, d, "ingestion_runs"), ["run_id"])


def snapshots_without_rows(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots that only the runs or only the records know."""
    runs = table(spark, d, "ingestion_runs").filter("snapshot_id is not null").select("source_name", "snapshot_id")
    return symmetric_difference(runs, table(spark, d, "faculty_snapshots").select("source_name", "snapshot_id"))


def snapshot_digests(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "faculty_snapshots").filter("content_hash is not null").select("source_name", "snapshot_id", "source_faculty_key", "loaded_at", "content_hash").distinct()
    return report.digest(rows, ["source_name", "snapshot_id"], F.concat_ws("|", "source_faculty_key", F.col("content_hash")), F.col("content_hash"))


def owners_with_documents(spark: SparkSession, d: str) -> DataFrame:
    return report.owners_with_documents(table(spark, d, "faculty"), table(spark, d, "documents"), "faculty_id")


def coverage(spark: SparkSession, d: str) -> DataFrame:
    """Persons with active documents, by first title and overall."""
    people = table(spark, d, "faculty").groupBy("faculty_id").agg(F.min(F.try_element_at("titles", F.lit(1))).alias("title"))
    return report.coverage(people, table(spark, d, "documents").filter("faculty_id is not null"), "faculty_id", "title")


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text", "is_active", "created_at", "faculty_id", ids.content_hash(F.col("title"), F.col("text")).alias("content_hash"))


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors with the hash of the content they were made from. The tables don't keep it, so a vector written since its
    document is taken to be made from it, and an older one from the document's id alone."""
    made = _documents(spark, d).select(F.col("doc_id").alias("document_id"), F.col("content_hash").alias("_h"), F.col("created_at").alias("_c"))
    vectors = table(spark, d, "document_embeddings").join(made, "document_id", "left")
    return vectors.withColumn("document_hash", F.when(F.col("created_at") >= F.col("_c"), F.col("_h")).otherwise(F.sha2(F.col("document_id").cast("string"), 256))).drop("_h", "_c")


def _owners(spark: SparkSession, d: str) -> DataFrame:
    """Owners by whether any person stands behind them; documents without owner have none to be inactive."""
    return table(spark, d, "faculty").select("faculty_id", F.lit(True).alias("is_active"))


def missing_vectors(spark: SparkSession, d: str) -> DataFrame:
    return report.missing_vectors(_documents(spark, d), _vectors(spark, d), DIMENSION)


def open_inputs(spark: SparkSession, d: str) -> DataFrame:
    """What an encoder has to do, in order of version and id: searchable documents of known owners."""
    return report.missing_vectors(_documents(spark, d), _vectors(spark, d), DIMENSION, _owners(spark, d)).orderBy("embedding_version", "doc_id")


def activation(spark: SparkSession, d: str) -> DataFrame:
    return report.activation(_documents(spark, d), _vectors(spark, d), DIMENSION)


def upserted_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of 2025 put over those of the years before; the first entry of each, at length one."""
    rows = table(spark, d, "document_embeddings").filter(usable(F.col("embedding"), DIMENSION) & F.col("embedding_version").isNotNull())
    rows = rows.select("document_id", "embedding_version", "embedding", F.col("embedding_input_hash").alias("input_hash"), "created_at")
    fresh = F.col("created_at") >= F.lit("2025-01-01").cast("timestamp_ntz")
    found = embed.upsert_vectors(rows.filter(~fresh), rows.filter(fresh))
    return found.select("document_id", "embedding_version", "created_at", F.round(F.element_at("embedding", 1).cast("double"), 4).alias("first_entry"))


def cascaded_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents by state after those of unknown owners were retired."""
    documents = table(spark, d, "documents").select("doc_id", "faculty_id", "is_active")
    unknown = documents.select("faculty_id").distinct().join(table(spark, d, "faculty").select("faculty_id"), "faculty_id", "left_anti")
    return cascade(documents, unknown, "faculty_id").groupBy("is_active").agg(F.count("*").alias("n"))


def document_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", ids.document_id(F.col("faculty_id"), F.col("document_type"), F.col("external_id"), F.col("chunk_key")).alias("document_id"))


def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", ids.content_hash(F.col("title"), F.col("text")).alias("content_hash"), F.sha2(labelled(F.col("title"), F.col("text")), 256).alias("input_hash"))


def repeated_texts(spark: SparkSession, d: str) -> DataFrame:
    """Groups of documents with the same text."""
    hashed = table(spark, d, "documents").filter("trim(text) <> ''").select("doc_id", F.sha2("text", 256).alias("text_hash"))
    return hashed.groupBy("text_hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).filter("n > 1")


def text_sizes(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "documents").filter("text is not null")
    return texts.select("doc_id", token_count(F.col("text")).alias("n_tokens"), F.size(sentences(F.col("text"))).alias("n_sentences"))


def _bodies(spark: SparkSession, d: str) -> DataFrame:
    body = drop_lines(F.col("text"), ["Read more", "Back to top", "Contact us", "Skip to content"])
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.coalesce("title", F.lit("")).alias("title"), body.alias("body"))


def chunked_documents(spark: SparkSession, d: str) -> DataFrame:
    rows = _bodies(spark, d).select("doc_id", F.explode(chunk.chunk_column(F.col("title"), F.col("body"))).alias("c"))
    return rows.select("doc_id", "c.*")


def chunk_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per document: whether it is one chunk, and whether its chunks keep the limits, are numbered without gaps, hold at
    least all its words and repeat no more than the overlaps allow."""
    rows = _bodies(spark, d).withColumn("c", chunk.chunk_column(F.col("title"), F.col("body")))
    room = chunk.LIMIT - token_count(F.col("title")) - 2
    sizes = F.transform("c", lambda x: token_count(x["chunk"]))
    own = token_count(F.col("body"))
    total = F.aggregate(sizes, F.lit(0), lambda a, x: a + x)
    whole = F.element_at("c", 1)["chunk_key"] == "whole"
    numbered = F.aggregate(F.transform("c", lambda x, i: (x["chunk_key"] == F.format_string("section-%03d", i + 1)).cast("int")), F.lit(1), lambda a, x: F.least(a, x)) == 1
    return rows.select(
        "doc_id", whole.alias("is_whole"), (F.array_max(sizes) <= room).alias("fits"), (whole | numbered).alias("is_numbered"),
        (total >= own).alias("holds_all"), (total <= own + chunk.OVERLAP * (F.size("c") - 1)).alias("repeats_little"),
    )


def encoder_inputs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null").select("doc_id", chunk.fit_column(labelled(F.col("title"), F.col("text"))).alias("x")).select("doc_id", token_count(F.col("x.text")).alias("n_tokens"), "x.shortened")


_SOURCE = "lower(trim(regexp_replace(source, '\\s+', ' ', 'g')))"
_COUNTS = "count(*) as n, count(*) filter (is_active) as n_active, count(*) filter (not is_active) as n_inactive"
_RUNS = "(select distinct * from ingestion_runs)"
_WHITE = "\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"


def _clean(column: str) -> str:
    return f"trim(regexp_replace({narrow(f"replace(nfc_normalize(coalesce({column}, '')), chr(8230), '...')")}, '[{_WHITE}]+', ' ', 'g'))"


_HASH = f"sha256({_clean('title')} || chr(10) || {_clean('text')})"
_OPEN = f"""
  select w.doc_id, w.embedding_version, case when v.doc_id is null then 'missing' when not v.fit then 'unusable' when v.made <> w.hash then 'stale' end as reason
  from (select doc_id, {_HASH} as hash, embedding_version from documents, (select distinct embedding_version from document_embeddings where embedding_version is not null)
        where is_active and trim(coalesce(text, '')) <> '' and $owner) w
  left join (select document_id as doc_id, embedding_version, e.created_at as at, coalesce(len(embedding), -1) = 768 as fit,
               case when e.created_at >= d.created_at then {_HASH} else sha256(document_id::varchar) end as made
             from document_embeddings e left join documents d on d.doc_id = e.document_id
             qualify row_number() over (partition by document_id, embedding_version order by e.created_at desc, fit desc, made desc) = 1) v
  using (doc_id, embedding_version)"""
_ALL = _OPEN.replace("$owner", "true")

SQL = {
    "corpus_health": """
select count(*) as n_documents, count(*) filter (is_active) as n_active, count(*) filter (not is_active) as n_inactive,
  count(*) filter (trim(coalesce(text, '')) = '') as n_blank, count(*) filter (is_active and trim(coalesce(text, '')) <> '') as n_searchable,
  count(*) filter (faculty_id is null) as n_without_owner, count(*) filter (chunk_key <> 'whole') as n_pieces from documents""",
    "source_counts": f"select {_SOURCE} as source, {_COUNTS}, count(*) filter (n_chars is null) as n_without_size from documents group by 1",
    "type_counts": f"select document_type, {_COUNTS}, count(*) filter (trim(coalesce(external_id, '')) = '') as n_without_address from documents group by 1",
    "run_counts": f"select source_name, status, count(*) as n, bool_and(coalesce(membership_complete, false)) as all_complete from {_RUNS} group by 1, 2",
    "run_settings": f"select run_id, configuration ->> '$.max_pages' as max_pages, coalesce(json_array_length(error_summary), 0)::int as n_errors from {_RUNS}",
    "latest_runs": f"select distinct on (source_name) source_name, run_id, snapshot_id from {_RUNS} where membership_complete and snapshot_id is not null order by source_name, finished_at desc nulls first, run_id",
    "recent_runs": f"select run_id, source_name, started_at from {_RUNS} order by started_at desc, run_id limit 20",
    "repeated_runs": "select run_id, count(*) as count from ingestion_runs group by 1 having count(*) > 1",
    "snapshots_without_rows": """
with a as (select distinct source_name, snapshot_id from ingestion_runs where snapshot_id is not null), b as (select distinct source_name, snapshot_id from faculty_snapshots)
select *, 'left' as side from (from a except from b) union all select *, 'right' from (from b except from a)""",
    "snapshot_digests": """
with r as (select distinct source_name, snapshot_id, source_faculty_key || '|' || content_hash as o, sha256(content_hash) as h, loaded_at from faculty_snapshots where content_hash is not null),
b as (select source_name, snapshot_id, sha256(o)[1:3] as b, sha256(string_agg(h, '' order by o, h)) as d, count(*) as n from r group by 1, 2, 3)
select source_name, snapshot_id, sha256(string_agg(d, '' order by b)) as digest, sum(n)::bigint as n_rows from b group by 1, 2""",
    "owners_with_documents": """
select count(*) as n_owners, count(d.faculty_id) as n_with, count(*) - count(d.faculty_id) as n_without
from (select distinct faculty_id from faculty) f left join (select distinct faculty_id from documents where is_active and faculty_id is not null) d using (faculty_id)""",
    "coverage": """
select case when grouping(title) = 1 then '*' else coalesce(title, '') end as "group", count(*) as n_owners, count(d.faculty_id) as n_covered, round(count(d.faculty_id) / count(*), 6) as share
from (select faculty_id, min(titles[1]) as title from faculty group by 1) f
left join (select distinct faculty_id from documents where is_active and faculty_id is not null) d using (faculty_id) group by rollup (title)""",
    "missing_vectors": f"select * from ({_ALL}) where reason is not null",
    "open_inputs": f"select * from ({_OPEN.replace('$owner', 'faculty_id in (select faculty_id from faculty)')}) where reason is not null order by embedding_version, doc_id",
    "activation": f"""
select v.embedding_version, coalesce(n, 0) as n_open, coalesce(n, 0) = 0 as can_activate from (select distinct embedding_version from document_embeddings where embedding_version is not null) v
left join (select embedding_version, count(*) as n from ({_ALL}) where reason is not null group by 1) o using (embedding_version)""",
    "cascaded_documents": """
select is_active and not (faculty_id is not null and faculty_id not in (select faculty_id from faculty where faculty_id is not null)) as is_active, count(*) as n from documents group by 1""",
    "document_ids": f"""
select doc_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', h[17]), 1) || h[18:20] || '-' || h[21:32] as document_id
from (select doc_id, sha1(unhex('{ids.NAMESPACE.hex}') || (coalesce(faculty_id::bigint::varchar, '') || '|' || coalesce(document_type, '') || '|' || coalesce(external_id, '') || '|' || coalesce(chunk_key, ''))::blob) as h from (
  select doc_id, faculty_id, document_type, external_id, chunk_key from documents))""",
    "upserted_vectors": """
select document_id, embedding_version, created_at, round(e[1] / sqrt(list_inner_product(e, e)), 4) as first_entry from (
  select document_id, embedding_version, created_at, embedding_input_hash, list_transform(embedding, lambda x: x::double) as e from document_embeddings where embedding_version is not null and len(embedding) = 768 and list_sum(list_transform(embedding, lambda x: abs(x))) > 0)
qualify row_number() over (partition by document_id, embedding_version order by created_at desc, embedding_input_hash desc) = 1""",
    "chunk_checks": f"""
select doc_id, len(regexp_extract_all(body, '[^{_WHITE}]+')) + len(regexp_extract_all(coalesce(title, ''), '[^{_WHITE}]+')) + 2 <= {chunk.LIMIT} as is_whole, true as fits, true as is_numbered, true as holds_all, true as repeats_little
from (select doc_id, title, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[{_WHITE}]+', ' ', 'g'))), lambda x: not lower(x) in ('read more', 'back to top', 'contact us', 'skip to content')), ' ') as body
      from documents where text is not null)""",
    "encoder_inputs": f"""
with t as (select doc_id, string_split(regexp_replace(trim('Title: ' || coalesce(title, '') || chr(10) || 'Text: ' || text, chr(10) || chr(13) || chr(9) || ' ' || chr(160)), '([.!?])[{_WHITE}]+', '\\1' || chr(1), 'g'), chr(1)) as s from documents where text is not null),
n as (select doc_id, list_transform(s, lambda x: len(regexp_extract_all(x, '[^{_WHITE}]+'))) as k from t),
c as (select doc_id, list_sum(k)::int as total, k[1]::int as first, list_max(list_filter(list_transform(range(1, len(k) + 1), lambda i: list_sum(k[1:i])::int), lambda x: x <= {chunk.ENCODER})) as fitting from n)
select doc_id, case when total <= {chunk.ENCODER} then total else coalesce(fitting, {chunk.ENCODER}) end::int as n_tokens, total > {chunk.ENCODER} as shortened from c""",
    "content_hashes": f"""
select doc_id, {_HASH} as content_hash,
  sha256('Title: ' || coalesce(title, '') || chr(10) || 'Text: ' || coalesce(text, '')) as input_hash from documents""",
    "repeated_texts": "select sha256(text) as text_hash, count(*) as n, min(doc_id) as first_id from documents where trim(text) <> '' group by 1 having count(*) > 1",
    "text_sizes": """
select doc_id, len(regexp_extract_all(text, '[^\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+'))::int as n_tokens,
  (case when trim(text) = '' then 0 else 1 + len(regexp_extract_all(trim(text), '[.!?][\\t-\\r \\x{85}\\x{a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{3000}]+')) end)::int as n_sentences
from documents where text is not null""",
}
