"""Queries on snapshot histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators.snapshots import snapshot_changes
from skein.sources.tables import table

COMPARED = ["name", "title", "affiliations", "profile_url", "research_areas", "research_summary"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_columns(spark, d).drop("changed_columns")


def p1_columns(spark: SparkSession, d: str) -> DataFrame:
    """All changes, with the columns that differ."""
    found = snapshot_changes(table(spark, d, "faculty_snapshots"), table(spark, d, "ingestion_runs"), COMPARED)
    return found.withColumn("changed_columns", F.array_join("changed_columns", ", "))


_C = "coalesce(trim(regexp_replace(nfc_normalize({}), '[\\t-\\r \\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g')), '')"

_VALUES = {
    **{c: _C.format(c) for c in ("name", "title", "profile_url", "research_summary")},
    "affiliations": f"list_sort(list_transform(coalesce(affiliations, []), lambda a: {_C.format('a.school')} || chr(2) || {_C.format('a.department')}))::varchar",
    "research_areas": f"list_sort(list_transform(coalesce(research_areas, []), lambda a: {_C.format('a')}))::varchar",
}
_DIFFERENT = ", ".join(f"case when content.{c} <> old.{c} then '{c}' end" for c in COMPARED)
_CHANGES = f"""
with timeline as (
  select source_name, snapshot_id, row_number() over (partition by source_name order by min(started_at), snapshot_id) as n
  from ingestion_runs where membership_complete and snapshot_id is not null group by source_name, snapshot_id),
latest as (
  select s.source_name, t.n, lower(rtrim(trim(s.source_faculty_key), '/')) as k, struct_pack({", ".join(f"{c} := {v}" for c, v in _VALUES.items())}) as content
  from faculty_snapshots s join timeline t using (source_name, snapshot_id)
  qualify row_number() over (partition by s.source_name, t.n, k order by loaded_at desc) = 1),
walked as (
  select *, lag(n) over w as before, lag(content) over w as old, lead(n) over w as after from latest window w as (partition by source_name, k order by n)),
spans as (select source_name, max(n) as last from timeline group by source_name),
events as (
  select source_name, n, k, 'added' as kind, '' as columns from walked where n > 1 and (before is null or before <> n - 1)
  union all select source_name, n, k, 'changed', array_to_string(list_filter([{_DIFFERENT}], lambda x: x is not null), ', ') from walked where before = n - 1 and old <> content
  union all select w.source_name, n + 1, k, 'removed', '' from walked w join spans p using (source_name) where n < p.last and (after is null or after <> n + 1))
select e.source_name, t.snapshot_id, e.k as source_faculty_key, e.kind as change_kind, e.columns as changed_columns from events e join timeline t using (source_name, n)"""

SQL = {"p1_columns": _CHANGES, "p1_found": f"select source_name, snapshot_id, source_faculty_key, change_kind from ({_CHANGES})"}
