"""What changed between consecutive full snapshots.

The snapshots are kept range-partitioned and sorted by key. Within a range every key's versions follow each other in
snapshot order, so one pointer on the earlier and one on the later version advance together over the range in a single
pass; each step compares the columns and emits a typed change. The pass is a window over the range partitioning
(`lag`/`lead`), which Spark runs as a streaming merge without another shuffle.

Defined cases: rows with a null source, snapshot or key are no records; repeated deliveries of a key collapse to the
one loaded last (full ties: the greatest content); a snapshot without rows removes everything; the first complete
snapshot gives no changes; null and empty values are equal; lists are compared as multisets, blank entries ignored.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions.canonical import SPACE, nfc, squeeze
from skein.runtime import cut, join_small


def canonical_key(key: Column) -> Column:
    """Trimmed, without slashes at the end, in lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(key, f"^[{SPACE}]+", ""), f"[{SPACE}/]+$", ""))


def _canonical(value: Column, kind: T.DataType) -> Column:
    """A value without differences in white space, null against empty, or order of list entries."""
    if isinstance(kind, T.StringType):
        return squeeze(value)
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        entries = F.transform(value, lambda x: _canonical(x, inner).cast("string") if not isinstance(inner, T.StructType) else _canonical(x, inner))
        return F.to_json(F.array_sort(F.filter(F.coalesce(entries, F.array().cast("array<string>")), lambda x: x != "")))
    if isinstance(kind, T.StructType):
        # an entry whose fields are all blank is a blank entry
        fields = [_canonical(value[f.name], f.dataType) for f in kind.fields]
        return F.when(F.concat(*fields) == "", "").otherwise(F.to_json(F.array(*fields)))
    return F.coalesce(value.cast("string"), F.lit(""))


def complete_snapshots(runs: DataFrame) -> DataFrame:
    """(source_name, snapshot_id, ordinal): the complete snapshots of each source, numbered by started_at from 1."""
    complete = (
        runs.filter(F.col("membership_complete") & F.col("snapshot_id").isNotNull() & F.col("source_name").isNotNull())
        .groupBy("source_name", "snapshot_id")
        .agg(F.min("started_at").alias("started_at"))
    )
    order = Window.partitionBy("source_name").orderBy("started_at", "snapshot_id")
    return complete.select("source_name", "snapshot_id", F.row_number().over(order).alias("ordinal"))


def canonical_rows(records: DataFrame, compare: list[str], key: str = "source_faculty_key", loaded: str = "loaded_at") -> DataFrame:
    """(source_name, snapshot_id, _key, _loaded, _values): records with a hash of the canonical form of every compared
    column, in the order of `compare`."""
    kinds = {f.name: f.dataType for f in records.schema.fields}
    # NFC goes through JSON once per row, and only rows with characters beyond ASCII leave the JVM
    shape = T.StructType([T.StructField(c, kinds[c]) for c in compare])
    rows = records.filter(F.col("source_name").isNotNull() & F.col("snapshot_id").isNotNull() & F.col(key).isNotNull()).select(
        "source_name", "snapshot_id", canonical_key(F.col(key)).alias("_key"), F.coalesce(F.col(loaded).cast("timestamp"), F.lit("0001-01-01").cast("timestamp")).alias("_loaded"), F.to_json(F.struct(*compare)).alias("_raw"))
    read = rows.withColumn("_row", F.from_json(nfc(F.col("_raw")), shape))
    return read.select("source_name", "snapshot_id", "_key", "_loaded", F.array(*[F.xxhash64(_canonical(F.col("_row")[c], kinds[c])) for c in compare]).alias("_values"))


def _last_loaded(rows: DataFrame, by: list[str]) -> DataFrame:
    """(*by, values): of repeated deliveries the one loaded last, of full ties the greatest."""
    return rows.groupBy(*by).agg(F.max(F.struct("_loaded", "_values"))["_values"].alias("values"))


def _merged(latest: DataFrame, spans: DataFrame, compare: list[str]) -> DataFrame:
    """(source_name, ordinal, _key, change_kind, changed_columns) of the versions (source_name, _key, ordinal, values);
    spans: (source_name, last)."""
    # ranges by key; the window below finds its distribution and order in place
    ranged = latest.repartitionByRange("source_name", "_key").sortWithinPartitions("source_name", "_key", "ordinal")
    walk = Window.partitionBy("source_name", "_key").orderBy("ordinal")
    merged = ranged.select("source_name", "_key", "ordinal", "values", F.lag("ordinal").over(walk).alias("before"), F.lag("values").over(walk).alias("old"), F.lead("ordinal").over(walk).alias("after"))
    names = F.array(*[F.lit(c) for c in compare])
    differing = F.filter(names, lambda c, n: F.get("values", n) != F.get("old", n))
    arrived = F.col("ordinal") > 1
    consecutive = F.coalesce(F.col("before") == F.col("ordinal") - 1, F.lit(False))
    here = F.when(arrived & ~consecutive, "added").when(consecutive & (F.col("values") != F.col("old")), "changed")
    gone = F.when(F.coalesce(F.col("after") != F.col("ordinal") + 1, F.lit(True)) & (F.col("ordinal") < F.col("last")), "removed")
    nothing = F.array().cast("array<string>")
    events = F.array(
        F.struct(F.col("ordinal").alias("at"), here.alias("kind"), F.when(here == "changed", differing).otherwise(nothing).alias("columns")),
        F.struct((F.col("ordinal") + 1).alias("at"), gone.alias("kind"), nothing.alias("columns")),
    )
    flat = join_small(merged, spans, ["source_name"]).select("source_name", "_key", F.explode(events).alias("e")).filter("e.kind is not null")
    return flat.select("source_name", F.col("e.at").alias("ordinal"), "_key", F.col("e.kind").alias("change_kind"), F.col("e.columns").alias("changed_columns"))


def snapshot_changes(records: DataFrame, runs: DataFrame, compare: list[str], key: str = "source_faculty_key", loaded: str = "loaded_at") -> DataFrame:
    """Typed changes between each complete snapshot and the complete one before it, over a whole history.

    Returns (source_name, snapshot_id, <key>, change_kind, changed_columns) with change_kind in added, removed, changed;
    snapshot_id is the later of the two; changed_columns names the columns that differ. A key that holds a third of all
    rows is collapsed by partial aggregation before any shuffle; a source that does is split by the ranges, since ranges
    are cut by (source, key).
    """
    timeline = cut(complete_snapshots(runs))
    rows = join_small(canonical_rows(records, compare, key, loaded), timeline, ["source_name", "snapshot_id"])
    latest = _last_loaded(rows, ["source_name", "_key", "ordinal"])
    events = _merged(latest, timeline.groupBy("source_name").agg(F.max("ordinal").alias("last")), compare)
    return join_small(events, timeline, ["source_name", "ordinal"]).select("source_name", "snapshot_id", F.col("_key").alias(key), "change_kind", "changed_columns")


class Archive:
    """Snapshots kept one by one in a folder, each range-partitioned and sorted by key, with hashes for its columns.

    A new snapshot is compared with the one before it alone, so it costs the same however long the history is. A snapshot
    that was kept already is replaced. `compare` must be the same for all snapshots of a folder.
    """

    def __init__(self, spark: SparkSession, folder: str, compare: list[str], key: str = "source_faculty_key") -> None:
        self.spark, self.folder, self.compare, self.key = spark, folder.rstrip("/"), compare, key

    def _place(self, source: str, snapshot: str) -> str:
        return f"{self.folder}/{hashlib.sha256(json.dumps([source, snapshot]).encode()).hexdigest()}"

    def keep(self, records: DataFrame, source: str, snapshot: str) -> None:
        """Writes the rows of one snapshot; other rows of `records` are left aside."""
        rows = canonical_rows(records.filter((F.col("source_name") == source) & (F.col("snapshot_id") == snapshot)), self.compare, self.key)
        latest = _last_loaded(rows, ["source_name", "_key"])
        latest.repartitionByRange("_key").sortWithinPartitions("_key").write.mode("overwrite").parquet(self._place(source, snapshot))

    def changes(self, source: str, before: str, after: str) -> DataFrame:
        """(source_name, snapshot_id, <key>, change_kind, changed_columns) between two kept snapshots of a source."""
        parts = [self.spark.read.parquet(self._place(source, s)).withColumn("ordinal", F.lit(n)) for n, s in enumerate((before, after), 1)]
        spans = self.spark.range(1).select(F.lit(source).alias("source_name"), F.lit(2).alias("last"))
        events = _merged(parts[0].unionByName(parts[1]), spans, self.compare)
        return events.select("source_name", F.lit(after).alias("snapshot_id"), F.col("_key").alias(self.key), "change_kind", "changed_columns")
