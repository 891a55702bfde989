"""State carried from run to run, as functions (state, batch) -> state. Nothing is updated in place: each result is a
new version, written beside the old one and published by a manifest (skein.sources.versions)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.records import union_sorted
from skein.operators.components import resolve_redirects
from skein.operators.report import digest
from skein.runtime import cut, join_small

#: Complete batches that a record may miss before it is retired.
MISSES = 2


def _null_safe(keys: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def apply_batch(state: DataFrame, batch: DataFrame, keys: list[str], payload: list[str], complete: bool | DataFrame, now: Column | None = None, misses: int = MISSES) -> DataFrame:
    """State after one batch of records: (keys, payload, is_active, missed, last_seen).

    Records of the batch are new or refreshed and active, with no misses; last_seen moves only for a complete batch or
    a new record. After a complete batch, active records that are absent have missed one more and are retired at
    `misses`; an incomplete batch says nothing about absent ones. One full outer join on the keys. `complete` is one
    flag with `now` for the whole batch, or a frame (keys[0], complete, now) for a batch of several sources; sources it
    doesn't name delivered nothing and stay as they are.
    """
    old, new = state.alias("o"), batch.select(*keys, *payload).withColumn("_in", F.lit(True)).alias("n")
    joined = old.join(new, _null_safe(keys, "o", "n"), "full_outer")
    joined = joined.select(
        *[F.coalesce(f"n.{k}", f"o.{k}").alias(k) for k in keys], *[F.when(F.col("n._in").isNotNull(), F.col(f"n.{p}")).otherwise(F.col(f"o.{p}")).alias(p) for p in payload],
        F.col("n._in").isNotNull().alias("_here"), F.col("o.is_active").alias("_active"), F.col("o.missed").alias("_missed"), F.col("o.last_seen").alias("_seen"),
    )
    if isinstance(complete, DataFrame):
        joined = join_small(joined, complete.select(keys[0], F.col("complete").alias("_complete"), F.col("now").alias("_now")), [keys[0]], "left").withColumn("_complete", F.coalesce("_complete", F.lit(False)))
    else:
        joined = joined.withColumn("_complete", F.lit(complete)).withColumn("_now", now)
    here, full = F.col("_here"), F.col("_complete")
    absent = ~here & F.col("_active") & full
    missed = F.when(here, 0).when(absent, F.col("_missed") + 1).otherwise(F.col("_missed"))
    return joined.select(
        *keys, *payload,
        F.when(here, True).when(absent & (missed >= misses), False).otherwise(F.col("_active")).alias("is_active"),
        missed.cast("int").alias("missed"),
        F.when(here & (full | F.col("_active").isNull()), F.col("_now")).otherwise(F.col("_seen")).alias("last_seen"),
    )


def absence_after(records: DataFrame, timeline: DataFrame, key: Column, misses: int = MISSES) -> DataFrame:
    """The state that `apply_batch` reaches over all complete snapshots, in one pass: (source_name, key, missed,
    is_active, last_ordinal). A record's misses are the snapshots since it was last seen, up to the limit."""
    seen = records.select("source_name", "snapshot_id", key.alias("key")).join(timeline, ["source_name", "snapshot_id"]).groupBy("source_name", "key").agg(F.max("ordinal").alias("last_ordinal"))
    spans = timeline.groupBy("source_name").agg(F.max("ordinal").alias("_last"))
    missed = F.least(F.col("_last") - F.col("last_ordinal"), F.lit(misses)).cast("int")
    return seen.join(spans, "source_name").select("source_name", "key", missed.alias("missed"), (missed < misses).alias("is_active"), "last_ordinal")


def cascade(documents: DataFrame, retired: DataFrame, owner: str) -> DataFrame:
    """Documents with is_active false where their owner is among the retired (semi join as a left join on unique keys)."""
    gone = retired.select(owner).filter(F.col(owner).isNotNull()).distinct().withColumn("_gone", F.lit(True))
    return documents.join(gone, owner, "left").withColumn("is_active", F.col("is_active") & F.col("_gone").isNull()).drop("_gone").select(*documents.columns)


def upsert_documents(stored: DataFrame, incoming: DataFrame, key: str = "document_id", payload: tuple[str, ...] = ("content_hash", "text"), now: Column | None = None) -> DataFrame:
    """Stored documents with the incoming ones in their place, reactivated; `changed` marks new ones and those whose
    content hash differs. With `now`, stored has updated_at, which moves for every row that was written."""
    old, new = stored.alias("o"), incoming.select(key, *payload).withColumn("_in", F.lit(True)).alias("n")
    here = F.col("n._in").isNotNull()
    return old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(
        F.coalesce(f"n.{key}", f"o.{key}").alias(key),
        *[F.when(here, F.col(f"n.{p}")).otherwise(F.col(f"o.{p}")).alias(p) for p in payload],
        F.coalesce(here | F.col("o.is_active"), F.lit(False)).alias("is_active"),
        (here & ~F.col("o.content_hash").eqNullSafe(F.col("n.content_hash"))).alias("changed"),
        *([] if now is None else [F.when(here, now).otherwise(F.col("o.updated_at")).alias("updated_at")]),
    )


def touch(before: DataFrame, after: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """`after` with updated_at: `now` for rows that are new or differ from `before` in any column, else the old value."""
    fields = [c for c in after.columns if c not in keys and c != "updated_at"]
    old = before.select(*keys, F.struct(*fields).alias("_old"), "updated_at")
    joined = after.drop("updated_at").join(old, keys, "left")
    return joined.withColumn("updated_at", F.when(F.col("_old").eqNullSafe(F.struct(*fields)), F.col("updated_at")).otherwise(now)).drop("_old")


def apply_sections(stored: DataFrame, built: DataFrame, touched: DataFrame, retired: DataFrame, record: list[str], kind: str = "document_type") -> DataFrame:
    """(record, kind, content_hash, is_active, changed): section documents after a batch of records.

    stored: (record, kind, content_hash, is_active); built: (record, kind, content_hash) from the records of the batch;
    touched: (record, has_error) of those records; retired: records that the batch retired. Sections built anew are
    refreshed and active. Those of a touched record that were not rebuilt vanish, unless the record came with a profile
    error; those of retired records go inactive.
    """
    keys = [*record, kind]
    old, new = stored.alias("o"), built.select(*keys, "content_hash").withColumn("_in", F.lit(True)).alias("n")
    both = old.join(new, _null_safe(keys, "o", "n"), "full_outer").select(
        *[F.coalesce(f"n.{k}", f"o.{k}").alias(k) for k in keys],
        F.coalesce("n.content_hash", "o.content_hash").alias("content_hash"), F.col("n._in").isNotNull().alias("_here"), F.coalesce("o.is_active", F.lit(False)).alias("_active"),
        (F.col("n._in").isNotNull() & ~F.col("o.content_hash").eqNullSafe(F.col("n.content_hash"))).alias("changed"),
    )
    marks = touched.select(*record, F.coalesce("has_error", F.lit(False)).alias("_error")).join(retired.select(*record).withColumn("_gone", F.lit(True)), record, "full_outer")
    vanished = F.col("_error").isNotNull() & ~F.coalesce("_error", F.lit(False))
    active = F.when(F.col("_here"), True).when(vanished | F.col("_gone").isNotNull(), False).otherwise(F.col("_active"))
    return both.join(marks, record, "left").select(*keys, "content_hash", active.alias("is_active"), "changed")


def rebuild_entities(entities: DataFrame, records: DataFrame, owner: str, display: list[str], order: list[Column]) -> DataFrame:
    """(owner, display, is_active): entities after their records changed.

    An entity is active if at least one of its records is; its display fields are those of the active record that comes
    first in `order`. Without an active record it keeps its fields and goes inactive. Entities without any record stay.
    """
    best = preferred(records.filter("is_active"), [owner], order).select(owner, *[F.col(c).alias(f"_{c}") for c in display]).withColumn("_live", F.lit(True))
    known = records.select(owner).distinct().withColumn("_known", F.lit(True))
    joined = entities.join(known, owner, "full_outer").join(best, owner, "left")
    live = F.col("_live").isNotNull()
    return joined.select(owner, *[F.when(live, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in display], F.when(live, True).when(F.col("_known").isNotNull(), False).otherwise(F.col("is_active")).alias("is_active"))


def apply_snapshot(tables: dict[str, DataFrame], batch: DataFrame, runs: DataFrame, sections: DataFrame, keys: list[str], payload: list[str], owner: str, display: list[str], order: list[Column], misses: int = MISSES) -> dict[str, DataFrame]:
    """The whole state after a snapshot, as new tables to be published together: records, documents, entities, counts.

    tables: records (keys, payload, is_active, missed, last_seen), documents (keys, document_type, content_hash,
    is_active) and entities (owner, display, is_active); `owner` is one of the payload columns. batch: records with
    their payload and has_error; sections: the documents built from it. counts has one row per first key: records added,
    refreshed, missed, retired, and sections changed and retired.
    """
    old = tables["records"]
    after = cut(apply_batch(old, batch, keys, payload, runs, misses=misses))
    before = old.select(*keys, F.col("is_active").alias("_was"))
    retired = after.join(before, keys).filter("_was and not is_active").select(*keys)
    documents = cut(apply_sections(tables["documents"], sections, batch.select(*keys, "has_error"), retired, keys))
    entities = rebuild_entities(tables["entities"], after, owner, display, order)
    here = batch.select(*keys).withColumn("_here", F.lit(True))
    moves = after.join(before, keys, "left").join(here, keys, "left").groupBy(keys[0]).agg(
        F.count_if(F.col("_was").isNull()).alias("added"), F.count_if(F.col("_was").isNotNull() & F.col("_here").isNotNull()).alias("refreshed"),
        F.count_if(F.col("_here").isNull() & F.col("is_active") & (F.col("missed") > 0)).alias("missing"), F.count_if(F.col("_was") & ~F.col("is_active")).alias("retired"),
    )
    were = tables["documents"].select(*keys, "document_type", F.col("is_active").alias("_was"))
    written = documents.join(were, [*keys, "document_type"], "left").groupBy(keys[0]).agg(F.count_if("changed").alias("sections_changed"), F.count_if(F.col("_was") & ~F.col("is_active")).alias("sections_retired"))
    counts = moves.join(written, keys[0], "left").na.fill(0, ["sections_changed", "sections_retired"])
    return {"records": after, "documents": documents, "entities": entities, "counts": counts}


def apply_publications(stored: DataFrame, incoming: DataFrame, complete: DataFrame, payload: list[str], grace: int = 1, owner: str = "owner") -> DataFrame:
    """(owner, id, payload, aliases, providers, is_active, missed, matched): publications after a batch of each owner.

    stored: (owner, id, payload, aliases, providers, is_active, missed, created_at); incoming: (owner, id, payload,
    aliases, providers); complete: (owner, complete). An incoming publication that shares an alias with a stored one
    takes its place and keeps its id; aliases and providers are united. Several incoming ones that match the same stored
    one: the smallest id counts, the others add their aliases. Others are new. After a complete batch absent active ones
    have missed one more and are retired beyond `grace`; owners without a batch stay as they are.
    """
    matches = match_by_alias(incoming, stored, owner)
    found = incoming.alias("i").join(matches.alias("m"), (F.col("i.id") == F.col("m.incoming_id")) & (F.col(f"i.{owner}") == F.col(f"m.{owner}")), "left").select("i.*", F.coalesce("m.stored_id", "i.id").alias("_id"), F.col("m.stored_id").isNotNull().alias("matched"))
    fresh = found.groupBy(owner, F.col("_id").alias("id")).agg(
        F.min_by(F.struct(*payload), "id").alias("_p"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("aliases")))).alias("_aliases"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("providers")))).alias("_providers"), F.bool_or("matched").alias("matched"),
    ).withColumn("_in", F.lit(True))
    old = stored.select(owner, "id", F.struct(*payload).alias("_old"), F.col("aliases").alias("_a"), F.col("providers").alias("_b"), F.col("is_active").alias("_active"), F.col("missed").alias("_missed"))
    joined = old.join(fresh, [owner, "id"], "full_outer").join(complete.select(owner, "complete"), owner, "left")
    here = F.col("_in").isNotNull()
    absent = ~here & F.col("_active") & F.coalesce("complete", F.lit(False))
    missed = F.when(here, 0).when(absent, F.col("_missed") + 1).otherwise(F.col("_missed"))
    value = F.when(here, F.col("_p")).otherwise(F.col("_old"))
    return joined.select(
        owner, "id", *[value[c].alias(c) for c in payload], union_sorted(F.col("_a"), F.col("_aliases")).alias("aliases"), union_sorted(F.col("_b"), F.col("_providers")).alias("providers"),
        F.when(here, True).when(absent & (missed > grace), False).otherwise(F.col("_active")).alias("is_active"), missed.cast("int").alias("missed"), F.coalesce("matched", F.lit(False)).alias("matched"),
    )


def match_by_alias(incoming: DataFrame, stored: DataFrame, owner: str = "owner") -> DataFrame:
    """(owner, incoming_id, stored_id): for each incoming publication the stored one of its owner that shares an alias; of
    several an active one, then the oldest, then the smallest id. Both sides: (owner, id, aliases)."""
    a = incoming.select(owner, F.col("id").alias("incoming_id"), F.explode("aliases").alias("alias"))
    b = stored.select(owner, F.col("id").alias("stored_id"), "is_active", "created_at", F.explode("aliases").alias("alias"))
    best = F.min(F.struct((~F.col("is_active")).alias("x"), F.col("created_at").alias("y"), F.col("stored_id").alias("z")))
    return a.join(b, [owner, "alias"]).groupBy(owner, "incoming_id").agg(best["z"].alias("stored_id"))


def preferred(observations: DataFrame, entity: list[str], order: list[Column]) -> DataFrame:
    """The observation of each entity that comes first in `order`."""
    place = Window.partitionBy(*entity).orderBy(*order)
    return observations.withColumn("_place", F.row_number().over(place)).filter("_place = 1").drop("_place")


def affiliations_of(records: DataFrame, entity: str, newest: list[Column]) -> DataFrame:
    """(entity, school, department, is_primary): distinct affiliations by school and department without regard to case;
    blank schools are none; the first by name is the primary one."""
    flat = records.select(entity, *[c.alias(f"_o{n}") for n, c in enumerate(newest)], F.explode("affiliations").alias("a")).select(entity, F.col("a.school").alias("school"), F.col("a.department").alias("department"), *[f"_o{n}" for n in range(len(newest))])
    folded = flat.filter(F.coalesce(F.trim("school"), F.lit("")) != "").withColumn("_d", F.lower(F.coalesce("department", F.lit(""))))
    once = Window.partitionBy(entity, "school", "_d").orderBy(*[F.col(f"_o{n}").desc() for n in range(len(newest))], F.col("department").asc_nulls_last())
    kept = folded.withColumn("_n", F.row_number().over(once)).filter("_n = 1")
    place = Window.partitionBy(entity).orderBy("school", "_d")
    return kept.withColumn("is_primary", F.row_number().over(place) == 1).select(entity, "school", "department", "is_primary")


def merge_entities(documents: DataFrame, merges: DataFrame) -> DataFrame:
    """Documents after owners were merged: merges is (from_id, to_id), already resolved to final owners.

    Documents move with their ids. Where active ones of the new owner collide on type, external id and chunk, the one
    that the owner had before stays active, else the smallest id; the others are folded: inactive, `folded_into` names
    the one that stays, and `absorbed` of that one lists their ids in order.
    """
    moved = join_small(documents, merges.withColumnRenamed("from_id", "owner_id"), ["owner_id"], "left").withColumn("_own", F.col("to_id").isNull()).withColumn("owner_id", F.coalesce("to_id", "owner_id")).drop("to_id")
    group = Window.partitionBy("owner_id", "document_type", "external_id", "chunk_key", "is_active")
    first = F.first("document_id").over(group.orderBy(F.col("_own").desc(), "document_id"))
    folded = F.col("is_active") & (first != F.col("document_id"))
    marked = cut(moved.withColumn("folded_into", F.when(folded, first)).withColumn("is_active", F.col("is_active") & ~folded).drop("_own"))
    absorbed = marked.filter("folded_into is not null").groupBy(F.col("folded_into").alias("document_id")).agg(F.array_sort(F.collect_list("document_id")).alias("absorbed"))  # copies of one chunk
    return marked.join(absorbed, "document_id", "left").select(*documents.columns, "folded_into", F.coalesce("absorbed", F.array().cast(absorbed.schema["absorbed"].dataType)).alias("absorbed"))


def merge_links(links: DataFrame, merges: DataFrame) -> DataFrame:
    """Provider links (owner_id, provider, provider_id) after owners were merged: the owner's own link wins, else that of
    the smallest merged owner."""
    moved = join_small(links, merges.withColumnRenamed("from_id", "owner_id"), ["owner_id"], "left")
    place = Window.partitionBy("_to", "provider").orderBy(F.col("to_id").isNotNull(), "owner_id", "provider_id")
    kept = moved.withColumn("_to", F.coalesce("to_id", "owner_id")).withColumn("_n", F.row_number().over(place)).filter("_n = 1")
    return kept.select(F.col("_to").alias("owner_id"), "provider", "provider_id")


def merge_conflicts(links: DataFrame, merges: DataFrame) -> DataFrame:
    """(owner_id, provider): merges that would join two different ids of one provider, and so must not be carried out."""
    members = merges.select("from_id", "to_id").unionByName(merges.select(F.col("to_id").alias("from_id"), "to_id")).distinct()
    named = links.filter("provider_id is not null").join(members.withColumnRenamed("from_id", "owner_id"), "owner_id")
    return named.groupBy(F.col("to_id").alias("owner_id"), "provider").agg(F.count_distinct("provider_id").alias("n_ids")).filter("n_ids > 1").select("owner_id", "provider")


def merge_all(tables: dict[str, DataFrame], merges: DataFrame) -> dict[str, DataFrame]:
    """All tables after owners were merged: documents, records, affiliations, links, entities and redirects.

    merges: (from_id, to_id). An owner merged into itself, a cycle, or two different ids of one provider is an error.
    Records move; affiliations of merged owners move and go inactive; merged owners go inactive and leave a redirect.
    The entities that survive are to be rebuilt from their records (`rebuild_entities`).
    """
    if not merges.filter("from_id = to_id").isEmpty():
        raise ValueError("an owner cannot be merged into itself")
    ends = cut(resolve_redirects(merges))
    if not merge_conflicts(tables["links"], ends).isEmpty():
        raise ValueError("a merge would join different ids of one provider")
    by_owner = ends.withColumnRenamed("from_id", "owner_id")
    move = lambda df: join_small(df, by_owner, ["owner_id"], "left")
    return {
        "documents": merge_entities(tables["documents"], ends),
        "records": move(tables["records"]).withColumn("owner_id", F.coalesce("to_id", "owner_id")).drop("to_id").select(*tables["records"].columns),
        "affiliations": move(tables["affiliations"]).withColumn("is_active", F.col("is_active") & F.col("to_id").isNull()).withColumn("owner_id", F.coalesce("to_id", "owner_id")).drop("to_id").select(*tables["affiliations"].columns),
        "links": merge_links(tables["links"], ends),
        "entities": move(tables["entities"]).withColumn("is_active", F.col("is_active") & F.col("to_id").isNull()).drop("to_id").select(*tables["entities"].columns),
        "redirects": ends,
    }


def corpus_snapshot(runs: DataFrame, claimed: DataFrame) -> DataFrame:
    """(snapshot_id, run_id) of a corpus snapshot over exactly the claimed runs.

    runs: (run_id, status, membership_complete). Only runs with complete membership and status complete or partial may
    be claimed; any other claim, and an empty one, is an error. The id is a digest of the run ids in order.
    """
    wanted = claimed.select("run_id").distinct()
    valid = runs.filter("membership_complete and status in ('complete', 'partial')").select("run_id").distinct()
    known = cut(wanted.join(valid, "run_id", "left_semi"))
    if wanted.isEmpty() or not wanted.join(known, "run_id", "left_anti").isEmpty():
        raise ValueError("a claimed run is unknown, unfinished or incomplete")
    return join_small(known.withColumn("_one", F.lit(1)), digest(known.withColumn("_one", F.lit(1)), ["_one"], F.col("run_id"), F.col("run_id")).select("_one", F.col("digest").alias("snapshot_id")), ["_one"]).select("snapshot_id", "run_id")


def violations(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Key values that occur more than once among the rows of `where`: what a unique index would have refused."""
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*keys).count().filter("count > 1")


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, with `side`; empty if the two are equal as sets."""
    a, b = left.distinct(), right.distinct()
    cols = left.columns
    return a.join(b, cols, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, cols, "left_anti").withColumn("side", F.lit("right")))
