"""Reports on the state of a corpus. Each is one aggregate over one scan or join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.canonical import squeeze
from skein.runtime import cut, join_small


def source_key(column: Column) -> Column:
    """Source names as they are compared: without white space at the edges and case."""
    return F.lower(squeeze(column))


def corpus_health(documents: DataFrame) -> DataFrame:
    """One row of conditional counts, in a single pass."""
    blank = F.coalesce(F.trim("text"), F.lit("")) == ""
    return documents.agg(
        F.count("*").alias("n_documents"),
        F.count_if("is_active").alias("n_active"),
        F.count_if(~F.col("is_active")).alias("n_inactive"),
        F.count_if(blank).alias("n_blank"),
        F.count_if(F.col("is_active") & ~blank).alias("n_searchable"),
        F.count_if(F.col("faculty_id").isNull()).alias("n_without_owner"),
        F.count_if(F.col("chunk_key") != "whole").alias("n_pieces"),
    )


def counts_by(rows: DataFrame, key: Column, name: str, more: dict[str, Column]) -> DataFrame:
    """Rows per key: all, active, inactive, and those for which each condition of `more` holds; rows: (is_active, ...)."""
    return rows.groupBy(key.alias(name)).agg(F.count("*").alias("n"), F.count_if("is_active").alias("n_active"), F.count_if(~F.col("is_active")).alias("n_inactive"), *[F.count_if(c).alias(k) for k, c in more.items()])


def owners_with_documents(owners: DataFrame, documents: DataFrame, owner: str) -> DataFrame:
    """One row: owners, those with active documents, and the difference."""
    having = documents.filter(F.col("is_active") & F.col(owner).isNotNull()).select(owner).distinct().withColumn("_has", F.lit(1))
    return owners.select(owner).distinct().join(having, owner, "left").agg(F.count("*").alias("n_owners"), F.count("_has").alias("n_with"), (F.count("*") - F.count("_has")).alias("n_without"))


def searchable(documents: DataFrame, owners: DataFrame | None = None, owner: str = "faculty_id") -> DataFrame:
    """Active documents with text; with owners (owner, is_active) only those of active owners."""
    found = documents.filter(F.col("is_active") & (F.coalesce(F.trim("text"), F.lit("")) != ""))
    return found if owners is None else found.join(owners.filter("is_active").select(owner).distinct(), owner, "left_semi")


def missing_vectors(documents: DataFrame, vectors: DataFrame, dimension: int, owners: DataFrame | None = None) -> DataFrame:
    """(doc_id, embedding_version, reason): searchable documents that lack a vector of a version, or whose vector was
    made from other content (stale) or is not usable. Versions are those that occur in vectors.

    documents: with content_hash; vectors: (document_id, embedding_version, embedding, document_hash, created_at), where
    document_hash is the content hash of what the vector was made from. Of several vectors the latest counts.
    """
    versions = cut(vectors.select("embedding_version").filter("embedding_version is not null").distinct())
    wanted = searchable(documents, owners).select("doc_id", F.col("content_hash").alias("_hash"))
    wanted = join_small(wanted.withColumn("_one", F.lit(1)), versions.withColumn("_one", F.lit(1)), ["_one"]).drop("_one")
    shaped = vectors.select(F.col("document_id").alias("doc_id"), "embedding_version", F.col("created_at").alias("_at"), (F.coalesce(F.size("embedding"), F.lit(-1)) == dimension).alias("_fit"), F.col("document_hash").alias("_made"))
    latest = shaped.groupBy("doc_id", "embedding_version").agg(F.max(F.struct("_at", "_fit", "_made")).alias("x"))
    joined = wanted.join(latest, ["doc_id", "embedding_version"], "left")
    reason = F.when(F.col("x").isNull(), "missing").when(~F.col("x._fit"), "unusable").when(~F.col("x._made").eqNullSafe(F.col("_hash")), "stale")
    return joined.select("doc_id", "embedding_version", reason.alias("reason")).filter("reason is not null")


def activation(documents: DataFrame, vectors: DataFrame, dimension: int) -> DataFrame:
    """(embedding_version, n_open, can_activate): a version is complete when no searchable document is open."""
    versions = vectors.select("embedding_version").filter("embedding_version is not null").distinct()
    open_ = missing_vectors(documents, vectors, dimension).groupBy("embedding_version").agg(F.count("*").alias("n_open"))
    return versions.join(open_, "embedding_version", "left").na.fill(0, ["n_open"]).withColumn("can_activate", F.col("n_open") == 0)


def coverage(owners: DataFrame, documents: DataFrame, owner: str, group: str) -> DataFrame:
    """(group, n_owners, n_covered, share) per group and overall (group '*'), by grouping sets."""
    having = documents.filter("is_active").select(owner).distinct().withColumn("_has", F.lit(1))
    joined = owners.join(having, owner, "left")
    return joined.rollup(group).agg(F.grouping(group).alias("_all"), F.count("*").alias("n_owners"), F.count("_has").alias("n_covered")).select(
        F.when(F.col("_all") == 1, "*").otherwise(F.coalesce(group, F.lit(""))).alias("group"), "n_owners", "n_covered", F.round(F.col("n_covered") / F.col("n_owners"), 6).alias("share"))


def digest(rows: DataFrame, group: list[str], order: Column, body: Column, digits: int = 3) -> DataFrame:
    """A SHA-256 over the ordered bodies of each group, in two levels: rows fall into 16**digits buckets by the hash of
    their order key, buckets are digested on their own, and the group's digest is that of its buckets' digests. So no
    task holds a whole group."""
    keyed = rows.select(*group, order.alias("_o"), F.sha2(body, 256).alias("_h")).withColumn("_b", F.substring(F.sha2("_o", 256), 1, digits))
    joined = lambda parts: F.sha2(F.array_join(F.transform(F.array_sort(parts), lambda x: x["h"]), ""), 256)
    buckets = keyed.groupBy(*group, "_b").agg(joined(F.collect_list(F.struct(F.col("_o").alias("o"), F.col("_h").alias("h")))).alias("_d"), F.count("*").alias("_n"))
    return buckets.groupBy(*group).agg(joined(F.collect_list(F.struct(F.col("_b").alias("o"), F.col("_d").alias("h")))).alias("digest"), F.sum("_n").alias("n_rows"))
