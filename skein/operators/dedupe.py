"""Publications: one representative per work, and the selection of recent ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.functions import records, urls
from skein.functions.text import name_key
from skein.operators.components import components


def with_aliases(papers: DataFrame, owner: str = "author_id") -> DataFrame:
    """Adds record (owner, provider and id as one string) and aliases; rows without an id and a title are left out."""
    known = papers.filter(F.col("external_id").isNotNull() & F.col("title").isNotNull())
    alias = urls.publication_aliases(F.col("source_name"), F.col("external_id"), F.col("doi"), F.col("title"), F.col("year").cast("int"))
    return known.withColumn("aliases", alias).withColumn("record", F.concat_ws("|", owner, "source_name", "external_id"))


def work_components(papers: DataFrame, owner: str = "author_id") -> DataFrame:
    """(record, component): records of one owner that share any alias, transitively."""
    pairs = with_aliases(papers, owner).select("record", F.explode("aliases").alias("alias"), owner)
    return components(pairs.select("record", F.concat_ws("|", owner, "alias").alias("alias")), "record", "alias")


def precedence() -> F.Column:
    """Order of records of one work: with DOI, with abstract, later date (or year), greater id."""
    has = lambda c: (F.coalesce(F.trim(c), F.lit("")) != "").cast("int")
    return F.struct(has("doi").alias("d"), has("abstract").alias("a"), F.coalesce(records.date_or_year(F.col("publication_date"), F.col("year"), ""), F.lit("")).alias("t"), F.col("record").alias("r"))


def representatives(papers: DataFrame, owner: str = "author_id") -> DataFrame:
    """One row per work: the fields of the record that takes precedence, the aliases and ids of all records of the work."""
    keyed = with_aliases(papers, owner).join(work_components(papers, owner), "record")
    kept = ["record", owner, "source_name", "external_id", "title", "abstract", "year", "publication_date", "doi"]
    return keyed.groupBy("component").agg(
        F.max_by(F.struct(*kept), precedence()).alias("best"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("aliases")))).alias("aliases"),
        F.collect_set(F.struct("source_name", "external_id")).alias("ids"),  # the records of one work
        F.count("*").alias("n_records"),
    ).select("best.*", "aliases", _ids_by_provider(F.col("ids")).alias("provider_ids"), "n_records")


def _ids_by_provider(pairs: F.Column) -> F.Column:
    """(source_name, external_id) pairs as a map from providers to their ids, both in order."""
    providers = F.array_sort(F.array_distinct(F.transform(pairs, lambda x: x["source_name"])))
    return F.map_from_arrays(providers, F.transform(providers, lambda p: F.array_sort(F.transform(F.filter(pairs, lambda x: x["source_name"] == p), lambda x: x["external_id"]))))


def select_recent(works: DataFrame, cutoff_year: int, years: int = 7, most: int = 15, owner: str = "author_id", least_title: int = 12) -> DataFrame:
    """Per owner up to `most` works of the last `years` years: those with an abstract first, newest first, then those
    with only a substantial title; ties go to the greater id. Adds tier and place."""
    dated = works.filter(F.col("year").between(cutoff_year - years + 1, cutoff_year))
    tier = F.when(F.coalesce(F.trim("abstract"), F.lit("")) != "", 1).when(F.length(name_key(F.col("title"))) >= least_title, 2)
    order = Window.partitionBy(owner).orderBy("tier", F.col("_date").desc(), F.concat_ws(":", "source_name", "external_id").desc())
    ranked = dated.withColumn("tier", tier).filter("tier is not null").withColumn("_date", records.date_or_year(F.col("publication_date"), F.col("year"))).withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= most).drop("_date")


def selection_counts(works: DataFrame, cutoff_year: int, years: int = 7, most: int = 15, owner: str = "author_id") -> DataFrame:
    """Per owner: works without year, outside the window, within it, and beyond the number kept (never below 0)."""
    inside = F.col("year").between(cutoff_year - years + 1, cutoff_year)
    return works.groupBy(owner).agg(
        F.count_if(F.col("year").isNull()).alias("without_year"),
        F.count_if(~inside).alias("outside"),
        F.count_if(inside).alias("inside"),
        F.greatest(F.lit(0), F.count_if(inside) - most).alias("beyond"),
    )


def merge_listings(rows: DataFrame, key: list[str], order: list[str], first: list[str], lists: list[str]) -> DataFrame:
    """One row per key: the first non-empty value of each `first` column in the given order, the distinct union of each
    list column in order of first occurrence, and the number of rows merged."""
    place = F.struct(*order)
    filled = {c: F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) != "", place) for c in first}
    merged = rows.groupBy(*key).agg(*[F.min_by(c, p).alias(c) for c, p in filled.items()], F.count("*").alias("n_rows"))
    for c in lists:
        # entries meet their key only once each, however many rows repeat them
        entries = rows.select(*key, place.alias("_o"), F.posexplode(c).alias("_p", "_v")).groupBy(*key, "_v").agg(F.min(F.struct("_o", "_p")).alias("_at"))
        union = entries.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_v"))), lambda x: x["_v"]).alias(c))
        merged = merged.join(union, key, "left").withColumn(c, F.coalesce(c, F.array().cast(rows.schema[c].dataType)))
    return merged.select(*key, *first, *lists, "n_rows")
