"""Matching records by address or name, and scoring candidate profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.text import name_key, name_score, same_but_for_initial, terms
from skein.functions.urls import match_key

#: Weights of the signals of a candidate, and the thresholds of the decision.
WEIGHTS = {"name": 0.30, "affiliation": 0.25, "title": 0.25, "topic": 0.15, "direct": 0.05}
RESOLVED, MARGIN, AMBIGUOUS = 0.80, 0.15, 0.60


def unique_url_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_url: str, right_url: str) -> DataFrame:
    """(left_id, right_id) of rows with one canonical address, where exactly one right id has it."""
    a = left.select(left_id, match_key(F.col(left_url)).alias("_u")).filter("_u is not null").distinct()
    b = right.select(right_id, match_key(F.col(right_url)).alias("_u")).filter("_u is not null").groupBy("_u").agg(F.min(right_id).alias(right_id), F.count_distinct(right_id).alias("_n")).filter("_n = 1")
    return a.join(b, "_u").select(left_id, right_id)


def reconcile(listing: DataFrame, feed: DataFrame) -> DataFrame:
    """Every listing row with its feed row, and every feed row that no listing row took.

    listing: (listing_id, url, name); feed: (feed_id, url, name). Rows with an address match by that alone; the others
    by name key, or else by first and last name with an omitted initial, and only if exactly one feed row remains.
    Returns (listing_id, feed_id, how): how is url, name, initial, unmatched (no feed_id), left_over (no listing_id), or
    repeated (a feed row that several listing rows took, in addition to their own rows).
    """
    a = listing.select("listing_id", match_key(F.col("url")).alias("u"), name_key(F.col("name")).alias("k")).distinct()
    b = feed.select("feed_id", match_key(F.col("url")).alias("u"), name_key(F.col("name")).alias("k")).distinct()
    by_url = a.filter("u is not null").join(b.filter("u is not null").groupBy("u").agg(F.min("feed_id").alias("feed_id")), "u").select("listing_id", "feed_id", F.lit("url").alias("how"))
    open_ = a.filter("u is null and k <> ''")
    same = open_.join(b.select("feed_id", "k"), "k").groupBy("listing_id").agg(F.min("feed_id").alias("feed_id"), F.count_distinct("feed_id").alias("n"))
    by_name = same.filter("n = 1").select("listing_id", "feed_id", F.lit("name").alias("how"))
    rest = open_.join(same, "listing_id", "left_anti")
    ends = lambda d: d.withColumn("w", F.split("k", " ")).withColumn("f", F.element_at("w", 1)).withColumn("l", F.element_at("w", -1)).drop("w")
    near = ends(rest).select("listing_id", F.col("k").alias("k1"), "f", "l").join(ends(b.filter("k <> ''")).select("feed_id", F.col("k").alias("k2"), "f", "l"), ["f", "l"]).filter(same_but_for_initial(F.col("k1"), F.col("k2")))
    by_initial = near.groupBy("listing_id").agg(F.min("feed_id").alias("feed_id"), F.count_distinct("feed_id").alias("n")).filter("n = 1").select("listing_id", "feed_id", F.lit("initial").alias("how"))
    found = by_url.unionByName(by_name).unionByName(by_initial)
    none = a.select("listing_id").distinct().join(found, "listing_id", "left_anti").select("listing_id", F.lit(None).cast(dict(b.dtypes)["feed_id"]).alias("feed_id"), F.lit("unmatched").alias("how"))
    over = b.select("feed_id").distinct().join(found, "feed_id", "left_anti").select(F.lit(None).cast(dict(a.dtypes)["listing_id"]).alias("listing_id"), "feed_id", F.lit("left_over").alias("how"))
    twice = found.groupBy("feed_id").agg(F.count_distinct("listing_id").alias("n")).filter("n > 1").select(F.lit(None).cast(dict(a.dtypes)["listing_id"]).alias("listing_id"), "feed_id", F.lit("repeated").alias("how"))
    return found.unionByName(none).unionByName(over).unionByName(twice)


def completeness(reconciled: DataFrame) -> DataFrame:
    """(complete, n_matched, n_unmatched, n_left_over, n_repeated) of a reconciliation: complete if all rows of both
    sides found each other once."""
    kinds = {"n_unmatched": "unmatched", "n_left_over": "left_over", "n_repeated": "repeated"}
    counted = reconciled.agg(F.count_if(F.col("how").isin("url", "name", "initial")).alias("n_matched"), *[F.count_if(F.col("how") == v).alias(k) for k, v in kinds.items()])
    return counted.select(((F.col("n_unmatched") + F.col("n_left_over") + F.col("n_repeated")) == 0).alias("complete"), "*")


def score_candidates(pairs: DataFrame, home: list[str]) -> DataFrame:
    """Adds the signals and the score of each candidate.

    pairs: (person_id, candidate_id, name, candidate_name, affiliations, candidate_affiliations, titles,
    candidate_titles, research_text, topics, direct). `home` lists parts of affiliations that count as agreement. A
    candidate with other affiliations only and no title, topic or direct sign is contradicted and scores 0.
    """
    a, b = name_key(F.col("name")), name_key(F.col("candidate_name"))
    joined = F.lower(F.concat_ws(" ", F.coalesce("candidate_affiliations", F.array().cast("array<string>"))))
    at_home = F.lit(False)
    for part in home:
        at_home = at_home | joined.contains(part.lower())
    keys = lambda c: F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda t: F.lower(F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " ")))), lambda t: t != "")
    own = terms(F.concat_ws(" ", "research_text", F.concat_ws(" ", "affiliations")))
    theirs = terms(F.concat_ws(" ", F.concat_ws(" ", "topics"), F.concat_ws(" ", "candidate_titles")))
    common = F.size(F.array_intersect(own, theirs))
    title = F.arrays_overlap(keys("titles"), keys("candidate_titles"))
    topic = F.round(F.least(F.lit(WEIGHTS["topic"]), WEIGHTS["topic"] * common / F.greatest(F.lit(1), F.least(F.lit(8), F.size(own)))), 6)
    signals = (
        pairs.withColumn("name_points", name_score(a, b, WEIGHTS["name"]))
        .withColumn("affiliation_points", F.when(at_home, WEIGHTS["affiliation"]).otherwise(0.0))
        .withColumn("title_points", F.when(F.coalesce(title, F.lit(False)), WEIGHTS["title"]).otherwise(0.0))
        .withColumn("topic_points", topic)
        .withColumn("direct_points", F.when(F.coalesce("direct", F.lit(False)), WEIGHTS["direct"]).otherwise(0.0))
    )
    elsewhere = (F.size(F.coalesce("candidate_affiliations", F.array().cast("array<string>"))) > 0) & ~at_home
    contradicted = elsewhere & (F.col("title_points") == 0) & (F.col("topic_points") == 0) & (F.col("direct_points") == 0)
    total = F.col("name_points") + F.col("affiliation_points") + F.col("title_points") + F.col("topic_points") + F.col("direct_points")
    return signals.withColumn("contradicted", contradicted).withColumn("score", F.when((F.col("name_points") == 0) | contradicted, 0.0).otherwise(F.round(total, 6)))


def best_with_margin(scored: DataFrame, entity: str, candidate: str, score: str = "score") -> DataFrame:
    """The best candidate of each entity with its lead over the second (its own score if there is none)."""
    order = Window.partitionBy(entity).orderBy(F.col(score).desc(), F.col(candidate).asc())
    ranked = scored.withColumn("second", F.coalesce(F.lead(score).over(order), F.lit(0.0))).withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    return ranked.drop("_n").withColumn("margin", F.round(F.col(score) - F.col("second"), 6))


def decide(best: DataFrame) -> DataFrame:
    """Adds decision: match, unclear or none, by score, margin and at least one sign besides name and topic."""
    strong = (F.col("affiliation_points") > 0) | (F.col("title_points") > 0) | (F.col("direct_points") > 0)
    sure = (F.col("score") >= RESOLVED) & (F.col("margin") >= MARGIN) & strong & ~F.col("contradicted")
    return best.withColumn("decision", F.when(sure, "match").when(F.col("score") >= AMBIGUOUS, "unclear").otherwise("none"))


def validate_links(links: DataFrame, delivered: Column, compatible: Column) -> DataFrame:
    """Adds outcome to stored links: kept, unclear if the profile was delivered under another name, lost if it wasn't."""
    return links.withColumn("outcome", F.when(~delivered, "lost").when(F.coalesce(compatible, F.lit(False)), "kept").otherwise("unclear"))


def several_ids(links: DataFrame, entity: list[str], identifier: str) -> DataFrame:
    """Entities that carry more than one distinct identifier."""
    return links.filter(F.col(identifier).isNotNull()).groupBy(*entity).agg(F.count_distinct(identifier).alias("n_ids")).filter("n_ids > 1")


def coalesce_left(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of right, and those of left whose keys right lacks: right wins."""
    return right.unionByName(left.join(right.select(*keys), keys, "left_anti"))


def not_in(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Rows whose key is missing on the right, as an anti join (a null on the right hides nothing)."""
    return left.join(right.select(on), on, "left_anti")


def any_of(column: Column, values: list) -> Column:
    return column.isin(values)
