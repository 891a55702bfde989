"""Measures of rankings against graded judgments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def measures(rankings: DataFrame, judgments: DataFrame, recall_at: tuple[int, ...] = (5, 10, 20), ndcg_at: tuple[int, ...] = (5, 10), relevant: int = 2, decimals: int = 6) -> DataFrame:
    """One row per judged query: recall_<k>, reciprocal_rank, ndcg_<k>, judged_<k> and n_relevant.

    rankings: (query_id, doc_id, rank); judgments: (query_id, doc_id, grade), grades 0 to 3, gain 2^grade - 1. A
    document is relevant from grade `relevant`. Queries without a relevant document have null measures; documents
    without judgment gain nothing and lower judged_<k>, the share of the first k that was judged.
    """
    ideal_place = Window.partitionBy("query_id").orderBy(F.col("grade").desc(), "doc_id")
    gain = (F.pow(F.lit(2.0), F.col("grade")) - 1)
    ideal = judgments.withColumn("_i", F.row_number().over(ideal_place)).groupBy("query_id").agg(
        F.count_if(F.col("grade") >= relevant).alias("n_relevant"),
        *[F.sum(F.when(F.col("_i") <= k, gain / F.log2(F.col("_i") + 1.0))).alias(f"_ideal_{k}") for k in ndcg_at],
    )
    found = rankings.select("query_id", "doc_id", "rank").join(judgments, ["query_id", "doc_id"], "left").groupBy("query_id").agg(
        *[F.count_if((F.col("grade") >= relevant) & (F.col("rank") <= k)).alias(f"_hit_{k}") for k in recall_at],
        F.min(F.when(F.col("grade") >= relevant, F.col("rank"))).alias("_first"),
        *[F.sum(F.when(F.col("rank") <= k, F.coalesce(gain, F.lit(0.0)) / F.log2(F.col("rank") + 1.0))).alias(f"_gain_{k}") for k in ndcg_at],
        *[F.avg(F.when(F.col("rank") <= k, F.col("grade").isNotNull().cast("double"))).alias(f"_judged_{k}") for k in recall_at],
    )
    some = F.col("n_relevant") > 0
    return ideal.join(found, "query_id", "left").select(
        "query_id", "n_relevant",
        *[F.when(some, F.round(F.coalesce(f"_hit_{k}", F.lit(0)) / F.col("n_relevant"), decimals)).alias(f"recall_{k}") for k in recall_at],
        F.when(some, F.round(F.coalesce(1 / F.col("_first"), F.lit(0.0)), decimals)).alias("reciprocal_rank"),
        *[F.when(some, F.round(F.coalesce(F.col(f"_gain_{k}"), F.lit(0.0)) / F.col(f"_ideal_{k}"), decimals)).alias(f"ndcg_{k}") for k in ndcg_at],
        *[F.round(F.coalesce(f"_judged_{k}", F.lit(0.0)), decimals).alias(f"judged_{k}") for k in recall_at],
    )


def macro(per_query: DataFrame, columns: list[str], decimals: int = 6) -> DataFrame:
    """(measure, mean, n_queries): means over the queries that have the measure."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in columns]))
    return per_query.select(pairs.alias("p")).select("p.*").groupBy("measure").agg(F.round(F.avg("v"), decimals).alias("mean"), F.count("v").alias("n_queries"))


def bootstrap(per_query: DataFrame, column: str, rounds: int = 200, decimals: int = 6) -> DataFrame:
    """(mean, low, high): the mean of a measure and the 2.5th and 97.5th of its percentiles over resamples of queries.

    Draws come from a linear congruence of round and place, so that every engine and run draws the same ones.
    """
    place = Window.orderBy("query_id")  # one row per judged query: the query set, not the corpus
    numbered = per_query.filter(F.col(column).isNotNull()).select((F.row_number().over(place) - 1).cast("long").alias("i"), F.col(column).cast("double").alias("v"))
    size = numbered.agg(F.count("*").alias("n"))
    draws = numbered.select("i").crossJoin(F.broadcast(size)).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    pick = F.pmod(((F.col("b").cast("long") * 7919 + F.col("i") * 104729 + 12345) * F.lit(48271).cast("long") % 2147483647).cast("long"), F.col("n"))
    means = draws.select("b", pick.alias("i")).join(numbered, "i").groupBy("b").agg(F.avg("v").alias("m"))
    order = means.withColumn("p", F.row_number().over(Window.orderBy("m")))  # `rounds` rows
    low, high = max(1, round(rounds * 0.025)), max(1, round(rounds * 0.975))
    limits = order.agg(F.max(F.when(F.col("p") == low, F.col("m"))).alias("low"), F.max(F.when(F.col("p") == high, F.col("m"))).alias("high"))
    return numbered.agg(F.round(F.avg("v"), decimals).alias("mean")).crossJoin(limits).select("mean", F.round("low", decimals).alias("low"), F.round("high", decimals).alias("high"))
