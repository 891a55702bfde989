"""Connected components and redirect chains, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.runtime import cut


def components(members: DataFrame, item: str = "item", key: str = "key", rounds: int = 64) -> DataFrame:
    """(item, component) of items that share a key, transitively; component is the smallest item of each.

    members: (item, key) pairs. Every round takes the smallest label per key and per item, then follows the labels one
    step (so that long chains shrink quickly), until nothing changes. Partial aggregation keeps hot keys small; no
    component is ever gathered. Raises if `rounds` don't suffice.
    """
    edges = cut(members.select(F.col(item).alias("_i"), F.col(key).alias("_k")).filter("_i is not null and _k is not null").distinct())
    labels = cut(edges.select("_i").distinct().withColumn("_l", F.col("_i")))
    state = None
    for _ in range(rounds):
        by_key = edges.join(labels, "_i").groupBy("_k").agg(F.min("_l").alias("_m"))
        lowered = edges.join(by_key, "_k").groupBy("_i").agg(F.min("_m").alias("_l"))
        jumps = lowered.select(F.col("_i").alias("_l"), F.col("_l").alias("_up"))
        labels = cut(lowered.join(jumps, "_l", "left").select("_i", F.least(F.col("_l"), F.coalesce("_up", "_l")).alias("_l")))
        now = labels.agg(F.sum(F.pmod(F.xxhash64("_i", "_l"), F.lit(2**40))).alias("h"), F.count_distinct("_l").alias("n")).first()
        if now == state:
            return labels.select(F.col("_i").alias(item), F.col("_l").alias("component"))
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def resolve_redirects(edges: DataFrame) -> DataFrame:
    """(from_id, to_id) with to_id the end of each chain of redirects; raises on a cycle.

    Every round doubles the distance, so chains end after at most the logarithm of the number of edges; whatever still
    moves then is a cycle. Of several edges from one id the one to the smallest id counts.
    """
    hops = cut(edges.filter("from_id is not null and to_id is not null").groupBy("from_id").agg(F.min("to_id").alias("to_id")))
    for _ in range(hops.count().bit_length() + 2):
        ahead = hops.select(F.col("from_id").alias("to_id"), F.col("to_id").alias("_next"))
        joined = hops.join(ahead, "to_id", "left")
        step = cut(joined.select("from_id", F.coalesce("_next", "to_id").alias("to_id"), F.col("_next").isNotNull().alias("_moved")))
        if not step.filter("from_id = to_id").isEmpty():
            raise ValueError("redirects form a cycle")
        if step.filter("_moved").isEmpty():
            return step.select("from_id", "to_id")
        hops = step.select("from_id", "to_id")
    raise ValueError("redirects form a cycle")
