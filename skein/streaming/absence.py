"""Absence counting over a stream of snapshots (an extension: batches can also be applied one by one, see
skein.operators.state)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skein.operators.state import apply_batch
from skein.sources.versions import Store


def follow(snapshots: DataFrame, store: Store, keys: list[str], payload: list[str], checkpoint: str, start: Callable[[], DataFrame], misses: int = 2) -> StreamingQuery:
    """Applies each micro-batch of a stream of snapshot rows to the table `state` of a store.

    snapshots is a streaming frame with the keys, the payload, snapshot_id, fetched_at and complete. Snapshots of one
    micro-batch are applied in the order of fetched_at. A micro-batch that is repeated after a failure finds its id in
    the manifest and changes nothing. `start` gives the empty state.
    """

    def apply(batch: DataFrame, number: int) -> None:
        manifest = store.manifest()
        if manifest.get("batch", -1) >= number:
            return
        state = store.read("state") if "state" in manifest else start()
        batch = batch.persist()
        order = [r for r in batch.groupBy("snapshot_id").agg(F.min("fetched_at").alias("t"), F.min("complete").alias("c")).orderBy("t", "snapshot_id").toLocalIterator()]  # snapshots, not records
        for r in order:
            rows = batch.filter(F.col("snapshot_id") == r["snapshot_id"]).dropDuplicates(keys)
            state = apply_batch(state, rows, keys, payload, bool(r["c"]), F.lit(r["t"]), misses)
        store.publish({"state": state}, marks={"batch": number})
        batch.unpersist()

    return snapshots.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
