"""Vectors of documents: encoding open inputs in batches, and putting the results over the stored ones."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.vectors import unit
from skein.operators.chunk import Sizes, fit, words
from skein.operators.report import missing_vectors
from skein.runtime import spread
from skein.sources.versions import Store

#: Texts that a model is given at once.
BATCH = 16


class Model(Protocol):
    """An encoder. Objects of it are sent to the executors, so weights should be loaded on first use."""

    version: str
    dimension: int
    most_tokens: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


class VectorStore(Protocol):
    """Where vectors are kept; `skein.sources.versions.Store` has this surface for a table of its own."""

    def read(self, table: str) -> DataFrame: ...

    def publish(self, tables: dict[str, DataFrame]) -> dict[str, int]: ...


def encode(inputs: DataFrame, model: Model, sizes: Sizes = words, batch: int = BATCH) -> DataFrame:
    """(document_id, embedding_version, embedding, document_hash, input_hash, is_shortened) of inputs (doc_id, text,
    content_hash).

    Texts are shortened to the model's limit and encoded `batch` at a time, in partitions spread over the cluster. A
    vector of another dimension, not finite or of length zero is an error. Null texts count as empty.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for rows in batches:
            for at in range(0, len(rows), batch):
                part = rows.iloc[at : at + batch]
                fitted = [fit(t or "", model.most_tokens, sizes) for t in part["text"]]
                found = np.asarray(model.encode([t for t, _ in fitted]), np.float64)
                norms = np.linalg.norm(found, axis=1) if found.ndim == 2 else np.zeros(1)
                if found.shape != (len(part), model.dimension) or not np.all(np.isfinite(norms) & (norms > 0)):
                    raise ValueError("the model gave a vector of a wrong shape or without a finite length")
                yield pd.DataFrame({
                    "document_id": part["doc_id"].to_numpy(), "embedding_version": model.version, "embedding": list((found / norms[:, None]).astype(np.float32)), "document_hash": part["content_hash"].to_numpy(),
                    "input_hash": [hashlib.sha256(t.encode()).hexdigest() for t, _ in fitted], "is_shortened": [s for _, s in fitted],
                })

    kind = dict(inputs.dtypes)["doc_id"]
    return spread(inputs.select("doc_id", "text", "content_hash")).mapInPandas(run, f"document_id {kind}, embedding_version string, embedding array<float>, document_hash string, input_hash string, is_shortened boolean")


def upsert_vectors(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored vectors with the incoming ones in their place, one per document and version, all of length one.

    Both sides: (document_id, embedding_version, embedding, input_hash, created_at, ...), all columns alike. Repeated
    rows: the latest counts, then the greater input_hash. A vector without a finite length above zero is an error. The
    flag is_shortened is kept with its vector, where there is one.
    """
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    keys = ["document_id", "embedding_version"]
    rest = [c for c in stored.columns if c not in keys]
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("_new", "created_at", "input_hash")).alias("x"))
    return best.select(*keys, *[unit(F.col("x.embedding")).alias(c) if c == "embedding" else F.col(f"x.{c}") for c in rest])


def activate(store: Store, version: str, snapshot_id: str, dimension: int) -> dict[str, int]:
    """Makes `version` the active one of a store with the tables documents, vectors and snapshots, by one manifest.

    Refused if any searchable document lacks a vector of its present content, or the corpus snapshot isn't known.
    """
    snapshots = store.read("snapshots").filter(F.col("snapshot_id") == snapshot_id)
    if snapshots.isEmpty():
        raise ValueError("the corpus snapshot is unknown")
    vectors = store.read("vectors").filter(F.col("embedding_version") == version)
    if vectors.isEmpty():
        raise ValueError("the version has no vectors")
    gaps = missing_vectors(store.read("documents"), vectors, dimension)
    active = snapshots.select("snapshot_id").distinct().select(F.lit(version).alias("embedding_version"), "snapshot_id")
    return store.publish({"active": active}, checks=(gaps,))
