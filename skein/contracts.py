"""What sources and stores have to offer, and the schemas that stored tables are brought to."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.sources.versions import Store


class PeopleSource(Protocol):
    """Delivers one snapshot of persons: (records, complete), records with source_name, snapshot_id and a key."""

    name: str

    def snapshot(self) -> tuple[DataFrame, bool]: ...


class PublicationSource(Protocol):
    """Finds author profiles of persons, and publications of profiles, as frames with a column `complete`."""

    name: str

    def authors(self, persons: DataFrame) -> DataFrame: ...

    def publications(self, profiles: DataFrame, start_year: int, most: int) -> DataFrame: ...


class CorpusRepository(Protocol):
    """Where the tables of a corpus are kept; `skein.sources.versions.Store` is one."""

    def read(self, table: str) -> DataFrame: ...

    def publish(self, tables: dict[str, DataFrame], checks: tuple[DataFrame, ...] = ()) -> dict[str, int]: ...


@dataclass(frozen=True)
class LabEvidence:
    """Text about a person's laboratory that came from elsewhere; it gives a document of its own."""

    owner_id: str
    url: str
    text: str


#: Stored tables with their columns, in the order in which they are kept.
SCHEMAS = {
    "records": "source_name string, key string, owner_id string, name string, title string, research_summary string, is_active boolean, missed int, last_seen timestamp, updated_at timestamp",
    "documents": "document_id string, owner_id string, document_type string, external_id string, chunk_key string, title string, text string, content_hash string, is_active boolean, updated_at timestamp",
    "vectors": "document_id string, embedding_version string, embedding array<float>, document_hash string, input_hash string, is_shortened boolean, created_at timestamp",
    "redirects": "from_id string, to_id string",
}


def conform(df: DataFrame, schema: str) -> DataFrame:
    """df with exactly the columns of a schema: missing ones are null, others cast, further ones an error."""
    wanted = df.sparkSession.createDataFrame([], schema).schema
    further = [c for c in df.columns if c not in wanted.names]
    if further:
        raise ValueError(f"columns that the schema doesn't have: {', '.join(further)}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted.fields])


def migrate(store: Store, schemas: dict[str, str] | None = None) -> list[str]:
    """Brings every stored table to its schema, all in one publication; returns the names of those that changed. A
    second run changes nothing."""
    stored, changed = store.manifest(), {}
    for name, schema in (SCHEMAS if schemas is None else schemas).items():
        if name in stored:
            before = store.read(name)
            after = conform(before, schema)
            if before.dtypes != after.dtypes:
                changed[name] = after
    if changed:
        store.publish(changed)
    return sorted(changed)
