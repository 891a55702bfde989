"""Deterministic identifiers and hashes, all native expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.text import clean_text

#: Name space of our own document ids.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_DNS, "skein.example")


def uuid5(name: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """UUID version 5 of a name; null for null. The same value as Python's uuid.uuid5."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    dash = F.lit("-")
    return F.concat(
        F.substring(digest, 1, 8), dash, F.substring(digest, 9, 4), dash, F.lit("5"), F.substring(digest, 14, 3), dash,
        variant, F.substring(digest, 18, 3), dash, F.substring(digest, 21, 12),
    )


def document_id(owner: Column, kind: Column, external_id: Column, chunk_key: Column) -> Column:
    """UUID of a document; null parts count as empty but keep their place, so no two tuples share an id."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (owner, kind, external_id, chunk_key)]
    return uuid5(F.concat_ws("|", *parts))


def content_hash(title: Column, text: Column) -> Column:
    """SHA-256 of the cleaned title, a newline and the cleaned text; null counts as empty. Texts that differ only in white
    space or compatibility forms have one hash."""
    return F.sha2(F.concat(F.coalesce(clean_text(title), F.lit("")), F.lit("\n"), F.coalesce(clean_text(text), F.lit(""))), 256)


def record_hash(columns: list[str]) -> Column:
    """SHA-256 of a record as JSON, columns in alphabetical order."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
