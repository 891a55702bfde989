"""Dates, JSON fields, arrays and maps of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_year(cutoff: Column, years: int) -> Column:
    """First of the `years` calendar years that end with the cutoff's."""
    return F.year(cutoff) - years + 1


def date_or_year(date: Column, year: Column, pad: str = "-00-00") -> Column:
    """A date string for ordering: the date, else the year of four digits with padding; null without both."""
    return F.coalesce(F.nullif(F.trim(date), F.lit("")), F.when(year > 0, F.concat(F.lpad(year.cast("int").cast("string"), 4, "0"), F.lit(pad))))


def json_text(value: Column, field: str) -> Column:
    """A top-level field of a JSON object as text; null for bad JSON or a missing field."""
    return F.get_json_object(value, f"$.{field}")


def json_strings(value: Column) -> Column:
    """A JSON array as strings; anything else gives an empty array."""
    return F.coalesce(F.from_json(value, "array<string>"), F.array().cast("array<string>"))


def merged(left: Column, right: Column) -> Column:
    """Union of two maps; on equal keys the right one wins, nulls count as empty."""
    empty = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(left, empty), F.coalesce(right, empty)
    return F.map_concat(F.map_filter(a, lambda k, v: ~F.array_contains(F.map_keys(b), k)), b)


def union_sorted(left: Column, right: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(left, empty), F.coalesce(right, empty)))


def with_entry(column: Column, key: str, value: Column) -> Column:
    """A map of strings with one entry set, whatever it held before; null counts as empty."""
    rest = F.map_filter(F.coalesce(column, F.create_map().cast("map<string,string>")), lambda k, v: k != key)
    return F.map_concat(rest, F.create_map(F.lit(key), value.cast("string")))


def envelope(columns: list[str], source: Column, payload: Column) -> Column:
    """A record as one JSON text: its normalised columns under `record`, where it came from, and what was delivered."""
    return F.to_json(F.struct(F.struct(*sorted(columns)).alias("record"), source.alias("source"), payload.alias("payload")), {"ignoreNullFields": "false"})
