"""All registered queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

from skein.plans import corpus, people, publications, search, snapshots, state

Query = Callable[[SparkSession, str], DataFrame]


def queries_of(module: ModuleType) -> dict[str, Query]:
    """The public functions that a module itself defines with the arguments (spark, d)."""
    return {k: f for k, f in vars(module).items() if callable(f) and not k.startswith("_") and getattr(f, "__module__", "") == module.__name__ and f.__code__.co_varnames[: f.__code__.co_argcount] == ("spark", "d")}


MODULES = [snapshots, state, corpus, people, publications, search]


def queries() -> dict[str, Query]:
    return {k: f for m in MODULES for k, f in queries_of(m).items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
