"""Vector functions on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision; null if the lengths differ or either is null."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.when(F.size(a) == F.size(b), F.aggregate(products, F.lit(0.0), lambda s, x: s + x))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def usable(a: Column, dimension: int) -> Column:
    """Whether a vector has the dimension, finite entries and a length above zero."""
    finite = ~F.exists(a, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(a) == dimension) & finite & (norm(a) > 0), F.lit(False))


def unit(a: Column) -> Column:
    """The vector with length one; an error for zero or non-finite vectors."""
    n = norm(a)
    ok = (n > 0) & (n < float("inf")) & ~F.isnan(n)
    # the length is handed over as an array, since within a lambda it would be computed anew for every entry
    return F.when(ok, F.zip_with(a, F.array_repeat(n, F.size(a)), lambda x, y: x.cast("double") / y)).otherwise(F.raise_error(F.lit("vector without a finite length above zero")))
