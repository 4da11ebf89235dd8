"""Arithmetic on array columns that stays in the JVM, with NaN handled as numpy does.

Spark sorts NaN above every number, so `x > limit` is true for NaN; every comparison here is false for it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once for each row, where it would else be computed at each use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def finite(x: Column) -> Column:
    """Whether a number is there, not NaN and not infinite; never null."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def above(x: Column, limit: Column) -> Column:
    """x > limit; false where either is NaN or null."""
    return F.coalesce(~F.isnan(x) & ~F.isnan(limit) & (x > limit), F.lit(False))


def only_finite(x: Column) -> Column:
    return F.when(finite(x), x)


def doubles(v: Column) -> Column:
    """Any vector or scalar-stored vector as ARRAY<DOUBLE>."""
    return v.cast("array<double>")


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def times(a: Column, k: float) -> Column:
    return F.transform(a, lambda x: x * F.lit(float(k)))


def absolute(a: Column) -> Column:
    return F.transform(a, F.abs)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def failed_places(flags: Column) -> Column:
    """0-based places of the true elements."""
    return F.filter(F.transform(flags, lambda f, i: F.when(f, i)), lambda i: i.isNotNull())


def any_of(flags: Column) -> Column:
    return F.coalesce(F.exists(flags, lambda f: f), F.lit(False))


def beyond(v: Column, low: Column, high: Column, exempt: Column | None = None) -> Column:
    """Flags of elements outside [low, high] or not finite; exempt places only count when not finite.

    A place without bounds is only checked for being finite.
    """
    def flag(x: Column, i: Column) -> Column:
        lo, hi = F.get(low, i), F.get(high, i)
        out = above(x, hi) | above(lo, x)
        if exempt is not None:
            out = out & ~F.coalesce(F.array_contains(exempt, i.cast("int")), F.lit(False))
        return out | ~finite(x)

    return F.transform(v, flag)


def masked(v: Column, valid: Column) -> Column:
    """The vector, or as many nulls where it is not valid."""
    return F.when(valid, v).otherwise(F.transform(v, lambda x: F.lit(None).cast("double")))


def pad(v: Column, n: int) -> Column:
    """The first n elements, filled up with zeros."""
    return F.slice(F.concat(v, F.array_repeat(F.lit(0.0), n)), 1, n)


def rint(x: Column) -> Column:
    """Half-even rounding, as Python's round."""
    return F.rint(x)


def mean_and_variance(groups: Sequence[tuple[Column, Column, Column]]) -> tuple[Column, Column, Column]:
    """Pool (count, mean, population variance) of parts; empty parts count nothing."""
    n = sum((F.when(c > 0, c).otherwise(0) for c, _, _ in groups), F.lit(0))
    mean = sum((F.when(c > 0, c * m).otherwise(0.0) for c, m, _ in groups), F.lit(0.0)) / F.nullif(n, F.lit(0))
    var = sum((F.when(c > 0, c * (v + (m - mean) * (m - mean))).otherwise(0.0) for c, m, v in groups), F.lit(0.0)) / F.nullif(n, F.lit(0))
    return n, mean, var
