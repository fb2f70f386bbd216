"""Numeric repair, scores, bins and encodings."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088


def null_outside(col: Column, low: object, high: object) -> Column:
    return F.when(col.between(low, high), col)


def null_unless_in(col: Column, allowed: Sequence[object]) -> Column:
    return F.when(col.isin(*allowed), col)


def not_finite(col: Column) -> Column:
    """True for NaN and both infinities; null stays false."""
    return F.coalesce(F.isnan(col) | (F.abs(col) == F.lit(float("inf"))), F.lit(False))


def finite_or(col: Column, value: float = 0.0) -> Column:
    return F.when(not_finite(col), F.lit(value)).otherwise(col)


def weighted_score(weights: Mapping[str, float], default: float = 0.0) -> Column:
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(default)) * F.lit(weight)
    return total


def cyclic(col: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value that repeats every ``period`` units."""
    angle = col * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def bin_floor(col: Column, width: float) -> Column:
    """Lower edge of the equal-width bin."""
    return F.floor(col / F.lit(width)) * F.lit(width)


def decimal_bin(col: Column, width: str) -> Column:
    """Lower edge of the bin as an exact decimal(4,2)."""
    return (F.floor(col / F.lit(float(width))) * F.lit(width).cast("decimal(4,2)")).cast("decimal(4,2)")


def ladder(steps: Sequence[tuple[Column, object]], default: object) -> Column:
    """First true condition wins."""
    out = None
    for condition, value in steps:
        out = F.when(condition, F.lit(value)) if out is None else out.when(condition, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def ratio(num: Column, den: Column) -> Column:
    """Division that gives null instead of an error when the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def correlation(a: Column, b: Column) -> Column:
    """Pearson r over rows where both are present; null when either is constant.

    The built-in ``corr`` stops the query with a division by zero in that case.
    """
    a, b = a.cast("double"), b.cast("double")
    both = a.isNotNull() & b.isNotNull()
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km; inputs in degrees."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), F.lit(2)) + F.cos(a) * F.cos(b) * F.pow(
        F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(h), F.sqrt(F.greatest(F.lit(1.0) - h, F.lit(0.0))))
