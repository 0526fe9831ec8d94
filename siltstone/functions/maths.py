"""NULL-safe arithmetic, buckets, logs and distances on the sphere."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import as_col

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def _zero_filled(cols: Sequence[Column | str]) -> list[Column]:
    if isinstance(cols, (str, Column)) or not cols:
        raise TypeError("pass a non-empty list of columns")
    return [F.coalesce(as_col(c), F.lit(0)) for c in cols]


def safe_add(cols: Sequence[Column | str]) -> Column:
    """Sum of the columns, NULL counted as 0."""
    return reduce(lambda a, b: a + b, _zero_filled(cols))


def safe_subtract(cols: Sequence[Column | str]) -> Column:
    """First column minus the others, NULL counted as 0."""
    return reduce(lambda a, b: a - b, _zero_filled(cols))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, NULL when the denominator is 0 or NULL."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def width_bucket(c: Column | str, low, high, buckets: int) -> Column:
    """Equi-width bucket 1..n, 0 below the range and n + 1 above it."""
    return F.width_bucket(as_col(c), F.lit(low), F.lit(high), F.lit(buckets))


def log_natural(c: Column | str) -> Column:
    """Natural logarithm; NULL for 0 and NULL."""
    return F.ln(F.nullif(as_col(c), F.lit(0)))


def uniform(seed: int | None = None) -> Column:
    """Uniform random number in [0, 1); give a seed when runs must repeat."""
    return F.rand(seed)


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    lat1, lon1, lat2, lon2 = (F.radians(as_col(c)) for c in (lat1, lon1, lat2, lon2))

    def half_chord(a: Column, b: Column) -> Column:
        return F.pow(F.sin((b - a) / 2), F.lit(2))

    inner = half_chord(lat1, lat2) + F.cos(lat1) * F.cos(lat2) * half_chord(lon1, lon2)
    miles = F.asin(F.sqrt(inner)) * (2 * EARTH_RADIUS_MILES)
    return miles * F.lit(KM_PER_MILE) if unit == "km" else miles
