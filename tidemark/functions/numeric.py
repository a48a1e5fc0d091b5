"""Null-tolerant sums, buckets and distances."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles as used here, kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def safe_add(columns: Sequence[Column]) -> Column:
    """Sum with NULL counted as 0."""
    return reduce(add, [F.coalesce(c, F.lit(0)) for c in columns])


def width_bucket(value: Column, low: Column, high: Column, buckets: Column) -> Column:
    """Equal-width bucket 1..n; 0 below the range and n+1 from its upper end on."""
    return F.width_bucket(value.cast("double"), low.cast("double"), high.cast("double"), buckets.cast("bigint"))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    """Great-circle distance in miles or kilometres."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    miles = F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_MILES)
    return miles * KM_PER_MILE if unit == "km" else miles


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0 when the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0))
