"""Null-tolerant arithmetic, buckets and distances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltworks.config import EARTH_RADIUS_MILES, KM_PER_MILE


def safe_add(*cols: Column) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])


def safe_subtract(*cols: Column) -> Column:
    return reduce(lambda a, b: a - b, [F.coalesce(c, F.lit(0)) for c in cols])


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def width_bucket(c: Column, low: Column, high: Column, buckets: int) -> Column:
    """1..n for equal bins of [low, high), 0 below, n + 1 from high on."""
    return F.width_bucket(c.cast("double"), low.cast("double"), high.cast("double"), F.lit(buckets)).cast("int")


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    """Great-circle distance in miles or kilometres."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit is 'mi' or 'km', not {unit!r}")
    half_lat = F.sin(F.radians((lat2 - lat1) / 2))
    half_lon = F.sin(F.radians((lon2 - lon1) / 2))
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    miles = F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_MILES)
    return miles if unit == "mi" else miles * KM_PER_MILE


def ln_safe(c: Column) -> Column:
    """Natural log; zero gives null."""
    return F.log(F.nullif(c, F.lit(0)))


def greatest_or(low, *cols: Column) -> Column:
    """Greatest value, nulls counting as ``low``."""
    return F.greatest(*[F.coalesce(c, F.lit(low)) for c in cols])


def random_number(seed: int, *keys: Column) -> Column:
    """Number from 0 to below 1, drawn by the seed and the row's key: the same in every run and after a retry."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(2**53)) / F.lit(float(2**53))
