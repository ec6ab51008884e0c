"""Numbers, dates and distances as plain column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0


def safe_int(c: Column) -> Column:
    """Whole number from dirty text, '3.00' too; NULL where it is none."""
    return c.try_cast("double").cast("int")


def positive(c: Column) -> Column:
    """NULL for zero and less: 0 stands for unknown."""
    return F.when(c > 0, c)


def parse_millis(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS"))


def round_half_up(c: Column, digits: int = 2) -> Column:
    """Rounding on the binary value, the same in every engine."""
    k = 10.0**digits
    return F.floor(c * k + 0.5) / k


def _capped(c: Column, cap: float) -> Column:
    """``least`` alone would take the cap for NULL."""
    return F.when(c.isNotNull(), F.least(c.cast("double"), F.lit(float(cap))))


def log_score(c: Column, cap: float) -> Column:
    """0 to 100: logarithm of the value, full at ``cap``; NULL for NULL."""
    return F.log1p(_capped(c, cap)) / math.log1p(cap) * 100


def linear_score(c: Column, cap: float) -> Column:
    """0 to 100 in proportion to the value, full at ``cap``; NULL for NULL."""
    return _capped(c, cap) / cap * 100


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on a sphere of radius 6,371,000 m; NULL if any coordinate is."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def local_time(c: Column, zone: str = "America/New_York") -> Column:
    """A UTC time as the wall clock of a zone shows it."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), c)


def local_day_start(day: Column, zone: str = "America/New_York") -> Column:
    """The UTC time at which a zone's day begins: windows of whole local days are half open between two of these."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), day.cast("timestamp_ntz"))


def age_days(as_of: Column, when: Column) -> Column:
    return F.datediff(F.to_date(as_of), F.to_date(when))


def available_mean(parts: list[tuple[Column, float]]) -> Column:
    """Mean weighted over the parts that are not NULL; NULL if none is."""
    top = sum((F.coalesce(c, F.lit(0.0)) * w for c, w in parts), F.lit(0.0))
    bottom = sum((F.when(c.isNotNull(), w).otherwise(0.0) for c, w in parts), F.lit(0.0))
    return F.when(bottom > 0, top / bottom)
