"""Column helpers: the engine's scalar function library.

Every helper maps Columns to a Column built from Spark built-ins, so each one stays inside
whole-stage code generation. None of them is a Python UDF.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must agree with the reference for equal results.
EARTH_RADIUS_KM = 6371.0
SECONDS_PER_DAY = 86400.0
SECONDS_PER_HOUR = 3600.0
SURROGATE_KEY_SEPARATOR = "|"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def seconds_between(start, end) -> Column:
    """Whole-second difference ``end - start``; fractions of a second are dropped per side."""
    return F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))


def days_between(start, end) -> Column:
    """Fractional days between two timestamps (NULL if either is NULL)."""
    return seconds_between(start, end) / F.lit(SECONDS_PER_DAY)


def hours_between(start, end) -> Column:
    return seconds_between(start, end) / F.lit(SECONDS_PER_HOUR)


def to_date(ts) -> Column:
    return F.to_date(_c(ts))


def week_start(d) -> Column:
    """Monday of the ISO week, as a DATE."""
    return F.trunc(_c(d), "week")


def month_start(d) -> Column:
    return F.trunc(_c(d), "month")


def safe_divide(numerator, denominator) -> Column:
    """NULL when the denominator is 0 or NULL (never raises under ANSI mode)."""
    return F.try_divide(_c(numerator), _c(denominator))


def iso_day_of_week(d) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(_c(d)) + F.lit(1)


def bool_to_int(cond) -> Column:
    """1 when the condition holds, 0 when it is false or NULL."""
    return F.when(_c(cond), F.lit(1)).otherwise(F.lit(0))


def surrogate_key(*cols) -> Column:
    """md5 of the string forms joined by a vertical bar, NULL parts as ''."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_KEY_SEPARATOR, *parts))


def _rad(x: Column) -> Column:
    # written as x*pi/180 (not radians()) so the rounding matches SQL engines bit for bit
    return x * F.lit(math.pi) / F.lit(180.0)


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance (spherical law of cosines, argument clamped to [-1, 1])."""
    lat1, lng1, lat2, lng2 = map(_c, (lat1, lng1, lat2, lng2))
    cosine = (F.cos(_rad(lat1)) * F.cos(_rad(lat2)) * F.cos(_rad(lng2 - lng1))
              + F.sin(_rad(lat1)) * F.sin(_rad(lat2)))
    return F.lit(EARTH_RADIUS_KM) * F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))


def quantise(x, digits: int = 6, guard: int = 3) -> Column:
    """Round half up on a 10^-digits grid with floor(), identical in every SQL engine.

    Used only where a result is compared across engines; ``round`` on doubles is not used
    because engines disagree on how to round the binary value. The value is first snapped to
    a grid ``guard`` digits finer, so two engines whose sums differ only in the last bits (a
    different summation order) agree on which side of a half-way point, such as 14.0196875,
    the value falls.
    """
    fine, step = float(10 ** (digits + guard)), float(10 ** guard)
    snapped = F.floor(_c(x) * F.lit(fine) + F.lit(0.5))
    return (F.floor(snapped / F.lit(step) + F.lit(0.5)) / F.lit(float(10 ** digits))).cast("double")


def exact_sum(x) -> Column:
    """Order-independent money total.

    Double sums depend on the order rows arrive in, so the same query on another
    partitioning can differ in the last bits. Amounts are summed as DECIMAL(28,10) (exact),
    settled to 6 decimals and returned as double: identical on every run and engine.
    """
    return F.sum(_c(x).cast("decimal(28,10)")).cast("decimal(38,6)").cast("double")


def in_interval(value, lo, hi) -> Column:
    """Tri-state interval membership: NULL when the value is NULL, else lo <= value <= hi."""
    value = _c(value)
    return F.when(value.isNotNull(), value.between(_c(lo), _c(hi)))
