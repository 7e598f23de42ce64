"""Scalar rules of the fleet model."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadbook import settings as S
from roadbook.functions.exact import wide


def inside_box(lat: str = "lat", lon: str = "lon",
               lat_range: tuple[float, float] = (S.LAT_MIN, S.LAT_MAX),
               lon_range: tuple[float, float] = (S.LON_MIN, S.LON_MAX)) -> Column:
    """Inclusive bounding box; a NULL coordinate is outside."""
    return F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range)


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance between two points given in degrees."""
    half_lat = F.sin(F.radians((lat2 - lat1) / F.lit(2.0)))
    half_lon = F.sin(F.radians((lon2 - lon1) / F.lit(2.0)))
    chord = (half_lat * half_lat
             + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon)
    return F.lit(2 * S.EARTH_RADIUS_MILES) * F.asin(F.sqrt(chord))


def elapsed_seconds(earlier: Column, later: Column) -> Column:
    """Second boundaries crossed between two zone-less timestamps."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def idle_flag(speed: Column) -> Column:
    """1 below the idle threshold, else 0; an unknown speed counts as moving."""
    return F.when(speed < S.IDLE_BELOW_MPH, 1).otherwise(0)


def days_since(day: Column, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), day)


def urgency(days: Column) -> Column:
    """Maintenance urgency by days since the last service; never serviced is low."""
    return (F.when(days > S.URGENCY_HIGH_AFTER_DAYS, "high")
            .when(days > S.URGENCY_MEDIUM_AFTER_DAYS, "medium")
            .otherwise("low"))


def _score(numerator: Column, denominator: Column) -> Column:
    """A quotient in hundredths, clipped to 0..100. Callers keep NULLs out:
    ``greatest`` and ``least`` would skip one and return a bound."""
    hundredths = F.call_function("div", numerator * 2 + denominator, denominator * 2)
    return F.least(F.greatest(hundredths, F.lit(0)), F.lit(10_000)) / F.lit(100.0)


def efficiency_score(speed_units: Column, speed_count: Column,
                     idle_count: Column, ping_count: Column) -> Column:
    """100 - 0.5 * idle % - 0.3 * max(0, 35 - average speed), clipped to 0..100.

    Takes the totals of the group, not its averages, and divides once:
    ``speed_units`` is the speed sum in 1/10000 mph. Without any speed: NULL.
    """
    s, m, k, n = wide(speed_units), wide(speed_count), wide(idle_count), wide(ping_count)
    shortfall = F.greatest(m * 350_000 - s, F.lit(0))
    # the formula in hundredths, times n * m * 1000
    score = (n * 10_000_000 - k * 5_000_000) * m - n * shortfall * 3
    return F.when(speed_count > 0, _score(score, n * m * 1_000))


def safety_score(speed_cents: Column, speed_days: Column,
                 idle_cents: Column, idle_days: Column) -> Column:
    """70 + 20 * min(average speed, 45) / 45 - 0.3 * average idle %, clipped to 0..100.

    Takes the sums of the daily values in hundredths and their day counts.
    """
    s, a, i, b = wide(speed_cents), wide(speed_days), wide(idle_cents), wide(idle_days)
    capped = F.least(s, a * 4_500)
    # the formula in hundredths, times a * b * 90
    score = (a * 630_000 + capped * 40) * b - a * i * 27
    return F.when((speed_days > 0) & (idle_days > 0), _score(score, a * b * 90))
