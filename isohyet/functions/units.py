"""Unit conversions and missing-value handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_MONTH = 30
SECONDS_PER_MONTH = 30 * 24 * 3600


def missing_to_null(value: Column) -> Column:
    """NaN becomes NULL. NaN sorts above every number and poisons means."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def kelvin_to_celsius(value: Column) -> Column:
    return value - F.lit(273.15)


def metres_to_mm(value: Column) -> Column:
    return value * F.lit(1000.0)


def per_day_to_per_month(value: Column, time: Column | None = None, exact_days: bool = False) -> Column:
    """mm/day to mm/month with 30-day months, or the month's own length."""
    if exact_days:
        if time is None:
            raise ValueError("exact_days needs the time column")
        return value * F.dayofmonth(F.last_day(time))
    return value * F.lit(DAYS_PER_MONTH)


def flux_to_per_month(value: Column) -> Column:
    """kg m-2 s-1 to mm per 30-day month."""
    return value * F.lit(SECONDS_PER_MONTH)


def clip_nonneg(value: Column) -> Column:
    """Negative values become 0, a missing value stays missing."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))
