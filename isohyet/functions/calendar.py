"""Calendar expressions on zone-free timestamps."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from isohyet.constants import SEASONS


def ntz(text: str) -> Column:
    """A zone-free timestamp literal, which Parquet filters can use."""
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def as_ntz(col: Column) -> Column:
    return col.cast("timestamp_ntz")


def from_fields(year: Column, month: Column, day: Column, hour: Column | None = None) -> Column:
    """Timestamp from calendar fields; NULL for a date that cannot exist."""
    hour = F.lit(0) if hour is None else hour
    fields = [c.cast("int") for c in (year, month, day, hour)]
    return F.try_make_timestamp_ntz(*fields, F.lit(0), F.lit(0))


def parse_time(text: Column) -> Column:
    """Timestamp from text; NULL when it cannot be read."""
    return text.cast("string").try_cast("timestamp_ntz")


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1)).cast("timestamp_ntz")


def truncate_month(time: Column) -> Column:
    return month_start(F.year(time), F.month(time))


def season_of(month: Column) -> Column:
    names = list(SEASONS.items())
    expr = F.when(month.isin(*names[0][1]), F.lit(names[0][0]))
    for name, months in names[1:]:
        expr = expr.when(month.isin(*months), F.lit(name))
    return expr


def month_sin(month: Column) -> Column:
    return F.sin(F.lit(2 * math.pi) * month / F.lit(12))


def month_cos(month: Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * month / F.lit(12))
