"""Clips, selections, calendars and monthly resampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.constants import ALL_YEARS, HISTORICAL, SEASONS
from isohyet.functions.calendar import from_fields, month_start, ntz, parse_time
from isohyet.functions.coords import aggregate_cells


def in_years(start: int, end: int, time: str = "time") -> Column:
    """Whether a time lies in whole years, both included."""
    return _years(time, start, end)


def _years(time: str, start: int, end: int) -> Column:
    # Half-open, so the whole last day is inside and Parquet can use it.
    return (F.col(time) >= ntz(f"{start:04d}-01-01")) & (F.col(time) < ntz(f"{end + 1:04d}-01-01"))


def clip_years(df: DataFrame, start: int = ALL_YEARS[0], end: int = ALL_YEARS[1],
               time: str = "time") -> DataFrame:
    """Rows of whole years, both ends included."""
    return df.filter(_years(time, start, end))


def conditional_clip(df: DataFrame, start: int = ALL_YEARS[0], end: int = ALL_YEARS[1],
                     time: str = "time", scenario: str = "scenario") -> DataFrame:
    """Clip historical rows only; scenario rows pass."""
    return df.filter((F.col(scenario) != HISTORICAL) | _years(time, start, end))


def period_select(df: DataFrame, years: tuple[int, int], year: str = "year") -> DataFrame:
    """Whole years by the year column, which also prunes partitions."""
    return df.filter(F.col(year).between(*years))


def season_select(df: DataFrame, season: str, month: str = "month") -> DataFrame:
    if season not in SEASONS:
        raise ValueError(f"unknown season: {season}")
    return df.filter(F.col(month).isin(*SEASONS[season]))


def decode_calendar(df: DataFrame, year: str = "y", month: str = "m", day: str = "d",
                    hour: str | None = None, time: str = "time") -> DataFrame:
    """Timestamps from calendar fields; a date that cannot exist drops its own row."""
    stamp = from_fields(F.col(year), F.col(month), F.col(day), F.col(hour) if hour else None)
    return df.withColumn(time, stamp).filter(F.col(time).isNotNull())


def calendar_report(df: DataFrame, year: str = "y", month: str = "m", day: str = "d") -> DataFrame:
    stamp = from_fields(F.col(year), F.col(month), F.col(day))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(stamp.isNull()).alias("n_impossible")
    )


def parse_times(df: DataFrame, source: str, time: str = "time") -> DataFrame:
    """Text to timestamps; unreadable text becomes missing."""
    return df.withColumn(time, parse_time(F.col(source)))


def add_calendar(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumns({"year": F.year(time), "month": F.month(time)})


def resample_monthly(df: DataFrame, rules: Mapping[str, str],
                     keys: Sequence[str] = (), time: str = "time",
                     cell: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """One row per month and cell, stamped with the first of the month.

    `rules` maps a column to `mean` or `sum`. A month with no value at all is
    missing, not zero. Monthly input passes unchanged but for its stamp.
    """
    kinds = {"mean": F.avg, "sum": F.sum}
    unknown = set(rules.values()) - set(kinds)
    if unknown:
        raise ValueError(f"unknown rule: {sorted(unknown)}")
    monthly = aggregate_cells(
        df, [*keys, F.year(time).alias("year"), F.month(time).alias("month"), *cell],
        *[kinds[rule](name).alias(name) for name, rule in rules.items()],
    )
    return monthly.filter(F.col("year").isNotNull()).select(
        *keys, month_start(F.col("year"), F.col("month")).alias(time), "year", "month", *cell, *rules
    )


def sorted_times(df: DataFrame, time: str = "time") -> DataFrame:
    """Distinct times, ascending."""
    return df.select(time).filter(F.col(time).isNotNull()).distinct().orderBy(time)
