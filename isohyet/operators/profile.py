"""Dataset profiles: statistics, coverage, grids and the catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.functions.coords import axis_key
from isohyet.operators.grids import axis_values


def profile(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Per variable: type, rows, missing, min, max, mean; one pass for all."""
    types = dict(df.dtypes)
    parts = [F.count(F.lit(1)).alias("n_rows")]
    for name in columns:
        c = F.col(name)
        parts += [
            F.min(c).cast("double").alias(f"{name}__min"), F.max(c).cast("double").alias(f"{name}__max"),
            F.avg(c).alias(f"{name}__mean"), F.count_if(c.isNull()).alias(f"{name}__missing"),
        ]
    records = F.array(*[
        F.struct(
            F.lit(n).alias("variable"), F.lit(types[n]).alias("dtype"), F.col(f"{n}__missing").alias("n_missing"),
            F.col(f"{n}__min").alias("min_value"), F.col(f"{n}__max").alias("max_value"),
            F.col(f"{n}__mean").alias("mean_value"),
        ) for n in columns
    ])
    return df.groupBy(*keys).agg(*parts).select(*keys, "n_rows", F.explode(records).alias("r")).select(
        *keys, "n_rows", "r.*"
    )


def coordinates(df: DataFrame, names: Sequence[str] = ("time", "lat", "lon"), keys: Sequence[str] = ()) -> DataFrame:
    """Per coordinate: type, number of distinct values, first and last (as text); one pass for all.

    Distinct values are gathered as sets, combined before the shuffle: there are few of them.
    """
    types = dict(df.dtypes)
    records = F.array(*[F.struct(
        F.lit(n).alias("coordinate"), F.lit(types[n]).alias("dtype"), F.size(F.collect_set(n)).cast("long").alias("size"),
        F.min(n).cast("string").alias("first"), F.max(n).cast("string").alias("last")) for n in names])
    return df.groupBy(*keys).agg(records.alias("r")).select(*keys, F.explode("r").alias("r")).select(*keys, "r.*")


def time_coverage(df: DataFrame, keys: Sequence[str] = ("dataset",), time: str = "time") -> DataFrame:
    """First and last time and number of time steps.

    Times are made distinct first, so a large dataset spreads over its times.
    """
    steps = df.select(*keys, time).distinct()
    return steps.groupBy(*keys).agg(
        F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.count(time).alias("n_times")
    )


def grid_info(df: DataFrame, keys: Sequence[str] = ("dataset",), lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Extent, count and mean spacing of both axes; spacing is 0 for one value."""
    axes = axis_values(df, keys, lat, lon)
    parts = []
    for axis in ("lat", "lon"):
        v = F.when(F.col("axis") == axis, F.col("value"))
        low, high, n = F.min(v), F.max(v), F.count(v)
        parts += [
            low.alias(f"{axis}_min"), high.alias(f"{axis}_max"), n.alias(f"n_{axis}"),
            F.when(n > 1, (high - low) / F.nullif(n - 1, F.lit(0))).otherwise(F.lit(0.0)).alias(f"{axis}_res"),
        ]
    return axes.groupBy(*keys).agg(*parts)


def catalog(df: DataFrame, keys: Sequence[str] = ("dataset",), values: Sequence[str] = ("tas", "pr"),
            time: str = "time") -> DataFrame:
    """Per dataset: rows, shape, time range and the variables that hold data, in one pass.

    Distinct times and coordinates are gathered as sets of keys, combined before the
    shuffle: a dataset has few of them however many rows it has, and no row is multiplied.
    """
    def n_distinct(c: Column) -> Column:
        return F.size(F.collect_set(c)).cast("long")

    present = F.array_compact(F.array(*[F.when(F.count(v) > 0, F.lit(v)) for v in values]))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), n_distinct(F.col(time)).alias("n_times"),
        n_distinct(axis_key(F.col("lat"))).alias("n_lat"), n_distinct(axis_key(F.col("lon"))).alias("n_lon"),
        F.min(time).alias("first_time"), F.max(time).alias("last_time"),
        F.array_join(present, ",").alias("variables"),
    )
