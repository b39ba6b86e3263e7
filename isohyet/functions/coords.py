"""Integer keys for coordinates.

Degrees are snapped to whole micro-degrees, so cubes join on integers and never
on floating-point coordinates. The packed cell key needs no grid table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICRO = 1_000_000
_LON_SPAN = 1_000 * MICRO
# Height of a latitude band. Rows of one band and time share a task in regrids and alignments.
BAND = 8 * MICRO


def axis_key(degrees: Column) -> Column:
    return F.rint(degrees * MICRO).cast("long")


def cell_key(lat: Column, lon: Column) -> Column:
    """One BIGINT per cell; longitudes may run from -180 to 360."""
    return pack_keys(axis_key(lat), axis_key(lon))


def pack_keys(lat_key: Column, lon_key: Column) -> Column:
    return (lat_key + 90 * MICRO) * _LON_SPAN + (lon_key + 180 * MICRO)


def lat_band(lat_key: Column) -> Column:
    """The band of 8 degrees a latitude lies in; it follows from the key, so it may join any set of join keys."""
    return F.floor(lat_key / F.lit(BAND)).cast("int")


def with_keys(df: DataFrame) -> DataFrame:
    """Add lat_band, lat_key and lon_key where they are not there yet.

    Joins use all three, so a cube that is hashed by (time, lat_band) can keep
    its partitioning through an alignment.
    """
    missing = {k: axis_key(F.col(c)) for k, c in (("lat_key", "lat"), ("lon_key", "lon")) if k not in df.columns}
    keyed = df.withColumns(missing) if missing else df
    return keyed if "lat_band" in df.columns else keyed.withColumn("lat_band", lat_band(F.col("lat_key")))


def with_cell(df: DataFrame) -> DataFrame:
    if "lat_key" in df.columns and "lon_key" in df.columns:
        return df.withColumn("cell_id", pack_keys(F.col("lat_key"), F.col("lon_key")))
    return df.withColumn("cell_id", cell_key(F.col("lat"), F.col("lon")))


def aggregate_cells(df: DataFrame, keys: Sequence[str | Column], *aggregates: Column) -> DataFrame:
    """`df.groupBy(*keys).agg(*aggregates)`, with lat and lon among the keys compared as integer keys."""
    axes = [k for k in keys if isinstance(k, str) and k in ("lat", "lon")]
    names = [k if isinstance(k, str) else df.select(k).columns[0] for k in keys]
    by = [axis_key(F.col(k)).alias(f"_key_{k}") if isinstance(k, str) and k in axes else k for k in keys]
    out = df.groupBy(*by).agg(*[F.min(k).alias(k) for k in axes], *aggregates)
    hidden = {f"_key_{k}" for k in axes}
    return out.select(*names, *[c for c in out.columns if c not in names and c not in hidden])
