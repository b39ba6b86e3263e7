"""Regridding by separable axis weights, and reshaping of cubes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.functions.coords import MICRO, axis_key, lat_band, with_keys
from isohyet.operators.grids import Grid, axis_weights, weights_by_axis
from isohyet.operators.sizing import fail_when

CELL = ("lat_band", "lat_key", "lon_key", "lat", "lon")
_DUPLICATE = "regrid: two source rows for one cell"


def regrid(df: DataFrame, source: Grid | Mapping[str, Grid], target: Grid, method: str = "bilinear",
           values: Sequence[str] = ("tas", "pr"), keys: Sequence[str] = ("time",), grid_key: str | None = None,
           weights: DataFrame | None = None, keep_missing: bool = False, duplicates: str = "error") -> DataFrame:
    """Move a cube from one grid to another; output: keys, lat_band, lat_key, lon_key, lat, lon, values.

    `source` is one grid, or one grid per value of `grid_key` (one of `keys`,
    such as the model), all moved in one plan.

    Target latitudes lie in bands of 8 degrees. A source row goes to the bands
    that need it: to its own, and next to a border also to the neighbour. One
    shuffle, by (keys, band), carries these source-resolution rows; latitudes are
    combined behind it, then longitudes, so neither weighted nor fine rows are
    ever shuffled. The weight tables are axis tables and are broadcast. A value is
    missing when any cell it needs is missing. A source that is the target up to
    rounding gets the target's coordinates; the check for duplicates and the
    rule for missing cells are the same. A source cell that stands twice is an error, or,
    with `duplicates='flag'`, makes the results that use it missing and true in the column `twice`.
    """
    if duplicates not in ("error", "flag"):
        raise ValueError(f"unknown duplicates rule: {duplicates}")
    flag = duplicates == "flag"
    sources = {"": source} if isinstance(source, Grid) else dict(source)
    if not isinstance(source, Grid) and grid_key not in keys:
        raise ValueError("several source grids need grid_key, one of the keys")
    if weights is None:
        weights = axis_weights(df.sparkSession, sources, target, method)
    rows = df.select(
        *keys, axis_key(F.col("lat")).alias("_lat_src"), axis_key(F.col("lon")).alias("_lon_src"), *values
    )
    on = [] if isinstance(source, Grid) else [grid_key]
    parts = weights_by_axis(weights, on[0] if on else None)
    # The tables hold a few rows per axis coordinate, bounded by AXIS_LIMIT.
    banded = rows.join(F.broadcast(parts["bands"]), [*on, "_lat_src"]).withColumn("lat_band", F.explode("_bands")).drop("_bands")
    spread = banded.repartition(*keys, "lat_band")
    by_lat = spread.join(F.broadcast(parts["lat"]), [*on, "_lat_src", "lat_band"])
    columns = _combine(by_lat, [*keys, "lat_band", "lat_key", "_lon_src"], ["lat"], values, "lat", flag)
    by_lon = columns.join(F.broadcast(parts["lon"]), [*on, "_lon_src"])
    cells = _combine(by_lon, [*keys, "lat_band", "lat_key", "lon_key"], ["lat", "lon"], values, "lon", flag)
    if not keep_missing:
        some = F.coalesce(*[F.col(v) for v in values]).isNotNull()
        cells = cells.filter(some | F.col("twice") if flag else some)
    return cells.select(*keys, *CELL, *values, *["twice"] * flag)


def _combine(df: DataFrame, keys: Sequence[str], carried: Sequence[str], values: Sequence[str],
             axis: str, flag: bool) -> DataFrame:
    """Weighted sums per key; `carried` columns are the same in all rows of a key."""
    w, need = F.col(f"_{axis}_w"), F.col("_need")
    before = [F.max("twice").alias("_twice")] if "twice" in df.columns else []
    summed = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(f"_{axis}_n").alias("_need"), *before, *[F.max(c).alias(c) for c in carried],
        *[F.sum(F.col(v) * w).alias(v) for v in values],
        *[F.count(v).alias(f"_have_{v}") for v in values],
    )
    twice = F.col("_rows") > need
    if before:
        twice = twice | F.col("_twice")
    whole = {v: F.when(F.col(f"_have_{v}") == need, F.col(v)) for v in values}
    if flag:
        return summed.select(*keys, *carried, *[F.when(~twice, whole[v]).alias(v) for v in values], twice.alias("twice"))
    return summed.select(*keys, *carried, *[fail_when(twice, _DUPLICATE, whole[v]).alias(v) for v in values])


def flatten(df: DataFrame, values: str, lat: str = "lats", lon: str = "lons",
            keys: Sequence[str] = ("time",), name: str = "value") -> DataFrame:
    """Array-encoded steps (values[lat][lon] with axis arrays) to one row per cell.

    Missing cells stay as rows.
    """
    by_lat = df.select(*keys, lat, lon, F.posexplode(values).alias("_i", "_row"))
    by_cell = by_lat.select(
        *keys, F.get(lat, F.col("_i")).alias("lat"), lon, F.posexplode("_row").alias("_j", name)
    )
    return by_cell.select(*keys, "lat", F.get(lon, F.col("_j")).alias("lon"), name)


def to_grid(df: DataFrame, grid: Grid, values: Sequence[str], keys: Sequence[str] = ("time",),
            steps: DataFrame | None = None) -> DataFrame:
    """Dense (keys x lat x lon) rows; absent cells are missing.

    `steps` holds the distinct keys; give it when they can be read more cheaply
    than from `df`, which is otherwise computed twice. An off-grid row or a second row for a cell is an error. The skeleton is
    exploded from the axis arrays and spread before the longitudes are added,
    so no task holds a whole grid.
    """
    if steps is None:
        steps = df.select(*keys).distinct()
    on = [*keys, "lat_band", "lat_key", "lon_key"]
    skeleton = (
        steps.withColumn("lat", F.explode(F.lit(np.array(grid.lat))))
        .withColumn("lat_key", axis_key(F.col("lat")))
        .withColumn("lat_band", lat_band(F.col("lat_key")))
        .repartition(*keys, "lat_band")
        .withColumn("lon", F.explode(F.lit(np.array(grid.lon))))
        .withColumn("lon_key", axis_key(F.col("lon")))
        .withColumn("_on_grid", F.lit(True))
    )
    rows = with_keys(df).groupBy(*on).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.max(v).alias(v) for v in values]
    )
    joined = skeleton.join(rows, on, "full_outer")
    off = F.col("_on_grid").isNull()
    checked = [
        fail_when(off, "to_grid: a row lies off the grid",
                  fail_when(F.col("_rows") > 1, "to_grid: two rows for one cell", F.col(v))).alias(v)
        for v in values
    ]
    return joined.select(*keys, "lat", "lon", *checked)


def pivot_map(df: DataFrame, value: str, grid: Grid, max_columns: int = 2000) -> DataFrame:
    """Time mean per cell as a map: one row per lat, one column per lon."""
    if len(grid.lon) > max_columns:
        raise ValueError(f"{len(grid.lon)} longitudes; use the long form")
    keys = {round(lon * MICRO): lon_name(lon) for lon in grid.lon}
    mean = df.groupBy("lat", axis_key(F.col("lon")).alias("_lon_key")).agg(F.avg(value).alias("_mean"))
    return mean.groupBy("lat").pivot("_lon_key", list(keys)).agg(F.max("_mean")).withColumnsRenamed(
        {str(k): name for k, name in keys.items()}
    )


def lon_name(lon: float) -> str:
    return "lon_" + f"{lon:g}".replace("-", "m").replace(".", "_")
