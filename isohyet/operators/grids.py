"""Grids as axis metadata, and weights between two grids.

A rectilinear grid is two short lists of coordinates. Every supported regrid is
separable, so weights are kept per axis (a few rows per coordinate) and never
per pair of cells: the tables stay broadcastable for any rectilinear grid.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from isohyet.functions.coords import BAND, MICRO, axis_key, cell_key, lat_band
from isohyet.operators.sizing import fail_when

# 200,000 coordinates on one axis are 200 m at the equator.
AXIS_LIMIT = 200_000
# Coordinates this close are the same.
RTOL, ATOL = 1e-5, 1e-8
# A target this far outside the source hull, in degrees, is on its border.
SNAP = 1e-5
METHODS = ("bilinear", "nearest", "conservative")


@dataclass(frozen=True)
class Grid:
    """Ascending latitudes and longitudes of a rectilinear grid."""

    lat: tuple[float, ...]
    lon: tuple[float, ...]

    @property
    def size(self) -> int:
        return len(self.lat) * len(self.lon)


def _local(spark: SparkSession, **columns) -> DataFrame:
    return spark.createDataFrame(pa.table(columns))


def axis_values(df: DataFrame, keys: Sequence[str] = (), lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Distinct coordinates per axis (keys, axis, key, value), in one pass."""
    pairs = F.array(
        F.struct(F.lit("lat").alias("axis"), F.col(lat).alias("value")),
        F.struct(F.lit("lon").alias("axis"), F.col(lon).alias("value")),
    )
    rows = df.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.axis", "p.value")
    return (
        rows.filter(F.col("value").isNotNull())
        .groupBy(*keys, "axis", axis_key(F.col("value")).alias("key"))
        .agg(F.min("value").alias("value"))
    )


def grids_of(df: DataFrame, key: str, lat: str = "lat", lon: str = "lon") -> dict[str, Grid]:
    """The grid of each model (or other key) of a cube, found in one job.

    Raises when the points are not rectilinear axes.
    """
    rows = axis_values(df, [key], lat, lon)
    # The bound is per axis, so any number of grids may come together.
    axis = rows.groupBy(key, "axis").agg(F.count(F.lit(1)).alias("n"), F.collect_list("value").alias("values"))
    table = axis.select(key, "axis", fail_when(
        F.col("n") > AXIS_LIMIT, "too many distinct coordinates: not rectilinear grids", F.col("values")).alias("values")).toArrow()
    axes: dict[str, dict[str, list[float]]] = {}
    for name, axis, values in zip(*(table[c].to_pylist() for c in (key, "axis", "values"))):
        axes.setdefault(name, {"lat": [], "lon": []})[axis] += values
    return {n: Grid(tuple(sorted(a["lat"])), tuple(sorted(a["lon"]))) for n, a in axes.items()}


def grids_of_cubes(cubes: Mapping[str, DataFrame]) -> dict[str, Grid]:
    """The grids of several cubes, found in one job."""
    points = [df.select(F.lit(name).alias("_cube"), "lat", "lon") for name, df in cubes.items()]
    return grids_of(reduce(DataFrame.unionByName, points), "_cube")


def grid_of(df: DataFrame, lat: str = "lat", lon: str = "lon") -> Grid:
    """The grid a cube lies on."""
    found = grids_of(df.withColumn("_cube", F.lit("cube")), "_cube", lat, lon)
    return found.get("cube", Grid((), ()))


def grid_table(spark: SparkSession, grid: Grid, name: str = "grid") -> DataFrame:
    """The grid as a table: grid_name, cell_id, lat_idx, lon_idx, lat, lon.

    The longitudes are exploded from an array, so no join is needed and the rows
    of one latitude stay together.
    """
    lats = _local(
        spark,
        lat_idx=pa.array(range(len(grid.lat)), pa.int32()),
        lat=pa.array(grid.lat, pa.float64()),
    )
    return lats.select(
        F.lit(name).alias("grid_name"), "lat_idx", "lat", F.posexplode(F.lit(np.array(grid.lon))).alias("lon_idx", "lon")
    ).select("grid_name", cell_key(F.col("lat"), F.col("lon")).alias("cell_id"), "lat_idx", "lon_idx", "lat", "lon")


def axes_table(spark: SparkSession, grids: Mapping[str, Grid]) -> DataFrame:
    """Axis coordinates of named grids: (grid, axis, idx, value, key)."""
    names, axes, index, values = [], [], [], []
    for name, grid in grids.items():
        for axis, coords in (("lat", grid.lat), ("lon", grid.lon)):
            names += [name] * len(coords)
            axes += [axis] * len(coords)
            index += range(len(coords))
            values += coords
    table = _local(
        spark, grid=pa.array(names, pa.string()), axis=pa.array(axes, pa.string()),
        idx=pa.array(index, pa.int32()), value=pa.array(values, pa.float64()),
    )
    return table.withColumn("key", axis_key(F.col("value")))


def same_grid(first: Grid, second: Grid, rtol: float = RTOL, atol: float = ATOL) -> bool:
    """Equal sizes and every coordinate close."""
    def close(a, b):
        return len(a) == len(b) and all(abs(x - y) <= atol + rtol * abs(y) for x, y in zip(a, b))

    return close(first.lat, second.lat) and close(first.lon, second.lon)


def compare_grids(first: DataFrame, second: DataFrame, rtol: float = RTOL, atol: float = ATOL) -> DataFrame:
    """`same_grid` as a table: per axis the sizes, the largest gap and the verdict.

    Both inputs are axis tables (axis, idx, value).
    """
    a = first.select("axis", "idx", F.col("value").alias("a"))
    b = second.select("axis", "idx", F.col("value").alias("b"))
    gap = F.abs(F.col("a") - F.col("b"))
    return a.join(b, ["axis", "idx"], "full_outer").groupBy("axis").agg(
        F.count("a").alias("n_first"), F.count("b").alias("n_second"), F.max(gap).alias("max_gap"),
        F.coalesce(
            F.bool_and(F.coalesce(gap <= F.lit(atol) + F.lit(rtol) * F.abs(F.col("b")), F.lit(False))), F.lit(False)
        ).alias("same"),
    )


def indexed_axes(values: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Number the coordinates of each axis in ascending order, from 0."""
    w = Window.partitionBy(*keys, "axis").orderBy("key")
    return values.withColumn("idx", F.row_number().over(w) - 1)


def axis_steps(values: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Difference of each coordinate to the one before it."""
    w = Window.partitionBy(*keys, "axis").orderBy("key")
    return values.withColumn("step", F.col("value") - F.lag("value").over(w))


def axis_bracket(source: DataFrame, target: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Source neighbours of each target coordinate: (keys, axis, key, value, below, above).

    Both axes are merged and scanned in order, once upwards and once downwards,
    so no range join is needed. A neighbour that does not exist is NULL.
    """
    columns = [*keys, "axis", "key", "value"]
    both = source.select(*columns, F.lit(True).alias("is_source")).unionByName(
        target.select(*columns, F.lit(False).alias("is_source"))
    )
    known = F.when(F.col("is_source"), F.col("value"))
    axis = Window.partitionBy(*keys, "axis")
    span = (Window.unboundedPreceding, Window.currentRow)
    return (
        both.withColumn("below", F.last(known, ignorenulls=True).over(axis.orderBy("key").rangeBetween(*span)))
        .withColumn("above", F.last(known, ignorenulls=True).over(axis.orderBy(F.desc("key")).rangeBetween(*span)))
        .filter(~F.col("is_source"))
        .select(*columns, "below", "above")
    )


def _pair(src: Column, weight: Column) -> Column:
    return F.struct(src.alias("src"), weight.cast("double").alias("w"))


def _unfold(df: DataFrame, pairs: Column) -> DataFrame:
    rows = df.select("grid", "axis", F.col("value").alias("dst"), pairs.alias("pairs")).filter(
        F.col("pairs").isNotNull()
    )
    return rows.select(
        "grid", "axis", "dst", F.size("pairs").alias("n_src"), F.explode("pairs").alias("p")
    ).select("grid", "axis", axis_key(F.col("p.src")).alias("src_key"), "dst", F.col("p.w").alias("w"), "n_src")


def bilinear_weights(source: DataFrame, target: DataFrame) -> DataFrame:
    """Linear weights per axis. Targets outside the source hull have none.

    A target that misses the hull by rounding only takes the value of its border.
    """
    t, slack = F.col("value"), F.lit(SNAP) + F.lit(RTOL) * F.abs(F.col("value"))
    lo = F.coalesce("below", F.when(F.col("above") - t <= slack, F.col("above")))
    hi = F.coalesce("above", F.when(t - F.col("below") <= slack, F.col("below")))
    pairs = F.when(axis_key(lo) == axis_key(hi), F.array(_pair(lo, F.lit(1.0)))).when(
        lo.isNotNull() & hi.isNotNull(),
        F.array(_pair(lo, (hi - t) / (hi - lo)), _pair(hi, (t - lo) / (hi - lo))),
    )
    return _unfold(axis_bracket(source, target, ["grid"]), pairs)


def _nearest(t: Column, lo: Column, hi: Column) -> Column:
    """The closer neighbour; halfway, the larger one."""
    return F.coalesce(F.when(t - lo < hi - t, lo).when(t - lo >= hi - t, hi), lo, hi)


def nearest_weights(source: DataFrame, target: DataFrame) -> DataFrame:
    """Weight 1 at the nearest coordinate, also outside the hull."""
    near = _nearest(F.col("value"), F.col("below"), F.col("above"))
    return _unfold(axis_bracket(source, target, ["grid"]), F.array(_pair(near, F.lit(1.0))))


def axis_bounds(values: DataFrame) -> DataFrame:
    """Cell bounds halfway between neighbours; the outer cells are symmetric."""
    w = Window.partitionBy("grid", "axis").orderBy("key")
    before = F.col("value") - F.lag("value").over(w)
    after = F.lead("value").over(w) - F.col("value")
    low = F.col("value") - F.coalesce(F.col("_before"), F.col("_after")) / 2
    high = F.col("value") + F.coalesce(F.col("_after"), F.col("_before")) / 2
    # Latitudes end at the poles.
    is_lat = F.col("axis") == "lat"
    return values.withColumns({"_before": before, "_after": after}).select(
        "grid", "axis", "key", "value",
        F.when(is_lat, F.greatest(low, F.lit(-90.0))).otherwise(low).alias("low"),
        F.when(is_lat, F.least(high, F.lit(90.0))).otherwise(high).alias("high"),
    )


def _measure(low: Column, high: Column) -> Column:
    """Extent of an interval: difference of sines on latitude, degrees on longitude."""
    return F.when(
        F.col("axis") == "lat", F.sin(F.radians(high)) - F.sin(F.radians(low))
    ).otherwise(high - low)


def conservative_weights(source: DataFrame, target: DataFrame) -> DataFrame:
    """Overlap of each source and target interval over the covered part of the target.

    A target cell that reaches beyond the source grid gets the area mean of the
    part that is covered; a cell without any cover has no weights.

    The bounds of both axes are merged in order. Each stretch between two
    bounds lies in one source and one target cell, so a scan finds all overlaps.
    """
    def edges(axis: DataFrame, role: str) -> DataFrame:
        b = axis_bounds(axis)
        last = F.row_number().over(Window.partitionBy("grid", "axis").orderBy(F.desc("key"))) == 1
        cell = F.struct(F.col("value").alias("cell"))
        none = F.struct(F.lit(None).cast("double").alias("cell"))
        starts = b.select("grid", "axis", F.col("low").alias("at"), cell.alias(role))
        ends = b.withColumn("_last", last).filter("_last").select(
            "grid", "axis", F.col("high").alias("at"), none.alias(role)
        )
        return starts.unionByName(ends)

    # Bounds that agree to a micro-degree are one bound, not a sliver.
    marks = (
        edges(source, "src").unionByName(edges(target, "dst"), allowMissingColumns=True)
        .groupBy("grid", "axis", axis_key(F.col("at")).alias("pos"))
        .agg(F.max("at").alias("at"), F.max("src").alias("src"), F.max("dst").alias("dst"))
    )
    w = Window.partitionBy("grid", "axis").orderBy("pos")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stretches = (
        marks.withColumns({
            "src": F.last("src", ignorenulls=True).over(upto)["cell"],
            "dst": F.last("dst", ignorenulls=True).over(upto)["cell"],
            "to": F.lead("at").over(w),
        })
        .filter(F.col("dst").isNotNull() & F.col("to").isNotNull())
        .withColumn("extent", _measure(F.col("at"), F.col("to")))
    )
    cell = Window.partitionBy("grid", "axis", "dst")
    return (
        stretches.groupBy("grid", "axis", "dst", "src").agg(F.sum("extent").alias("extent"))
        .filter(F.col("src").isNotNull())
        .withColumn("w", F.col("extent") / F.sum("extent").over(cell))
        .withColumn("n_src", F.count("src").over(cell).cast("int"))
        .select("grid", "axis", axis_key(F.col("src")).alias("src_key"), "dst", "w", "n_src")
    )


def axis_weights(spark: SparkSession, sources: Mapping[str, Grid], target: Grid,
                 method: str = "bilinear") -> DataFrame:
    """Weights (grid, axis, src_key, dst, w, n_src, bands) of named source grids to one target.

    n_src is the number of source coordinates a target coordinate needs. A grid
    that is the target up to rounding maps one to one.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}; one of {METHODS}")
    build = {"bilinear": bilinear_weights, "nearest": nearest_weights, "conservative": conservative_weights}[method]
    same = {name: g for name, g in sources.items() if same_grid(g, target)}
    other = {name: g for name, g in sources.items() if name not in same}
    weights = build(axes_table(spark, other), axes_table(spark, {name: target for name in other}))
    weights = weights.unionByName(same_weights(axes_table(spark, same), axes_table(spark, {name: target for name in same})))
    # A few rows per coordinate of grids that are in memory already: evaluated once, here.
    return spark.createDataFrame(_with_bands(weights.toArrow()))


def _with_bands(weights: pa.Table) -> pa.Table:
    """Add `bands`: at the first row of each source latitude the target bands that need it, elsewhere nothing."""
    needed: dict[tuple[str, int], set[int]] = {}
    firsts = []
    for grid, axis, src, dst in zip(*(weights[c].to_pylist() for c in ("grid", "axis", "src_key", "dst"))):
        key = (grid, src) if axis == "lat" else None
        firsts.append(key if key and key not in needed else None)
        if key:
            needed.setdefault(key, set()).add(round(dst * MICRO) // BAND)
    bands = [sorted(needed[key]) if key else None for key in firsts]
    return weights.append_column("bands", pa.array(bands, pa.list_(pa.int32())))


def same_weights(source: DataFrame, target: DataFrame) -> DataFrame:
    """Weight 1 from each coordinate to the one at the same place of an axis of equal size."""
    dst = target.select("grid", "axis", "idx", F.col("value").alias("dst"))
    return source.join(dst, ["grid", "axis", "idx"]).select(
        "grid", "axis", F.col("key").alias("src_key"), "dst", F.lit(1.0).alias("w"), F.lit(1).alias("n_src"))


def nearest_cell(points: DataFrame, grid: Grid, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Add grid_lat and grid_lon: the nearest on each axis alone, ties upwards.

    The sorted axes are array literals, so no join is needed; each is searched by
    halving, in as many steps as its length has binary digits.
    """
    def near(col: Column, axis: Sequence[float]) -> Column:
        values = F.lit(np.array(axis, float))
        steps = [1 << k for k in reversed(range(len(axis).bit_length()))]

        def further(at: Column, step: Column) -> Column:
            # Past the end there is no value, and the comparison is not true.
            return F.when(F.get(values, at + step - 1) <= col, at + step).otherwise(at)

        # How many coordinates are not larger than the value.
        upto = F.aggregate(F.lit(steps), F.lit(0), further)
        below = F.get(values, upto - 1)
        above = F.when(below == col, below).otherwise(F.get(values, upto))
        return _nearest(col, below, above)

    return points.withColumns({
        "grid_lat": F.when(F.col(lat).isNotNull(), near(F.col(lat), grid.lat)),
        "grid_lon": F.when(F.col(lon).isNotNull(), near(F.col(lon), grid.lon)),
    })


def points_table(spark: SparkSession, points: Sequence[tuple[float, float]]) -> DataFrame:
    return _local(
        spark,
        point=pa.array(range(len(points)), pa.int32()),
        lat=pa.array([p[0] for p in points], pa.float64()),
        lon=pa.array([p[1] for p in points], pa.float64()),
    )


def weights_by_axis(weights: DataFrame, key: str | None) -> dict[str, DataFrame]:
    """The tables a regrid joins, with the grid under the cube's key column: both axes' weights, and the bands that need a source latitude."""
    grid = [F.col("grid").alias(key)] if key else []
    band = lat_band(axis_key(F.col("dst")))
    return {
        "bands": weights.filter(F.col("bands").isNotNull()).select(*grid, F.col("src_key").alias("_lat_src"), F.col("bands").alias("_bands")),
    } | {
        axis: weights.filter(F.col("axis") == axis).select(
            *grid, F.col("src_key").alias(f"_{axis}_src"), F.col("dst").alias(axis),
            axis_key(F.col("dst")).alias(f"{axis}_key"),
            F.col("w").alias(f"_{axis}_w"), F.col("n_src").alias(f"_{axis}_n"),
            *([band.alias("lat_band")] if axis == "lat" else []),
        )
        for axis in ("lat", "lon")
    }
