"""Evaluation metrics on aligned pairs.

`pairs` holds pred_<v> and obs_<v> per (year, month, cell), as made by
`align_pred_obs`. Every metric is an algebraic aggregate, so Spark combines
before it shuffles and no cell or model is gathered whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.constants import SAMPLE_POINTS, TEST_YEARS
from isohyet.functions.calendar import season_of
from isohyet.functions.coords import aggregate_cells, cell_key
from isohyet.functions.statistics import (
    bias, both, correlation, mae, r_squared, rmse, share,
)
from isohyet.operators.align import align_pred_obs
from isohyet.operators.grids import Grid, nearest_cell, points_table
from isohyet.operators.temporal import period_select

VARIABLES = ("tas", "pr")


def _p(v: str) -> Column:
    return F.col(f"pred_{v}")


def _o(v: str) -> Column:
    return F.col(f"obs_{v}")


def spatial_mean(df: DataFrame, values: Sequence[str] = VARIABLES,
                 keys: Sequence[str] = ("year", "month")) -> DataFrame:
    """Unweighted mean over cells per time step."""
    return df.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values])


def _per_cell(df: DataFrame, aggregates: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """Group by the integer cell key; the coordinates are carried along."""
    return df.groupBy(*keys, "cell_id").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"), *aggregates)


def cell_rmse(pairs: DataFrame, variables: Sequence[str] = VARIABLES) -> DataFrame:
    return _per_cell(pairs, [rmse(_p(v), _o(v)).alias(f"rmse_{v}") for v in variables])


def cell_correlation(pairs: DataFrame, variables: Sequence[str] = VARIABLES) -> DataFrame:
    return _per_cell(pairs, [correlation(_p(v), _o(v)).alias(f"corr_{v}") for v in variables])


def cell_metrics(pairs: DataFrame, variables: Sequence[str] = VARIABLES) -> DataFrame:
    """RMSE, correlation and pair count per cell in one aggregate."""
    return _per_cell(pairs, [
        e for v in variables for e in (
            F.count_if(both(_p(v), _o(v))).alias(f"n_{v}"),
            rmse(_p(v), _o(v)).alias(f"rmse_{v}"),
            correlation(_p(v), _o(v)).alias(f"corr_{v}"),
        )
    ])


def mean_of_cell_metric(pairs: DataFrame, variables: Sequence[str] = VARIABLES,
                        keys: Sequence[str] = (), cell: Sequence[str] = ("cell_id",)) -> DataFrame:
    """Unweighted mean over cells of the per-cell RMSE and correlation."""
    per_cell = pairs.groupBy(*keys, *cell).agg(*[
        e for v in variables for e in (
            rmse(_p(v), _o(v)).alias(f"rmse_{v}"), correlation(_p(v), _o(v)).alias(f"corr_{v}"),
        )
    ])
    names = [f"{m}_{v}" for v in variables for m in ("rmse", "corr")]
    return per_cell.groupBy(*keys).agg(*[F.avg(n).alias(n) for n in names])


def mae_bias(pairs: DataFrame, variables: Sequence[str] = VARIABLES, keys: Sequence[str] = ()) -> DataFrame:
    """Mean absolute and mean error over all cells and times."""
    return pairs.groupBy(*keys).agg(*[
        e for v in variables
        for e in (mae(_p(v), _o(v)).alias(f"mae_{v}"), bias(_p(v), _o(v)).alias(f"bias_{v}"))
    ])


def seasonal_climatology(df: DataFrame, values: Sequence[str] = VARIABLES,
                         cell: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Mean per season and cell, all seasons in one pass."""
    return aggregate_cells(df, [season_of(F.col("month")).alias("season"), *cell], *[F.avg(v).alias(v) for v in values])


def monthly_climatology(df: DataFrame, values: Sequence[str] = VARIABLES,
                        cell: Sequence[str] = ("lat", "lon")) -> DataFrame:
    return aggregate_cells(df, ["month", *cell], *[F.avg(v).alias(v) for v in values])


def pattern_correlation(sides: DataFrame, variables: Sequence[str] = VARIABLES, strict: bool = False) -> DataFrame:
    """Pearson across cells of the two seasonal maps, per season.

    `sides` comes from `align_pred_obs(how='full_outer')`, so each side's
    climatology uses all of its own months. Cells that miss a side are left
    out; with `strict` they make the season's result missing.
    """
    names = [f"{p}_{v}" for v in variables for p in ("pred", "obs")]
    maps = seasonal_climatology(sides, names, ("cell_id",))
    return maps.groupBy("season").agg(*[_pattern(v, strict).alias(f"pattern_corr_{v}") for v in variables])


def _pattern(v: str, strict: bool) -> Column:
    value = correlation(_p(v), _o(v))
    return F.when(F.count_if(~both(_p(v), _o(v))) == 0, value) if strict else value


def point_metrics(pred: DataFrame, obs: DataFrame, pred_grid: Grid, obs_grid: Grid, variable: str = "tas",
                  points: Sequence[tuple[float, float]] = SAMPLE_POINTS) -> DataFrame:
    """RMSE, MAE, bias and correlation at given points.

    Each side is read at the cell nearest the point on its own grid.
    """
    pairs = point_series(pred, obs, pred_grid, obs_grid, variable, points)
    p, o = F.col("pred"), F.col("obs")
    # The outer series keeps every point; pairs alone count.
    return pairs.groupBy("point", "lat", "lon").agg(
        rmse(p, o).alias("rmse"), mae(p, o).alias("mae"), bias(p, o).alias("bias"), correlation(p, o).alias("corr"),
    )


def point_series(pred: DataFrame, obs: DataFrame, pred_grid: Grid, obs_grid: Grid, variable: str = "tas",
                 points: Sequence[tuple[float, float]] = SAMPLE_POINTS) -> DataFrame:
    """Predicted and observed series at each point, on the union of their times."""
    spark = pred.sparkSession
    located = points_table(spark, points)

    def at_points(df: DataFrame, grid: Grid, name: str) -> DataFrame:
        near = nearest_cell(located, grid).select(
            "point", "lat", "lon", cell_key(F.col("grid_lat"), F.col("grid_lon")).alias("cell_id")
        )
        cube = df.select("year", "month", cell_key(F.col("lat"), F.col("lon")).alias("cell_id"),
                         F.col(variable).alias(name))
        return cube.join(F.broadcast(near), "cell_id").drop("cell_id")

    on = ["point", "lat", "lon", "year", "month"]
    return at_points(pred, pred_grid, "pred").join(at_points(obs, obs_grid, "obs"), on, "full_outer")


def evaluate_test_period(pred: DataFrame, obs: DataFrame, years: tuple[int, int] = TEST_YEARS,
                         strict: bool = False) -> DataFrame:
    """The test report as rows (scope, variable, metric, value).

    One full join and one grouping-sets aggregate give the per-cell metrics and
    the seasonal maps together.
    """
    sides = align_pred_obs(
        period_select(pred, years), period_select(obs, years), VARIABLES, how="full_outer"
    ).withColumn("season", season_of(F.col("month")))
    aggregates = []
    for v in VARIABLES:
        d = _p(v) - _o(v)
        aggregates += [
            F.avg(_p(v)).alias(f"pred_{v}"), F.avg(_o(v)).alias(f"obs_{v}"),
            rmse(_p(v), _o(v)).alias(f"rmse_{v}"), correlation(_p(v), _o(v)).alias(f"corr_{v}"),
            F.count(d).alias(f"n_{v}"), F.sum(F.abs(d)).alias(f"abs_{v}"), F.sum(d).alias(f"sum_{v}"),
        ]
    maps = sides.groupingSets(
        [[F.col("cell_id")], [F.col("cell_id"), F.col("season")]], F.col("cell_id"), F.col("season")
    ).agg(F.grouping("season").alias("_whole"), *aggregates)

    scope = F.when(F.col("_whole") == 1, "all").otherwise(F.col("season"))
    whole = F.col("scope") == "all"
    out = []
    for v in VARIABLES:
        n = F.sum(f"n_{v}")
        out += [
            F.when(whole, F.avg(f"rmse_{v}")).alias(f"{v}__rmse"),
            F.when(whole, F.try_divide(F.sum(f"abs_{v}"), n)).alias(f"{v}__mae"),
            F.when(whole, F.try_divide(F.sum(f"sum_{v}"), n)).alias(f"{v}__bias"),
            F.when(whole, F.avg(f"corr_{v}")).alias(f"{v}__spatial_corr"),
            F.when(~whole, _pattern(v, strict)).alias(f"{v}__pattern_corr"),
        ]
    wide = maps.withColumn("scope", scope).groupBy("scope").agg(*out)
    records = F.array(*[
        F.struct(F.lit(v).alias("variable"), F.lit(m).alias("metric"), F.col(f"{v}__{m}").alias("value"))
        for v in VARIABLES for m in ("rmse", "mae", "bias", "spatial_corr", "pattern_corr")
    ])
    rows = wide.select("scope", F.explode(records).alias("r")).select("scope", "r.*")
    return rows.filter((F.col("metric") == "pattern_corr") == (F.col("scope") != "all"))


def regression_metrics(df: DataFrame, truth: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Pooled RMSE, MAE, R2 and bias."""
    p, y = F.col(pred), F.col(truth)
    return df.groupBy(*keys).agg(
        rmse(p, y).alias("rmse"), mae(p, y).alias("mae"), r_squared(p, y).alias("r2"), bias(p, y).alias("bias"),
    )


def log_and_mm_metrics(df: DataFrame, truth_log: str, pred_log: str, keys: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R2 in log1p space and again in mm."""
    p, y = F.col(pred_log), F.col(truth_log)
    pm, ym = F.expm1(p), F.expm1(y)
    return df.groupBy(*keys).agg(
        rmse(p, y).alias("rmse_log"), mae(p, y).alias("mae_log"), r_squared(p, y).alias("r2_log"),
        rmse(pm, ym).alias("rmse_mm"), mae(pm, ym).alias("mae_mm"), r_squared(pm, ym).alias("r2_mm"),
    )


def two_stage_metrics(df: DataFrame, truth: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Metrics of the combined prediction and the two wet shares."""
    p, y = F.col(pred), F.col(truth)
    return df.groupBy(*keys).agg(
        rmse(p, y).alias("rmse"), mae(p, y).alias("mae"), r_squared(p, y).alias("r2"),
        share(y > 0).alias("obs_wet_fraction"), share(p > 0).alias("pred_wet_fraction"),
    )


def scatter_stats(df: DataFrame, truth: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Squared Pearson correlation, RMSE and bias on complete pairs."""
    p, y = F.col(pred), F.col(truth)
    r = correlation(p, y)
    return df.groupBy(*keys).agg(
        F.count_if(both(p, y)).alias("n"), (r * r).alias("r2"), rmse(p, y).alias("rmse"), bias(p, y).alias("bias"),
    )


def density_bins(df: DataFrame, truth: str, pred: str, bins: int = 50) -> DataFrame:
    """Counts of (observed, predicted) pairs on a bins x bins lattice of the data range.

    Empty bins are left out. The range is one scalar subquery.
    """
    x, y = F.col(truth).cast("double"), F.col(pred).cast("double")
    pairs = df.filter(both(x, y)).select(x.alias("x"), y.alias("y"))
    box = pairs.agg(F.struct(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
    ).alias("box")).scalar()

    def index(value: str, low: Column, high: Column) -> Column:
        width = F.nullif((high - low) / bins, F.lit(0.0))
        raw = F.floor(F.coalesce((F.col(value) - low) / width, F.lit(0.0))).cast("int")
        return F.least(raw, F.lit(bins - 1))

    return pairs.withColumn("box", box).select(
        index("x", F.col("box.x0"), F.col("box.x1")).alias("x_bin"),
        index("y", F.col("box.y0"), F.col("box.y1")).alias("y_bin"),
    ).groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n"))


def hexagon_bins(df: DataFrame, truth: str, pred: str, bins: int = 50, min_count: int = 1) -> DataFrame:
    """Counts of (observed, predicted) pairs in hexagons: lattice, i, j, the centre (x, y) and n, from `min_count` pairs on.

    Hexagons are the cells of the points nearest to one of two lattices, the second offset by half
    a step on both axes. There are `bins` steps on the x axis and bins / sqrt(3) on the y axis,
    whose distances count three times, so the cells are regular. A pair as close to both
    lattices belongs to the offset one; halfway between two centres of one lattice it belongs to the larger.
    """
    x, y = F.col(truth).cast("double"), F.col(pred).cast("double")
    pairs = df.filter(both(x, y) & ~F.isnan(x) & ~F.isnan(y)).select(x.alias("x"), y.alias("y"))
    box = pairs.agg(F.struct(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
    ).alias("box")).scalar()
    steps = {"x": bins, "y": max(1, int(bins / math.sqrt(3)))}

    def width(axis: str) -> Column:
        return (F.col(f"box.{axis}1") - F.col(f"box.{axis}0")) / steps[axis]

    def scaled(axis: str) -> Column:
        return F.coalesce((F.col(axis) - F.col(f"box.{axis}0")) / F.nullif(width(axis), F.lit(0.0)), F.lit(0.0))

    placed = pairs.withColumn("box", box).select("box", scaled("x").alias("u"), scaled("y").alias("v"))
    placed = placed.withColumns({"i1": F.floor(F.col("u") + 0.5), "j1": F.floor(F.col("v") + 0.5), "i2": F.floor("u"), "j2": F.floor("v")})

    def distance(i: Column, j: Column) -> Column:
        return (F.col("u") - i) * (F.col("u") - i) + 3 * (F.col("v") - j) * (F.col("v") - j)

    offset = distance(F.col("i2") + 0.5, F.col("j2") + 0.5) <= distance(F.col("i1"), F.col("j1"))
    cells = placed.select("box", offset.cast("int").alias("lattice"), F.when(offset, F.col("i2")).otherwise(F.col("i1")).alias("i"),
                          F.when(offset, F.col("j2")).otherwise(F.col("j1")).alias("j"))
    counted = cells.groupBy("lattice", "i", "j").agg(F.count(F.lit(1)).alias("n"), F.first("box").alias("box")).filter(F.col("n") >= min_count)
    return counted.select("lattice", "i", "j", (F.col("box.x0") + (F.col("i") + F.col("lattice") * 0.5) * width("x")).alias("x"),
                          (F.col("box.y0") + (F.col("j") + F.col("lattice") * 0.5) * width("y")).alias("y"), "n")


def bias_map(pairs: DataFrame, variable: str = "tas", by_season: bool = False) -> DataFrame:
    """Mean predicted, observed and their difference per cell, with the symmetric limit.

    The limit is the largest absolute difference (per season when asked).
    """
    keys = ["season"] if by_season else []
    rows = pairs.withColumn("season", season_of(F.col("month"))) if by_season else pairs
    maps = _per_cell(
        rows, [F.avg(_p(variable)).alias("pred_mean"), F.avg(_o(variable)).alias("obs_mean")], keys
    ).withColumn("bias", F.col("pred_mean") - F.col("obs_mean"))
    limits = maps.groupBy(*keys).agg(F.max(F.abs(F.col("bias"))).alias("limit"))
    if by_season:
        return maps.join(F.broadcast(limits), keys)  # one row per season
    return maps.withColumn("limit", limits.scalar())


def bias_maps(pairs: DataFrame, variables: Sequence[str] = VARIABLES, by_season: bool = False) -> DataFrame:
    """`bias_map` of several variables in one pass over the pairs: variable, (season,) lat, lon, cell_id and the means."""
    keys = ["season"] if by_season else []
    rows = pairs.withColumn("season", season_of(F.col("month"))) if by_season else pairs
    means = _per_cell(rows, [F.avg(f(v)).alias(f"{n}_{v}") for v in variables for n, f in (("p", _p), ("o", _o))], keys)
    parts = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"p_{v}").alias("pred_mean"), F.col(f"o_{v}").alias("obs_mean")) for v in variables])
    names = [c for c in means.columns if not c.startswith(("p_", "o_"))]
    maps = means.select(*names, F.explode(parts).alias("m")).select(*names, "m.*").withColumn("bias", F.col("pred_mean") - F.col("obs_mean"))
    limits = maps.groupBy("variable", *keys).agg(F.max(F.abs(F.col("bias"))).alias("limit"))
    return maps.join(F.broadcast(limits), ["variable", *keys])  # a few rows per variable


def prediction_summary(df: DataFrame, values: Sequence[str] = ("pred_tas", "pred_pr"),
                       keys: Sequence[str] = ("model", "scenario")) -> DataFrame:
    return df.groupBy(*keys).agg(*[
        f(v).alias(f"{n}_{v}") for v in values for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))
    ])


