"""Readers: raw long cells to standard cubes.

A standard cube has time, lat, lon, tas (degC) and pr (mm/month), with NULL for
missing values, and model and scenario where they apply.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from isohyet.constants import (
    ALL_YEARS, HISTORICAL, MODEL_COORDS, RANGES, TARGET_COORDS, VARIABLE_ALIASES,
)
from isohyet.functions.calendar import from_fields
from isohyet.functions.units import (
    kelvin_to_celsius, metres_to_mm, per_day_to_per_month,
)
from isohyet.operators.features import scoring_features
from isohyet.operators.align import join_tas_pr
from isohyet.functions.coords import MICRO, axis_key
from isohyet.operators.grids import Grid
from isohyet.operators.naming import (
    alias_variable, drop_coords, nulls_for_nan, rename_coords,
)
from isohyet.operators.quality import DataQualityError, validate_range
from isohyet.operators.regrid import regrid
from isohyet.sources import runs
from isohyet.sources.survey import Range, Survey, judge, survey, values_of
from isohyet.operators.temporal import (
    clip_years, conditional_clip, in_years, parse_times, resample_monthly,
)

FORMATS = ("parquet", "json", "csv")
VALUES = ("tas", "pr")


def read_cells(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """Long cells from Parquet, JSON or CSV; text formats need a schema."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format: {fmt}; one of {FORMATS}")
    reader = spark.read
    if fmt != "parquet":
        if schema is None:
            raise ValueError(f"{fmt} needs a schema")
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def _standard_reference(raw: DataFrame) -> DataFrame:
    cube = alias_variable(alias_variable(raw, VARIABLE_ALIASES["cru_tmp"], "tas"), VARIABLE_ALIASES["cru_pre"], "pr")
    return nulls_for_nan(cube, VALUES)


def read_reference(raw: DataFrame, years: tuple[int, int] = ALL_YEARS, validate: bool = True) -> tuple[DataFrame, Grid]:
    """The observed cube of the period and the grid it defines, after one pass.

    Ranges are strict and are checked on all years; an empty period is an error.
    """
    cube = _standard_reference(raw)
    found = survey(cube, RANGES["reference"], inside=in_years(*years), axes_inside=True)
    if validate:
        judge(found, "reference")
    return clip_years(cube, *years), found[()].grid


def watched_reference(raw: DataFrame, years: tuple[int, int] = ALL_YEARS) -> tuple[DataFrame, Observation]:
    """The observed cube of the period, and what `check_watched` needs, observed while the cube is written: no pass of its own.

    Ranges are seen on all years, before the clip.
    """
    seen = Observation()
    cube = _standard_reference(raw)
    counts = [F.count(F.lit(1)).alias("n_rows"), F.count_if(in_years(*years)).alias("n_in_period")]
    for name, (low, high, _) in RANGES["reference"].items():
        c = F.col(name)
        counts += [F.min(c).alias(f"{name}__min"), F.max(c).alias(f"{name}__max"), F.avg(c).alias(f"{name}__mean"),
                   F.count(c).alias(f"{name}__n"), F.count_if((c < low) | (c > high)).alias(f"{name}__outside")]
    # The clip stands behind the observation, which sees every row.
    return clip_years(cube.observe(seen, *counts), *years), seen


def check_watched(seen: Observation, what: str = "reference") -> None:
    """Raise where the observed rows break a strict rule or leave nothing in the period."""
    got = values_of(seen)
    if not got:
        raise DataQualityError(f"{what}: no rows")
    ranges = {name: Range(low, high, strict, got["n_rows"] - got[f"{name}__n"], got[f"{name}__outside"], got[f"{name}__min"],
                          got[f"{name}__max"], got[f"{name}__mean"]) for name, (low, high, strict) in RANGES["reference"].items()}
    judge({(): Survey(got["n_rows"], 0, got["n_in_period"], ranges, Grid((), ()))}, what)


def convert_target(raw: DataFrame) -> DataFrame:
    """Rename, drop unused coordinates, K to degC, m to mm."""
    cube = rename_coords(drop_coords(raw), TARGET_COORDS)
    cube = alias_variable(alias_variable(cube, VARIABLE_ALIASES["era5_t2m"], "tas"), VARIABLE_ALIASES["era5_tp"], "pr")
    cube = nulls_for_nan(cube, VALUES)
    return cube.withColumns({"tas": kelvin_to_celsius(F.col("tas")), "pr": metres_to_mm(F.col("pr"))})


def read_target(raw: DataFrame, reference: Grid | None = None, years: tuple[int, int] = ALL_YEARS,
                validate: bool = True) -> DataFrame:
    """Reanalysis cube: converted, monthly, clipped and put on the reference grid.

    Temperatures of a month are averaged, precipitation is summed. Ranges, the period and the
    native grid come from one pass.
    """
    cube = convert_target(raw)
    if dict(cube.dtypes)["time"] == "string":
        cube = parse_times(cube, "time")
    found = survey(cube, RANGES["target"], inside=in_years(*years)) if validate or reference is not None else {}
    if validate:
        judge(found, "target")
    # Whole months lie on one side of a year's end, so the clip goes first and reaches the scan.
    monthly = resample_monthly(clip_years(cube, *years), {"tas": "mean", "pr": "sum"})
    if reference is None:
        return monthly
    return regrid(monthly, found[()].grid, reference, keys=("time", "year", "month"))


def _named_model(raw: DataFrame) -> DataFrame:
    """Standard names, NULL for NaN, and the time; a date that cannot exist is missing here."""
    cube = rename_coords(raw, MODEL_COORDS)
    cube = alias_variable(alias_variable(cube, VARIABLE_ALIASES["gcm_tas"], "tas"), VARIABLE_ALIASES["gcm_pr"], "pr")
    cube = nulls_for_nan(cube, VALUES)
    if "time" not in cube.columns:
        fields = [F.col(c) for c in ("year", "month", "day")]
        return cube.withColumn("time", from_fields(*fields, F.col("hour") if "hour" in cube.columns else None))
    return parse_times(cube, "time") if dict(cube.dtypes)["time"] == "string" else cube


def convert_model(raw: DataFrame, exact_days: bool = False) -> DataFrame:
    """Rename, decode the calendar and turn mm/day into mm/month.

    Times may be timestamps, text, or the fields year, month, day (and hour).
    Rows with fields that make no date are dropped; `model_check` counts them.
    """
    cube = _named_model(raw)
    if "time" not in raw.withColumnsRenamed(MODEL_COORDS).columns:
        cube = cube.filter(F.col("time").isNotNull())
    return cube.withColumn("pr", per_day_to_per_month(F.col("pr"), F.col("time"), exact_days))


def model_check(raw: DataFrame, years: tuple[int, int] = ALL_YEARS) -> DataFrame:
    """Per model and scenario, in one pass: rows, impossible dates, rows in the period, values outside the range, a status.

    `empty` is a dataset without rows in the period, `warning` one with values
    outside the (lenient) range, `ok` any other. Only historical rows are clipped.
    """
    cube = _named_model(raw).withColumn("pr", per_day_to_per_month(F.col("pr"), F.col("time"), False))
    dated = F.col("time").isNotNull()
    inside = dated & ((F.col("scenario") != HISTORICAL) | F.year("time").between(*years))
    out = cube.groupBy("model", "scenario").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~dated).alias("n_impossible"), F.count_if(inside).alias("n_in_period"),
        *[F.count_if(inside & ((F.col(v) < low) | (F.col(v) > high))).alias(f"n_outside_{v}")
          for v, (low, high, _) in RANGES["model"].items()],
    )
    outside = sum((F.col(f"n_outside_{v}") for v in RANGES["model"]), F.lit(0))
    return out.withColumn("status", F.when(F.col("n_in_period") == 0, "empty").when(outside > 0, "warning").otherwise("ok"))


def survey_models(raw: DataFrame, years: tuple[int, int] = ALL_YEARS, exact_days: bool = False) -> dict[tuple, Survey]:
    """Every (model, scenario) of the input: dates, period, lenient ranges and grid, from one pass."""
    cube = _named_model(raw)
    cube = cube.withColumn("pr", per_day_to_per_month(F.col("pr"), F.col("time"), exact_days))
    inside = F.col("time").isNotNull() & ((F.col("scenario") != HISTORICAL) | in_years(*years))
    return survey(cube, RANGES["model"], ("model", "scenario"), inside)


def grids_by_model(found: Mapping[tuple, Survey]) -> dict[str, Grid]:
    """The native grid of each model, over its scenarios."""
    out: dict[str, tuple[dict, dict]] = {}
    for (model, _), s in found.items():
        axes = out.setdefault(model, ({}, {}))
        for axis, values in zip(axes, (s.grid.lat, s.grid.lon)):
            for v in values:  # one coordinate per key, as in the survey
                key = round(v * MICRO)
                axis[key] = min(v, axis.get(key, v))
    return {model: Grid(*[tuple(sorted(a.values())) for a in axes]) for model, axes in out.items()}


def read_model(raw: DataFrame, reference: Grid | None = None, years: tuple[int, int] = ALL_YEARS,
               method: str = "bilinear", source_grids: Mapping[str, Grid] | None = None, validate: bool = True,
               duplicates: str = "error") -> DataFrame:
    """Climate-model cube of all models and scenarios in the input, in one plan.

    Only historical rows are clipped. Each model may have its own native grid.
    One pass before the plan finds the grids, warns of values outside the lenient ranges
    and of dates that cannot exist, and makes a model without rows in the period an error.
    Pass `source_grids` when they are known, to save it; without `reference` no
    pass is made. `duplicates='flag'` marks results that use a cell that stands twice instead of failing.
    """
    cube = conditional_clip(convert_model(raw), *years)
    if reference is None:
        return cube
    if source_grids is None:
        found = survey_models(raw, years)
        if validate:
            judge(found, "model")
        source_grids = grids_by_model(found)
    return regrid(cube, source_grids, reference, method, keys=("model", "scenario", "time"), grid_key="model", duplicates=duplicates)


def repeated_cells(cube: DataFrame, keys: Sequence[str] = ("model", "scenario")) -> DataFrame:
    """The datasets (keys) in which a cell stands twice at a time, with the number of such cells."""
    cells = cube.groupBy(*keys, "time", axis_key(F.col("lat")).alias("_lat"), axis_key(F.col("lon")).alias("_lon")).agg(
        F.count(F.lit(1)).alias("_rows"))
    return cells.filter("_rows > 1").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_repeated"))


def model_report(raw: DataFrame) -> DataFrame:
    """Lenient range report per model and scenario."""
    return validate_range(convert_model(raw), RANGES["model"], ("model", "scenario"))


def _hadoop(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _hadoop(spark, path)
    return fs.exists(jvm_path)


def siblings(spark: SparkSession, path: str) -> list[str]:
    """Names in the folder a path lies in."""
    folder, fs = _hadoop(spark, path.rstrip("/").rsplit("/", 1)[0] or "/")
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def first_existing(spark: SparkSession, candidates: Sequence[str]) -> str:
    """First candidate path that exists; the error names them and what is there instead."""
    found = next((p for p in candidates if path_exists(spark, p)), None)
    if found is None:
        raise FileNotFoundError(f"none of {list(candidates)} exist; available: {siblings(spark, candidates[0])}")
    return found


def read_processed(spark: SparkSession, candidates: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Processed cubes with standard variable names.

    `candidates` maps cru, era5 and gcm to the paths to try, in order.
    """
    out = {}
    for source, names in {"cru": ("cru_tmp", "cru_pre"), "era5": ("era5_t2m", "era5_tp"),
                          "gcm": ("gcm_tas", "gcm_pr")}.items():
        df = runs.read(spark, first_existing(spark, candidates[source]))
        for name in names:
            df = alias_variable(df, VARIABLE_ALIASES[name], name)
        out[source] = df
    return out


def read_future(spark: SparkSession, tas_path: str, pr_path: str,
                keys: Sequence[str] = ("model", "scenario")) -> DataFrame:
    """Two single-variable future cubes as scoring features, without a target."""
    tas = alias_variable(runs.read(spark, tas_path), VARIABLE_ALIASES["gcm_tas"], "gcm_tas_degC")
    pr = alias_variable(runs.read(spark, pr_path), VARIABLE_ALIASES["gcm_pr"], "gcm_pr_mm")
    return scoring_features(join_tas_pr(tas, pr, keys))
