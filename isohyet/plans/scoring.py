"""Scenario scoring: all models and scenarios in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.constants import FUTURE_SCENARIOS, MODELS
from isohyet.operators.align import complete_models, job_matrix
from isohyet.operators.ensemble import ensemble_stats
from isohyet.operators.features import scoring_features
from isohyet.operators.grids import Grid
from isohyet.operators.learning import ModelSet, score
from isohyet.operators.regrid import to_grid
from isohyet.sources import manifest as manifest_table
from isohyet.sources.cubes import read_model, repeated_cells
from isohyet.sources.sinks import read_table, write_downscaled, write_table

KEYS = ("model", "scenario", "time")


def downscale(raw: DataFrame, models: ModelSet, grid: Grid, source_grids: dict[str, Grid] | None = None) -> DataFrame:
    """Raw model cells to dense predictions (model, scenario, time, lat, lon, pred_tas, pred_pr).

    Every time step of the input appears; the steps come from the raw scan.
    """
    steps = read_model(raw).select(*KEYS).distinct()
    return score_cube(read_model(raw, grid, source_grids=source_grids), models, grid, steps)


def score_cube(cube: DataFrame, models: ModelSet, grid: Grid, steps: DataFrame | None = None) -> DataFrame:
    """Score a cube that is on the target grid. Cells without both predictors stay missing."""
    features = scoring_features(cube.withColumnsRenamed({"tas": "gcm_tas_degC", "pr": "gcm_pr_mm"}))
    known = features.na.drop(subset=["gcm_tas_degC", "gcm_pr_log1p"])
    return to_grid(score(known, models), grid, ("pred_tas", "pred_pr"), KEYS, steps)


def diagnostics(raw: DataFrame, downscaled: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Spatial means of the raw and the downscaled fields, on the union of their times."""
    before = raw.groupBy(*keys).agg(F.avg("tas").alias("raw_tas"), F.avg("pr").alias("raw_pr"))
    after = downscaled.groupBy(*keys).agg(
        F.avg("pred_tas").alias("downscaled_tas"), F.avg("pred_pr").alias("downscaled_pr")
    )
    return before.join(after, list(keys), "full_outer")


def ensemble_of(downscaled: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Ensemble mean and spread over the models with both variables."""
    rows = downscaled.select("model", "scenario", "time", "lat", "lon", F.col("pred_tas").alias("tas"),
                             F.col("pred_pr").alias("pr"))
    if manifest is not None:
        rows = rows.join(complete_models(manifest), ["model", "scenario"], "left_semi")
    return ensemble_stats(rows, keys=("scenario", "time", "lat", "lon"))


def downscale_all(spark: SparkSession, raw: DataFrame, models: ModelSet, grid: Grid, output: str,
                  names: Sequence[str] = MODELS, scenarios: Sequence[str] = FUTURE_SCENARIOS) -> DataFrame:
    """Score, store and combine every requested pair; returns the status per pair.

    One job scores all pairs. A pair without input or with repeated cells is
    logged as failed and does not stop the others; an error of the job itself is
    logged for the pairs it was to make. Statuses are those of this run: what an
    older one has stored counts for nothing. The ensemble uses complete pairs only, and
    has no rows when no stored pair is complete.
    """
    jobs = job_matrix(spark, names, scenarios)
    wanted = raw.filter(F.col("model").isin(*names) & F.col("scenario").isin(*scenarios))
    cube = read_model(wanted)
    # Both have at most one row per requested pair.
    found = cube.select("model", "scenario").distinct()
    repeated = repeated_cells(cube)
    plan = spark.createDataFrame(jobs.join(found.withColumn("_found", F.lit(True)), ["model", "scenario"], "left").join(
        repeated, ["model", "scenario"], "left").select("model", "scenario", F.when(
            F.col("_found").isNull(), "no input").when(F.col("n_repeated").isNotNull(), F.concat_ws(
                " ", "n_repeated", F.lit("cells stand twice"))).alias("error")).toArrow(), "model string, scenario string, error string")
    ready = plan.filter("error is null").select("model", "scenario")
    status, broken, rows = plan.withColumn("status", F.lit("failed")), None, None
    if not ready.isEmpty():
        good = wanted.join(F.broadcast(ready), ["model", "scenario"], "left_semi")
        try:
            write_downscaled(downscale(good, models, grid), output, models.paths, models.temperature.algorithm, ready)
        except Exception as error:
            broken = str(error)
        else:
            # The stored predictions feed the rest, so nothing is scored twice.
            stored = read_table(spark, f"{output}/data").withColumnsRenamed({"tas": "pred_tas", "pr": "pred_pr"})
            rows = stored.join(F.broadcast(ready), ["model", "scenario"], "left_semi")
            outputs = rows.groupBy("model", "scenario").agg(F.count("pred_tas").alias("n_tas"), F.count("pred_pr").alias("n_pr"))
            whole = F.coalesce(F.col("error").isNull() & (F.col("n_tas") > 0) & (F.col("n_pr") > 0), F.lit(False))
            status = plan.join(outputs, ["model", "scenario"], "left").select(
                "model", "scenario", F.when(~whole, F.coalesce("error", F.lit("no predicted values"))).alias("error"),
                F.when(whole, "completed").otherwise("failed").alias("status"))
    if broken:
        status = status.withColumn("error", F.coalesce("error", F.lit(broken)))
    log = spark.createDataFrame(status.select("model", "scenario", "status", "error").toArrow(),
                                "model string, scenario string, status string, error string")
    entries = [(f"{r['model']}_{r['scenario']}", "downscale", r["status"], r["error"]) for r in log.collect()]
    manifest_table.record(spark, f"{output}/manifest", entries)
    complete = log.filter(F.col("status") == "completed").select("model", "scenario")
    if rows is not None:
        # At most one row per requested pair, so the semi join does not shuffle a large model.
        write_table(ensemble_of(rows.join(F.broadcast(complete), ["model", "scenario"], "left_semi")), f"{output}/ensemble", ("scenario",))
    return log
