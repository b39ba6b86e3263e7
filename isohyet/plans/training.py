"""Training table and model training."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from isohyet.functions.coords import with_keys
from isohyet.operators.align import align
from isohyet.operators.features import (
    add_calendar_features, add_log_features, sample_splits, split_by_year,
)
from isohyet.operators.learning import (
    PATIENCE, SUFFIX, DownscalingModel, ModelSet, evaluate_two_stage, fit_amount, fit_occurrence, fit_precip, fit_temperature,
)
from isohyet.operators.naming import rename_training
from isohyet.operators.quality import drop_missing
from isohyet.sources.survey import values_of
from isohyet.sources.sinks import read_split, write_metrics, write_table


def aligned_table(reference: DataFrame, target: DataFrame, model: DataFrame, mode: str = "month") -> DataFrame:
    """Reference, target and model cubes side by side under their training names."""
    def named(df: DataFrame, tas: str, pr: str) -> tuple[DataFrame, list[str]]:
        return df.withColumnsRenamed({"tas": tas, "pr": pr}), [tas, pr]

    joined = align([
        named(reference, "cru_tmp", "cru_pre"), named(target, "era5_t2m", "era5_tp"), named(model, "gcm_tas", "gcm_pr"),
    ], mode=mode)
    return rename_training(joined)


def training_table(reference: DataFrame, target: DataFrame, model: DataFrame, mode: str = "month",
                   splits: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """Features, targets and split of one model; rows that miss a core value are dropped."""
    rows = add_log_features(add_calendar_features(aligned_table(reference, target, model, mode)))
    return split_by_year(drop_missing(rows), splits, keep_unassigned=True)


def save_training_table(table: DataFrame, path: str) -> None:
    """Store the table by split and year; warns when the sources had nothing in common."""
    seen = Observation()
    write_table(table.observe(seen, F.count(F.lit(1)).alias("n_rows")), path, ("split", "year"))
    if not values_of(seen).get("n_rows"):
        warnings.warn("the training table is empty: its sources share no time, month or cell", stacklevel=2)


def train_two_stage(table: DataFrame, output: str, algorithm: str = "auto",
                    hyperparams: Mapping[str, Mapping] | None = None, early_stopping: bool = True,
                    patience: int = PATIENCE) -> tuple[DownscalingModel, DownscalingModel]:
    """Occurrence and amount models, saved with the metrics of their product.

    Boosted trees stop early on the validation rows, by patience, unless told otherwise.
    """
    params, stop = hyperparams or {}, {"early_stopping": early_stopping, "patience": patience}
    occurrence = fit_occurrence(table, algorithm, params.get("precipitation_occurrence"), **stop)
    amount = fit_amount(table, algorithm, params.get("precipitation"), **stop)
    occurrence.save(f"{output}/{occurrence.algorithm}_pr_occ")
    amount.save(f"{output}/{amount.algorithm}_pr_amt")
    pair = ModelSet(temperature=None, occurrence=occurrence, amount=amount)
    write_metrics(evaluate_two_stage(table.filter(F.col("split") == "test"), pair), f"{output}/precip_two_stage_metrics")
    return occurrence, amount


def train_all(spark: SparkSession, data: str, output: str, algorithm: str = "auto", two_stage: bool = True,
              sample_fraction: float = 1.0, hyperparams: Mapping[str, Mapping] | None = None,
              early_stopping: bool = True, patience: int = PATIENCE) -> ModelSet:
    """Temperature and precipitation models from the stored training table.

    Boosted trees stop early on the validation rows unless told otherwise.
    The table is read once and kept for the fits, on disk where memory is short.
    """
    params = hyperparams or {}
    table = with_keys(read_split(spark, data)).filter(F.col("split").isNotNull())
    table = sample_splits(table, sample_fraction, ["year", "month", "lat_key", "lon_key"]).persist()
    try:
        stop = {"early_stopping": early_stopping, "patience": patience}
        temperature = fit_temperature(table, algorithm, params.get("temperature"), **stop)
        temperature.save(f"{output}/{temperature.algorithm}_{SUFFIX['temperature']}")
        if two_stage:
            occurrence, amount = train_two_stage(table, output, algorithm, params, **stop)
            return ModelSet(temperature, None, occurrence, amount)
        single = fit_precip(table, algorithm, params.get("precipitation"), **stop)
        single.save(f"{output}/{single.algorithm}_{SUFFIX['precipitation']}")
        return ModelSet(temperature, single)
    finally:
        table.unpersist()
