"""Multi-model statistics and change signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isohyet.constants import ALL_YEARS, FUTURE_YEARS, HISTORICAL
from isohyet.functions.coords import aggregate_cells

VALUES = ("tas", "pr")


def ensemble_stats(df: DataFrame, values: Sequence[str] = VALUES,
                   keys: Sequence[str] = ("scenario", "year", "month", "lat", "lon")) -> DataFrame:
    """Mean and population standard deviation over models, missing values left out.

    n_models counts the models that have a value.
    """
    return aggregate_cells(
        df, keys, F.count_if(F.coalesce(*values).isNotNull()).alias("n_models"),
        *[F.avg(v).alias(f"{v}_mean") for v in values], *[F.stddev_pop(v).alias(f"{v}_std") for v in values],
    )


def ensemble_mean(df: DataFrame, values: Sequence[str] = VALUES,
                  keys: Sequence[str] = ("scenario", "year", "month", "lat", "lon")) -> DataFrame:
    return aggregate_cells(df, keys, *[F.avg(v).alias(v) for v in values])


def ensemble_std(df: DataFrame, values: Sequence[str] = VALUES,
                 keys: Sequence[str] = ("scenario", "year", "month", "lat", "lon")) -> DataFrame:
    return aggregate_cells(df, keys, *[F.stddev_pop(v).alias(v) for v in values])


def change_signal(ensemble: DataFrame, future: tuple[int, int] = FUTURE_YEARS,
                  base: tuple[int, int] = ALL_YEARS) -> DataFrame:
    """Change of each scenario against the historical period.

    `ensemble` holds tas_mean, pr_mean, tas_std, pr_std per scenario, time and
    cell. The base period is taken from historical rows. Temperature changes
    are differences; precipitation also gets a percentage of the base.
    """
    in_future = F.col("year").between(*future) & (F.col("scenario") != HISTORICAL)
    in_base = F.col("year").between(*base) & (F.col("scenario") == HISTORICAL)
    per_scenario = ensemble.groupBy("scenario").agg(
        *[F.avg(F.when(in_future, F.col(f"{v}_mean"))).alias(f"future_{v}") for v in VALUES],
        *[F.avg(F.when(in_base, F.col(f"{v}_mean"))).alias(f"base_{v}") for v in VALUES],
        *[F.avg(f"{v}_std").alias(f"spread_{v}") for v in VALUES],
    )
    # One row per scenario: a window over all of them spreads the historical base.
    every = Window.partitionBy()
    out = per_scenario.withColumns({
        f"base_{v}": F.max(F.when(F.col("scenario") == HISTORICAL, F.col(f"base_{v}"))).over(every) for v in VALUES
    }).filter(F.col("scenario") != HISTORICAL)
    return out.select(
        "scenario",
        *[F.col(f"{p}_{v}") for v in VALUES for p in ("base", "future")],
        *[(F.col(f"future_{v}") - F.col(f"base_{v}")).alias(f"change_{v}") for v in VALUES],
        F.try_divide((F.col("future_pr") - F.col("base_pr")) * 100.0, F.col("base_pr")).alias("change_percent_pr"),
        *[F.col(f"spread_{v}") for v in VALUES],
    )
