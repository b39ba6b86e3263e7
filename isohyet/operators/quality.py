"""Range validation, missing-value rules and their reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.constants import CORE_COLUMNS
from isohyet.functions.units import (
    flux_to_per_month, kelvin_to_celsius, metres_to_mm,
)


class DataQualityError(ValueError):
    """Raised when a strict rule is broken."""


def validate_range(df: DataFrame, rules: Mapping[str, tuple[float, float, bool]],
                   keys: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, variable) with min, max, mean and a status.

    Statuses: `empty` (no rows), `error` (strict rule broken), `warning`
    (lenient rule broken), `ok`. All variables are read in one pass.
    """
    parts = []
    for name, (low, high, _) in rules.items():
        c = F.col(name)
        parts += [
            F.min(c).alias(f"{name}__min"), F.max(c).alias(f"{name}__max"),
            F.avg(c).alias(f"{name}__mean"),
            F.count_if(c.isNull()).alias(f"{name}__missing"),
            F.count_if((c < low) | (c > high)).alias(f"{name}__outside"),
        ]
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *parts)
    records = F.array(*[
        F.struct(
            F.lit(name).alias("variable"), F.lit(float(low)).alias("low"),
            F.lit(float(high)).alias("high"), F.lit(strict).alias("strict"),
            F.col(f"{name}__min").alias("min_value"), F.col(f"{name}__max").alias("max_value"),
            F.col(f"{name}__mean").alias("mean_value"),
            F.col(f"{name}__missing").alias("n_missing"),
            F.col(f"{name}__outside").alias("n_outside"),
        )
        for name, (low, high, strict) in rules.items()
    ])
    rows = stats.select(*keys, "n_rows", F.explode(records).alias("r")).select(*keys, "n_rows", "r.*")
    status = (
        F.when(F.col("n_rows") == 0, "empty")
        .when((F.col("n_outside") > 0) & F.col("strict"), "error")
        .when(F.col("n_outside") > 0, "warning")
        .otherwise("ok")
    )
    return rows.withColumn("status", status)


def enforce(report: DataFrame) -> None:
    """Raise on strict violations or an empty dataset, naming all of them; the report has a row per dataset and variable."""
    bad = report.filter(F.col("status").isin("error", "empty")).collect()
    if bad:
        lines = [
            f"{r['variable']}: {r['status']}, {r['n_outside']} of {r['n_rows']} rows outside "
            f"[{r['low']}, {r['high']}], min {r['min_value']}, max {r['max_value']}, mean {r['mean_value']}"
            for r in bad
        ]
        raise DataQualityError("; ".join(lines))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The DataFrame itself, or an error when a clip has left nothing."""
    if df.isEmpty():
        raise DataQualityError(f"{what}: no rows in the requested period")
    return df


def guarded_convert(df: DataFrame, kind: str, keys: Sequence[str],
                    tas: str = "tas", pr: str = "pr") -> DataFrame:
    """Convert units only where the largest value of a dataset says so.

    Temperature above 100 is Kelvin. Precipitation below 10 is metres for
    `kind='target'`; below 1 it is a flux for `kind='model'`.
    """
    if kind not in ("target", "model"):
        raise ValueError(f"unknown kind: {kind}")
    limit, convert = (10.0, metres_to_mm) if kind == "target" else (1.0, flux_to_per_month)
    peaks = df.groupBy(*keys).agg(F.max(tas).alias("_tas_max"), F.max(pr).alias("_pr_max"))
    if keys:
        renamed = peaks.withColumnsRenamed({k: f"_key_{k}" for k in keys})
        joined = df.join(renamed, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]).drop(*[f"_key_{k}" for k in keys])
    else:
        joined = df.withColumns({c: peaks.select(c).scalar() for c in peaks.columns})
    return joined.withColumns({
        tas: F.when(F.col("_tas_max") > 100, kelvin_to_celsius(F.col(tas))).otherwise(F.col(tas)),
        pr: F.when(F.col("_pr_max") < limit, convert(F.col(pr))).otherwise(F.col(pr)),
    }).drop("_tas_max", "_pr_max")


def drop_missing(df: DataFrame, columns: Sequence[str] = CORE_COLUMNS) -> DataFrame:
    """Drop rows that miss a core column; other columns may stay missing."""
    return df.na.drop(subset=list(columns))


def drop_report(df: DataFrame, columns: Sequence[str] = CORE_COLUMNS) -> DataFrame:
    """Rows before and after the drop and the share dropped, in percent."""
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(name).isNull() | F.isnan(F.coalesce(F.col(name).cast("double"), F.lit(0.0)))
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(missing).alias("rows_dropped")
    )
    return counts.select(
        "rows_before",
        (F.col("rows_before") - F.col("rows_dropped")).alias("rows_after"),
        "rows_dropped",
        F.try_divide(F.col("rows_dropped") * 100.0, F.col("rows_before")).alias("percent_dropped"),
    )


def pairwise_valid(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows where both sides are present."""
    return df.na.drop(subset=[first, second])
