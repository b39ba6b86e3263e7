"""One pass over a cube before it is used: rows, dates, ranges and axes of every dataset in it.

What a reader must know before its plan can be built (the native grid) and what
it must refuse or warn of (ranges, an empty period, dates that cannot exist)
comes from a single aggregate, grouped by dataset and coordinate. Its result has
one row per coordinate and is bounded.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from isohyet.functions.coords import axis_key
from isohyet.operators.grids import AXIS_LIMIT, Grid
from isohyet.operators.quality import DataQualityError

# Coordinates of all datasets together that may come to the driver.
ROW_LIMIT = 4 * AXIS_LIMIT


class DataQualityWarning(UserWarning):
    """A lenient rule is broken."""


@dataclass(frozen=True)
class Range:
    """One variable against its accepted range."""

    low: float
    high: float
    strict: bool
    n_missing: int
    n_outside: int
    min_value: float | None
    max_value: float | None
    mean_value: float | None

    def __str__(self) -> str:
        return (f"{self.n_outside} rows outside [{self.low}, {self.high}], "
                f"min {self.min_value}, max {self.max_value}, mean {self.mean_value}")


@dataclass(frozen=True)
class Survey:
    """What one dataset of a cube holds."""

    n_rows: int
    n_undated: int
    n_in_period: int
    ranges: Mapping[str, Range]
    grid: Grid

    @property
    def status(self) -> str:
        """`empty` (no rows in the period), `error` (strict rule broken), `warning` (lenient rule broken, or undated rows), `ok`."""
        outside = [r for r in self.ranges.values() if r.n_outside]
        if not self.n_in_period:
            return "empty"
        if any(r.strict for r in outside):
            return "error"
        return "warning" if outside or self.n_undated else "ok"


def values_of(seen: Observation) -> dict[str, object]:
    """What was observed; nothing where Spark left the observed part out of the plan because it had no rows."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def survey_rows(cube: DataFrame, rules: Mapping[str, tuple[float, float, bool]], keys: Sequence[str] = (),
                inside: Column | None = None) -> DataFrame:
    """One row per dataset (keys), axis and coordinate with the counts of its rows; the numbers stand at the latitudes."""
    inside = F.lit(True) if inside is None else F.coalesce(inside, F.lit(False))
    dated = F.col("time").isNotNull() if "time" in cube.columns else F.lit(True)
    rows = cube.select(*keys, *rules, dated.alias("_dated"), inside.alias("_inside"), F.explode(F.array(*[
        F.struct(F.lit(axis).alias("axis"), F.col(axis).cast("double").alias("value"), F.lit(axis == "lat").alias("first"))
        for axis in ("lat", "lon")])).alias("_p"))
    first = F.col("_p.first")
    counts = []
    for name, (low, high, _) in rules.items():
        v = F.when(first, F.col(name))
        counts += [F.min(v).alias(f"{name}__min"), F.max(v).alias(f"{name}__max"), F.sum(v).alias(f"{name}__sum"),
                   F.count(v).alias(f"{name}__n"), F.count_if((v < low) | (v > high)).alias(f"{name}__outside")]
    return rows.groupBy(*keys, F.col("_p.axis").alias("axis"), axis_key(F.col("_p.value")).alias("key")).agg(
        F.min("_p.value").alias("value"), F.min(F.when(F.col("_inside"), F.col("_p.value"))).alias("value_inside"),
        F.count_if(first).alias("rows"), F.count_if(first & ~F.col("_dated")).alias("undated"),
        F.count_if(first & F.col("_inside")).alias("in_period"), *counts)


def survey(cube: DataFrame, rules: Mapping[str, tuple[float, float, bool]], keys: Sequence[str] = (),
           inside: Column | None = None, axes_inside: bool = False) -> dict[tuple, Survey]:
    """Every dataset (a tuple of keys) of a cube, from one job.

    `inside` tells which rows lie in the requested period; with `axes_inside` they alone make the grid.
    Without keys an empty cube gives one empty survey.
    """
    table = survey_rows(cube, rules, keys, inside).limit(ROW_LIMIT + 1).toArrow()
    if len(table) > ROW_LIMIT:
        raise ValueError("too many distinct coordinates: not rectilinear grids")
    groups: dict[tuple, list[dict]] = {} if keys else {(): []}
    for row in table.to_pylist():
        groups.setdefault(tuple(row[k] for k in keys), []).append(row)
    return {key: _summary(rows, rules, axes_inside) for key, rows in groups.items()}


def _summary(rows: Sequence[Mapping], rules: Mapping[str, tuple[float, float, bool]], axes_inside: bool) -> Survey:
    total = {name: sum(r[name] for r in rows) for name in ("rows", "undated", "in_period")} if rows else dict.fromkeys(("rows", "undated", "in_period"), 0)
    ranges = {}
    for name, (low, high, strict) in rules.items():
        n = sum(r[f"{name}__n"] for r in rows)
        lows, highs = ([r[f"{name}__{w}"] for r in rows if r[f"{name}__{w}"] is not None] for w in ("min", "max"))
        ranges[name] = Range(low, high, strict, total["rows"] - n, sum(r[f"{name}__outside"] for r in rows), min(lows, default=None),
                             max(highs, default=None), sum(r[f"{name}__sum"] or 0.0 for r in rows) / n if n else None)
    column = "value_inside" if axes_inside else "value"
    axes = [tuple(sorted(r[column] for r in rows if r["axis"] == a and r[column] is not None)) for a in ("lat", "lon")]
    return Survey(total["rows"], total["undated"], total["in_period"], ranges, Grid(*axes))


def judge(found: Mapping[tuple, Survey], what: str, empty: str = "error") -> None:
    """Raise on broken strict rules and on datasets without rows in the period, warn of the rest; all are named.

    `empty='warn'` only warns of empty datasets, for callers that go on with the others.
    """
    errors, notes = [], []
    for key, s in found.items():
        name = " ".join([what, *map(str, key)])
        if not s.n_in_period:
            (errors if empty == "error" else notes).append(f"{name}: no rows in the requested period")
        for variable, r in s.ranges.items():
            if r.n_outside:
                (errors if r.strict else notes).append(f"{name}: {variable}: {'error' if r.strict else 'warning'}, {r}")
        if s.n_undated:
            notes.append(f"{name}: {s.n_undated} of {s.n_rows} rows have no possible date")
    if not found:
        errors.append(f"{what}: no rows in the requested period")
    if errors:
        raise DataQualityError("; ".join(errors))
    for note in notes:
        warnings.warn(note, DataQualityWarning, stacklevel=3)
