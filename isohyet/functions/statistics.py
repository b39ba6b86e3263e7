"""Aggregate expressions with the guards the metrics need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def both(x: Column, y: Column) -> Column:
    return x.isNotNull() & y.isNotNull()


# Relative spread below which values differ by the rounding of their sums alone.
FLAT = 1e-12


def _flat(x: Column) -> Column:
    """Whether values are one value up to rounding; never for NaN or infinite ones."""
    spread = F.stddev_pop(x)
    return (spread <= F.max(F.abs(x)) * FLAT) & ~F.isnan(spread)


def correlation(x: Column, y: Column) -> Column:
    """Pearson over complete pairs; NULL when a side does not vary.

    A side whose values are sums or means of one value differs in their last bits, by the order
    of the rows; it counts as constant. The built-in corr raises a division error for a constant side.
    """
    ok = both(x, y)
    px, py = F.when(ok, x), F.when(ok, y)
    spread = F.stddev_pop(px) * F.stddev_pop(py)
    return F.when(~(_flat(px) | _flat(py)), F.covar_pop(px, py) / F.nullif(spread, F.lit(0.0)))


def rmse(pred: Column, obs: Column) -> Column:
    d = pred - obs
    return F.sqrt(F.avg(d * d))


def mae(pred: Column, obs: Column) -> Column:
    return F.avg(F.abs(pred - obs))


def bias(pred: Column, obs: Column) -> Column:
    return F.avg(pred - obs)


def r_squared(pred: Column, obs: Column) -> Column:
    """1 - SSres/SStot. With a constant truth: 1 if every error is 0, else 0."""
    ok = both(pred, obs)
    truth = F.when(ok, obs)
    d = pred - obs
    residual = F.sum(d * d)
    total = F.count(truth) * F.var_pop(truth)
    return F.when(
        total == 0, F.when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    ).otherwise(1 - residual / F.nullif(total, F.lit(0.0)))


def share(condition: Column) -> Column:
    """Share of rows that meet the condition; rows with no answer are left out."""
    return F.avg(F.when(condition, 1.0).when(~condition, 0.0))
