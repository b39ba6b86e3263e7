"""Features, splits and samples of the training table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet.constants import (
    FEATURE_SETS, TEST_YEARS, TRAIN_YEARS, VALIDATION_YEARS,
)
from isohyet.functions.calendar import month_cos, month_sin
from isohyet.functions.statistics import share

SPLITS = {"train": TRAIN_YEARS, "validation": VALIDATION_YEARS, "test": TEST_YEARS}


def add_calendar_features(df: DataFrame, time: str = "time") -> DataFrame:
    """year, month and the cyclic encoding of the month."""
    month = F.month(time)
    return df.withColumns({
        "year": F.year(time), "month": month,
        "month_sin": month_sin(month), "month_cos": month_cos(month),
    })


def add_log_features(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """log1p of precipitation columns; `names` maps source to result column."""
    names = names or {"era_tp_mm": "era_tp_log1p", "gcm_pr_mm": "gcm_pr_log1p"}
    return df.withColumns({out: F.log1p(F.col(src)) for src, out in names.items()})


def prepare_features(tas: DataFrame, pr: DataFrame, keys: Sequence[str] = ("model", "scenario")) -> DataFrame:
    """Scoring features from two single-variable cubes of the same models."""
    from isohyet.operators.align import join_tas_pr

    return scoring_features(join_tas_pr(tas, pr, keys))


def scoring_features(cube: DataFrame) -> DataFrame:
    """Scoring features of a cube that already holds both variables."""
    return add_log_features(add_calendar_features(cube), {"gcm_pr_mm": "gcm_pr_log1p"})


def feature_target(df: DataFrame, model_type: str) -> DataFrame:
    """The ordered features and the target of one model type."""
    if model_type not in FEATURE_SETS:
        raise ValueError(f"unknown model_type: {model_type}")
    features, target = FEATURE_SETS[model_type]
    return df.select(*features, target)


def split_by_year(df: DataFrame, splits: dict[str, tuple[int, int]] | None = None,
                  year: str = "year", keep_unassigned: bool = False) -> DataFrame:
    """A `split` column from inclusive year ranges; other rows belong to none."""
    chosen = F.lit(None).cast("string")
    for name, (first, last) in reversed(list((splits or SPLITS).items())):
        chosen = F.when(F.col(year).between(first, last), F.lit(name)).otherwise(chosen)
    out = df.withColumn("split", chosen)
    return out if keep_unassigned else out.filter(F.col("split").isNotNull())


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def wet_only(df: DataFrame, target: str = "era_tp_mm") -> DataFrame:
    return df.filter(F.col(target) > 0)


def wet_share(df: DataFrame, target: str = "era_tp_mm", keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(share(F.col(target) > 0).alias("wet_share"))


# Hash digits by which counts are refined, and hashes that may come to the driver.
DIGITS, HASH_LIMIT = 4, 100_000


def _hash(keys: Sequence[str], seed: int) -> Column:
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.md5(text)


def _share_below(fraction: Column, keys: Sequence[str], seed: int) -> Column:
    """Whether a row's hash lies in the first `fraction` of all hashes: the first 8 hex digits of an MD5 of its keys."""
    return F.conv(F.substring(_hash(keys, seed), 1, 8), 16, 10).cast("long") < fraction * float(1 << 32)


def sample_rows(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """A fraction of the rows by a hash of their keys.

    The same rows are taken whatever the partitioning, and with no shuffle.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie in [0, 1]")
    return df.filter(_share_below(F.lit(float(fraction)), keys, seed))


def sample_splits(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly `fraction` of train, at least a fifth of validation, all of test."""
    if fraction >= 1:
        return df
    return sample_exact(df, {"train": fraction, "validation": max(fraction, 0.2)}, keys, seed)


def sample_exact(df: DataFrame, fractions: dict[str, float], keys: Sequence[str], seed: int = 42, by: str = "split") -> DataFrame:
    """round(fraction * n) rows of each group of `by` that `fractions` names (halves to even); all rows of the others.

    The rows with the smallest hashes of their keys are taken, so the sample is the same under any
    partitioning. The last hash taken is found by counts of hash prefixes, refined until few
    hashes are left; nothing is sorted or shuffled by row. Of rows with equal keys at the border some are taken.
    """
    if any(not 0 <= f <= 1 for f in fractions.values()):
        raise ValueError("fractions must lie in [0, 1]")
    hashed = df.withColumn("_hash", _hash(keys, seed))
    borders = _borders(hashed, fractions, by)
    below, at = F.lit(False), F.lit(False)
    for group, (last, _) in borders.items():
        below |= (F.col(by) == group) & (F.col("_hash") < last)
        at |= (F.col(by) == group) & (F.col("_hash") == last)
    other = ~F.coalesce(F.col(by).isin(*fractions), F.lit(False))
    taken = hashed.filter(other | below)
    # Rows of one key per group.
    order = Window.partitionBy(by).orderBy(F.xxhash64(*df.columns))
    need = F.lit(0)
    for group, (_, n) in borders.items():
        need = F.when(F.col(by) == group, n).otherwise(need)
    edge = hashed.filter(at).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= need).drop("_n")
    return taken.unionByName(edge).drop("_hash")


def _borders(hashed: DataFrame, fractions: dict[str, float], by: str) -> dict[str, tuple[str, int]]:
    """The largest hash taken of each group and how many rows with it are taken. Groups of which none is taken are left out."""
    state: dict[str, tuple[str, int]] = {}  # the prefix that holds the border, and the rows to take below it
    out: dict[str, tuple[str, int]] = {}
    digits, totals = 0, {}
    while True:
        open_ = {g: s for g, s in state.items() if g not in out}
        if digits and not open_:
            return out
        inside = F.col(by).isin(*fractions)
        if digits:
            inside = F.lit(False)
            for group, (prefix, _) in open_.items():
                inside |= (F.col(by) == group) & F.col("_hash").startswith(prefix)
        few = digits > 0 and all(totals[g] <= HASH_LIMIT for g in open_)
        width = 32 if few else min(digits + DIGITS, 32)
        rows = hashed.filter(inside).groupBy(by, F.substring("_hash", 1, width).alias("_prefix")).count().collect()
        counts: dict[str, list] = {}
        for r in rows:
            counts.setdefault(r[by], []).append((r["_prefix"], r["count"]))
        for group in open_ if digits else fractions:
            own = sorted(counts.get(group, []))
            need = open_[group][1] if digits else round(fractions[group] * sum(n for _, n in own))
            if not need:
                continue
            for prefix, n in own:
                if need <= n:
                    break
                need -= n
            state[group], totals[group] = (prefix, need), n
            if width == 32:
                out[group] = (prefix, need)
        digits = width
