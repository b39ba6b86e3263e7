"""Alignment joins and set operations on cubes.

All joins are equi joins on integers and timestamps: cells join by their
integer axis keys (micro-degrees).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.constants import FUTURE_SCENARIOS, MODELS
from isohyet.functions.calendar import month_start
from isohyet.functions.coords import pack_keys, with_keys
from isohyet.operators.sizing import fail_when, one_per_key
from isohyet.operators.temporal import add_calendar


AXIS_KEYS = ("lat_key", "lon_key")
# The band adds nothing to the keys; it lets a regridded cube, hashed by its bands, stay where it is.
CELL_KEYS = ("lat_band", *AXIS_KEYS)


def align_exact(frames: Sequence[tuple[DataFrame, Sequence[str]]], keys: Sequence[str] = ()) -> DataFrame:
    """Inner join of cubes on exact time and cell.

    Each entry is (cube, value columns); variables of one source travel in one
    cube, so six variables of three sources need two joins. Coordinates are the
    first cube's.
    """
    on = [*keys, "time", *CELL_KEYS]
    first, values = frames[0]
    head = with_keys(first).select(*on, "lat", "lon", *values)
    rest = [with_keys(df).select(*on, *names) for df, names in frames[1:]]
    return reduce(lambda a, b: a.join(b, on), rest, head)


def align_month(frames: Sequence[tuple[DataFrame, Sequence[str]]], keys: Sequence[str] = (),
                duplicates: str = "error") -> DataFrame:
    """Inner join on (year, month, cell), stamped with the first of the month.

    Sources stamp months on different days, so this is the default alignment.
    Year and month come from the cube where it has them, else from its time.
    A second row for a month and cell is an error; `duplicates='all'` joins
    every combination instead.
    """
    if duplicates not in ("error", "all"):
        raise ValueError(f"unknown duplicates rule: {duplicates}")
    on = [*keys, "year", "month", *CELL_KEYS]

    def prepared(df: DataFrame, names: Sequence[str], what: str) -> DataFrame:
        rows = with_keys(df if {"year", "month"} <= set(df.columns) else add_calendar(df))
        rows = rows.filter(F.col("year").isNotNull()).select(*on, *names)
        return one_per_key(rows, on, list(names), what) if duplicates == "error" else rows

    first, values = frames[0]
    head = prepared(first, ["lat", "lon", *values], "source 1")
    rest = [prepared(df, names, f"source {i}") for i, (df, names) in enumerate(frames[1:], start=2)]
    joined = reduce(lambda a, b: a.join(b, on), rest, head)
    return joined.withColumn("time", month_start(F.col("year"), F.col("month")))


def _grown(i: int):
    """A tuple of rows with each row of source i that has its time."""
    def grown(t: Column) -> Column:
        same = F.filter(F.col(f"_rows_{i}"), lambda r: r["time"] == t["r0"]["time"])
        return F.transform(same, lambda r: F.struct(*[t[f"r{k}"].alias(f"r{k}") for k in range(i)], r.alias(f"r{i}")))

    return grown


def align_auto(frames: Sequence[tuple[DataFrame, Sequence[str]]], keys: Sequence[str] = ()) -> DataFrame:
    """Exact matches; months only when there is none in the whole input. One plan, no job of its own.

    Every source is gathered once by (keys, year, month, cell), the rows of a month
    side by side, and joined once. Exact matches are found inside the joined months by their times, and
    one flag over all of them picks the branch; Spark reuses the shuffles for it.
    In the month branch a second row for a month and cell is an error.
    """
    on = [*keys, "year", "month", *CELL_KEYS]

    def months(df: DataFrame, names: Sequence[str], i: int) -> DataFrame:
        rows = with_keys(df if {"year", "month"} <= set(df.columns) else add_calendar(df)).filter(
            F.col("year").isNotNull() & F.col("time").isNotNull())
        return rows.groupBy(*on).agg(F.collect_list(F.struct("time", "lat", "lon", *names)).alias(f"_rows_{i}"))

    sides = [months(df, names, i) for i, (df, names) in enumerate(frames)]
    joined = reduce(lambda a, b: a.join(b, on), sides)
    # Tuples (r0, r1, ...) of rows with one time, grown source by source.
    exact = F.transform("_rows_0", lambda r: F.struct(r.alias("r0")))
    for i in range(1, len(frames)):
        exact = F.flatten(F.transform(exact, _grown(i)))
    # Exact tuples alone decide, so the flag's branch of the plan ends there.
    matched = joined.select(*on, exact.alias("_exact"), *[f"_rows_{i}" for i in range(len(frames))])
    found = F.coalesce(matched.agg(F.max(F.size("_exact") > 0)).scalar(), F.lit(False))
    single = [fail_when(F.size(f"_rows_{i}") > 1, f"source {i + 1}: more than one row for a key of ({', '.join(on)})",
                        F.get(f"_rows_{i}", F.lit(0))).alias(f"r{i}") for i in range(len(frames))]
    chosen = F.when(F.col("_found"), F.col("_exact")).otherwise(F.array(F.struct(*single)))
    rows = matched.withColumn("_found", found).select(*on, "_found", F.explode(chosen).alias("_t"))
    stamp = F.when(F.col("_found"), F.col("_t.r0.time")).otherwise(month_start(F.col("year"), F.col("month")))
    values = [F.col(f"_t.r{i}")[n].alias(n) for i, (_, names) in enumerate(frames) for n in names]
    return rows.select(*keys, stamp.alias("time"), *CELL_KEYS, "year", "month", F.col("_t.r0.lat").alias("lat"), F.col("_t.r0.lon").alias("lon"), *values)


def align(frames: Sequence[tuple[DataFrame, Sequence[str]]], keys: Sequence[str] = (),
          mode: str = "month") -> DataFrame:
    """`month` (default), `exact`, or `auto`: months only when exact finds nothing."""
    ways = {"month": align_month, "exact": align_exact, "auto": align_auto}
    if mode not in ways:
        raise ValueError(f"unknown mode: {mode}")
    return ways[mode](frames, keys)


def join_tas_pr(tas: DataFrame, pr: DataFrame, keys: Sequence[str] = ("model", "scenario"),
                tas_name: str = "gcm_tas_degC", pr_name: str = "gcm_pr_mm") -> DataFrame:
    """Two single-variable cubes of the same models to one cube."""
    return align_exact([(tas, [tas_name]), (pr, [pr_name])], keys)


def align_pred_obs(pred: DataFrame, obs: DataFrame, variables: Sequence[str] = ("tas", "pr"),
                   on: Sequence[str] = ("year", "month"), how: str = "inner") -> DataFrame:
    """Predicted and observed values side by side as pred_<v> and obs_<v>.

    `inner` keeps the common coordinates; `full_outer` keeps both sides, for
    statistics that use each side alone.
    """
    keys = [*on, *CELL_KEYS]

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return with_keys(df).select(
            *keys, F.col("lat").alias(f"_{prefix}_lat"), F.col("lon").alias(f"_{prefix}_lon"),
            *[F.col(v).alias(f"{prefix}_{v}") for v in variables],
        )

    joined = side(pred, "pred").join(side(obs, "obs"), keys, how)
    return joined.select(
        *on, pack_keys(*map(F.col, AXIS_KEYS)).alias("cell_id"),
        F.coalesce("_obs_lat", "_pred_lat").alias("lat"), F.coalesce("_obs_lon", "_pred_lon").alias("lon"),
        *[f"{p}_{v}" for v in variables for p in ("pred", "obs")],
    )


def subtract_fields(pairs: DataFrame, variables: Sequence[str] = ("tas", "pr")) -> DataFrame:
    """bias_<v> = pred_<v> - obs_<v> for each aligned row."""
    return pairs.withColumns({f"bias_{v}": F.col(f"pred_{v}") - F.col(f"obs_{v}") for v in variables})


def common_times(frames: Sequence[DataFrame], time: str = "time") -> DataFrame:
    """Times present in every source."""
    return reduce(lambda a, b: a.intersect(b), [df.select(time).distinct() for df in frames])


def keep_common_times(frames: Sequence[DataFrame], time: str = "time") -> list[DataFrame]:
    times = common_times(frames, time)
    return [df.join(times, time, "left_semi") for df in frames]


def merge_variables(tas: DataFrame, pr: DataFrame, keys: Sequence[str] = ("model", "scenario"),
                    tas_name: str = "tas", pr_name: str = "pr") -> DataFrame:
    """Two variables of one model on the union of their coordinates."""
    on = [*keys, "time", *CELL_KEYS]
    a = with_keys(tas).select(*on, F.col("lat").alias("_lat_a"), F.col("lon").alias("_lon_a"), tas_name)
    b = with_keys(pr).select(*on, F.col("lat").alias("_lat_b"), F.col("lon").alias("_lon_b"), pr_name)
    return a.join(b, on, "full_outer").select(
        *on, F.coalesce("_lat_a", "_lat_b").alias("lat"), F.coalesce("_lon_a", "_lon_b").alias("lon"),
        tas_name, pr_name,
    )


def stack_models(cubes: dict[str, DataFrame]) -> DataFrame:
    """Cubes of several models as one cube with a model column."""
    labelled = [df.withColumn("model", F.lit(name)) for name, df in cubes.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def job_matrix(spark: SparkSession, models: Sequence[str] = MODELS,
               scenarios: Sequence[str] = FUTURE_SCENARIOS) -> DataFrame:
    """All (model, scenario) pairs of two configured lists."""
    rows = spark.range(1).select(F.explode(F.lit(list(models))).alias("model"))
    return rows.select("model", F.explode(F.lit(list(scenarios))).alias("scenario"))


def pending(requested: DataFrame, manifest: DataFrame, keys: Sequence[str] = ("dataset",)) -> DataFrame:
    """Requested datasets whose latest manifest entry is not `completed`."""
    from isohyet.sources.manifest import latest_status

    done = latest_status(manifest, keys).filter(F.col("status") == "completed")
    return requested.join(done.select(*keys), list(keys), "left_anti")


def complete_models(outputs: DataFrame, keys: Sequence[str] = ("model", "scenario"),
                    variable: str = "variable") -> DataFrame:
    """Models that have both a temperature and a precipitation output."""
    return outputs.groupBy(*keys).agg(
        F.max(F.col(variable) == "tas").alias("_tas"), F.max(F.col(variable) == "pr").alias("_pr")
    ).filter(F.col("_tas") & F.col("_pr")).select(*keys)
