"""Raw sources to processed cubes, with a manifest to resume from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from isohyet.constants import ALL_YEARS, HISTORICAL, MODELS
from isohyet.operators.align import pending
from isohyet.operators.grids import Grid, grid_of
from isohyet.sources import manifest as manifest_table
from isohyet.sources.cubes import check_watched, grids_by_model, read_model, read_target, survey_models, watched_reference
from isohyet.sources.sinks import commit_table, read_table, stage_table, write_table
from isohyet.sources.survey import judge, values_of

STAGE = "preprocess"


def process_and_save(spark: SparkSession, reference: DataFrame, target: DataFrame, models: DataFrame, output: str,
                     names: Sequence[str] = MODELS, skip_existing: bool = True,
                     years: tuple[int, int] = ALL_YEARS) -> DataFrame:
    """Process all sources and return the manifest.

    Reference and target fail fast. The reference is checked by what is seen while it is
    written, and becomes visible only if it passes. Models run as one job behind one
    pass that finds their grids; those without rows or with cells that stand twice
    are logged and left out, and do not stop the others. If that job fails, the models
    run one by one, so only those at fault fail. What a run stores is visible when
    it is whole; the log tells of this run only.
    """
    path = f"{output}/manifest"
    wanted = ["reference", "target", *names]
    todo = set(wanted)
    if skip_existing:
        requested = spark.createDataFrame([(n,) for n in wanted], "dataset string")
        todo = {r["dataset"] for r in pending(requested, manifest_table.load(spark, path)).collect()}

    def log(entries: Sequence[tuple[str, str, str | None]]) -> None:
        manifest_table.record(spark, path, [(d, STAGE, s, e) for d, s, e in entries])

    def fail_fast(dataset: str, work) -> None:
        try:
            work()
        except Exception as error:
            log([(dataset, "failed", str(error))])
            raise
        log([(dataset, "completed", None)])

    def write_reference() -> None:
        cube, seen = watched_reference(reference, years)
        staged = stage_table(cube.select("time", "lat", "lon", "tas", "pr"), f"{output}/reference")
        check_watched(seen)
        commit_table(spark, staged)

    if "reference" in todo:
        fail_fast("reference", write_reference)
    grid = grid_of(read_table(spark, f"{output}/reference"))
    if "target" in todo:
        fail_fast("target", lambda: write_table(
            read_target(target, grid, years).select("time", "lat", "lon", "tas", "pr"), f"{output}/target"
        ))
    left = [n for n in names if n in todo]
    if left:
        log(_models(spark, models, grid, left, output, years))
    return manifest_table.load(spark, path)


def _models(spark: SparkSession, models: DataFrame, grid: Grid, names: Sequence[str], output: str,
            years: tuple[int, int]) -> list[tuple[str, str, str | None]]:
    history = models.filter((F.col("scenario") == HISTORICAL) & F.col("model").isin(*names))
    found = survey_models(history, years)
    if found:
        judge(found, "model", empty="warn")
    present = [n for n in names if any(m == n and s.n_in_period for (m, _), s in found.items())]
    errors = {n: "no rows in the requested period" for n in names if n not in present}
    grids = grids_by_model(found)
    try:
        errors |= _store(spark, history, grid, present, output, years, grids)
    except Exception as error:
        # One model must not fail the others.
        for n in present:
            try:
                errors |= {n: str(error)} if len(present) == 1 else _store(spark, history, grid, [n], output, years, grids)
            except Exception as own:
                errors[n] = str(own)
    return [(n, "failed", errors[n]) if n in errors else (n, "completed", None) for n in names]


def _store(spark: SparkSession, history: DataFrame, grid: Grid, names: Sequence[str], output: str, years: tuple[int, int],
           grids: dict[str, Grid]) -> dict[str, str]:
    """Write the named models in one job and make the good ones visible; the others with what is wrong with them."""
    if not names:
        return {}
    cube = read_model(history.filter(F.col("model").isin(*names)), grid, years, source_grids=grids, duplicates="flag")
    seen = Observation()
    twice = [F.count_if((F.col("model") == n) & F.col("twice")).alias(f"twice_{i}") for i, n in enumerate(names)]
    staged = stage_table(cube.observe(seen, *twice).drop("twice").withColumn("year", F.year("time")), f"{output}/models",
                         ("model", "scenario", "year"))
    counts = values_of(seen)
    errors = {n: f"{counts[f'twice_{i}']} results use cells that stand twice" for i, n in enumerate(names) if counts.get(f"twice_{i}")}
    good = [(n,) for n in names if n not in errors]
    if good:
        commit_table(spark, staged, ("model",), good)
    return errors
