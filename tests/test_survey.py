"""What readers learn from one pass, and what they do about it."""

import warnings
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from isohyet.operators.grids import Grid
from isohyet.operators.quality import DataQualityError
from isohyet.plans import preprocess, training
from isohyet.sources import cubes, manifest, sinks, survey
from tests.conftest import day

RULES = {"tas": (-50.0, 60.0, True), "pr": (0.0, 2000.0, False)}
TARGET = Grid((0.5, 1.5), (10.5, 11.5))


@contextmanager
def jobs(spark, name):
    """Number of jobs, each of which is one action without adaptive execution."""
    found = []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.sparkContext.setJobGroup(name, name)
    try:
        yield found
    finally:
        found += spark.sparkContext.statusTracker().getJobIdsForGroup(name)
        spark.sparkContext.setJobGroup("other", "other")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def raw_models(spark, rows):
    return spark.createDataFrame(rows, "model string, scenario string, TIME timestamp_ntz, YAX double, XAX double, TMP double, PRE double")


def cells(model, year, scenario="hist", tas=10.0, lats=(0.0, 1.0, 2.0), lons=(10.0, 11.0, 12.0)):
    return [(model, scenario, day(year, 1), la, lo, tas, 1.0) for la in lats for lo in lons]


def test_survey_numbers(cube):
    rows = [(day(2000, 1), 0.0, 10.0, 1.0, 1.0), (day(2001, 1), 0.0, 11.0, 70.0, None), (None, 1.0, 10.0, None, -1.0), (day(2000, 1), 0.1 + 0.2, 10.0, 5.0, 3.0)]
    got = survey.survey(cube(rows), RULES, inside=F.year("time") == 2000)[()]
    assert (got.n_rows, got.n_undated, got.n_in_period, got.status) == (4, 1, 2, "error")
    assert got.grid.lon == (10.0, 11.0) and len(got.grid.lat) == 3
    tas, pr = got.ranges["tas"], got.ranges["pr"]
    assert (tas.n_missing, tas.n_outside, tas.min_value, tas.max_value) == (1, 1, 1.0, 70.0) and tas.mean_value == pytest.approx(76 / 3)
    assert (pr.n_missing, pr.n_outside) == (1, 1)
    inside = survey.survey(cube(rows), RULES, inside=F.year("time") == 2000, axes_inside=True)[()]
    assert inside.grid.lon == (10.0,) and len(inside.grid.lat) == 2
    empty = survey.survey(cube([]), RULES)[()]
    assert (empty.n_rows, empty.status, empty.grid) == (0, "empty", Grid((), ()))


def test_survey_rows_are_bounded(cube, monkeypatch):
    monkeypatch.setattr(survey, "ROW_LIMIT", 5)
    with pytest.raises(ValueError, match="rectilinear"):
        survey.survey(cube([(day(2000, 1), i / 7, 10.0 + i / 7, 1.0, 1.0) for i in range(5)]), RULES)


def test_one_job_before_the_result(spark, cube, tmp_path):
    cube([(day(2000, m), la, lo, 1.0, 1.0) for m in (1, 2) for la in (0.0, 1.0, 2.0) for lo in (10.0, 11.0, 12.0)]).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    raw = stored.select(F.lit("m").alias("model"), F.lit("hist").alias("scenario"), F.col("time").alias("TIME"), F.col("lat").alias("YAX"),
                        F.col("lon").alias("XAX"), F.col("tas").alias("TMP"), F.col("pr").alias("PRE"))
    with jobs(spark, "reference") as found:
        cubes.read_reference(stored.withColumnsRenamed({"tas": "tmp", "pr": "pre"}))
    assert len(found) == 1
    target = stored.withColumns({"tas": F.col("tas") + 280}).withColumnsRenamed({"tas": "t2m", "pr": "tp"})
    for name, read in (("target", lambda: cubes.read_target(target, TARGET)), ("model", lambda: cubes.read_model(raw, TARGET))):
        from isohyet.operators import grids

        with jobs(spark, f"{name}-weights") as weights:  # on axis tables in memory, no row of the cube is read
            grids.axis_weights(spark, {"m": Grid((0.0, 1.0, 2.0), (10.0, 11.0, 12.0))}, TARGET)
        with jobs(spark, name) as found:
            read()
        assert len(found) == 1 + len(weights), name


def test_models_without_rows_in_the_period_are_errors(spark):
    raw = raw_models(spark, cells("a", 2000) + cells("b", 1950))
    with pytest.raises(DataQualityError, match="model b hist: no rows"):
        cubes.read_model(raw, TARGET)
    assert cubes.read_model(raw.filter("model = 'a'"), TARGET).count() == 4
    with pytest.raises(DataQualityError, match="no rows"):
        cubes.read_model(raw.limit(0), TARGET)
    # Scenario rows are never clipped.
    assert cubes.read_model(raw_models(spark, cells("a", 2090, "ssp585")), TARGET).count() == 4


def test_lenient_ranges_and_impossible_dates_warn(spark):
    raw = raw_models(spark, cells("a", 2000, tas=61.0))
    with pytest.warns(survey.DataQualityWarning, match=r"model a hist: tas: warning, 9 rows outside \[-50.0, 60.0\], min 61.0, max 61.0, mean 61.0"):
        cubes.read_model(raw, TARGET)
    fields = raw_models(spark, cells("a", 2000)).drop("TIME").withColumns(
        {"year": F.lit(2000), "month": F.lit(2), "day": F.when(F.col("YAX") == 2.0, 30).otherwise(5)})
    with pytest.warns(survey.DataQualityWarning, match="3 of 9 rows have no possible date"):
        cubes.read_model(fields, TARGET)
    with warnings.catch_warnings():
        warnings.simplefilter("error", survey.DataQualityWarning)
        cubes.read_model(raw_models(spark, cells("a", 2000)), TARGET)
        cubes.read_model(raw, TARGET, validate=False)


def test_grids_of_a_models_scenarios_are_one(spark):
    raw = raw_models(spark, cells("a", 2000, lats=(0.0, 1.0)) + cells("a", 2050, "ssp585", lats=(1.0 + 1e-9, 2.0)) + cells("b", 2000, lons=(10.0, 12.0)))
    got = cubes.grids_by_model(cubes.survey_models(raw))
    assert got["a"] == Grid((0.0, 1.0, 2.0), (10.0, 11.0, 12.0)) and got["b"].lon == (10.0, 12.0)


def test_flagged_duplicates(spark):
    raw = raw_models(spark, cells("a", 2000) + cells("b", 2000) + cells("b", 2000)[:1])
    got = cubes.read_model(raw, TARGET, duplicates="flag").collect()
    assert sorted((r["model"], r["lat"], r["lon"], r["tas"] is None) for r in got if r["twice"]) == [("b", 0.5, 10.5, True)]
    assert sum(r["tas"] is not None for r in got) == 7


def sources(spark, hot=10.0):
    grid = [(la, lo) for la in TARGET.lat for lo in TARGET.lon]
    reference = spark.createDataFrame([(day(2000, 1), la, lo, hot, 1.0) for la, lo in grid], "time timestamp_ntz, lat double, lon double, tmp double, pre double")
    target = spark.createDataFrame([(day(2000, 1), la, lo, 283.0, 0.01) for la, lo in grid],
                                   "valid_time timestamp_ntz, latitude double, longitude double, t2m double, tp double")
    return reference, target


def test_a_reference_that_fails_its_check_leaves_the_old_one(spark, tmp_path):
    out = str(tmp_path / "p")
    raw = raw_models(spark, cells("a", 2000))
    preprocess.process_and_save(spark, *sources(spark), raw, out, ["a"])
    with pytest.raises(DataQualityError, match="tas: error, 4 rows outside"):
        preprocess.process_and_save(spark, *sources(spark, 99.0), raw, out, ["a"], skip_existing=False)
    assert {r["tas"] for r in sinks.read_table(spark, f"{out}/reference").collect()} == {10.0}
    with pytest.raises(DataQualityError, match="no rows in the requested period"):
        preprocess.process_and_save(spark, *sources(spark), raw, out, ["a"], skip_existing=False, years=(1950, 1951))
    assert [r["status"] for r in manifest.latest_status(manifest.load(spark, f"{out}/manifest")).filter("dataset = 'reference'").collect()] == ["failed"]


def test_bad_models_stay_out_and_do_not_replace_older_ones(spark, tmp_path):
    out = str(tmp_path / "p")
    first = raw_models(spark, cells("a", 2000, tas=1.0) + cells("b", 2000, tas=1.0))
    preprocess.process_and_save(spark, *sources(spark), first, out, ["a", "b"])
    second = raw_models(spark, cells("a", 2001, tas=2.0) + cells("b", 2001, tas=2.0) * 2)
    log = preprocess.process_and_save(spark, *sources(spark), second, out, ["a", "b", "none"], skip_existing=False)
    last = {r["dataset"]: r for r in log.orderBy("ts").collect()}
    assert last["b"]["status"] == "failed" and last["b"]["error"].endswith("results use cells that stand twice")
    assert last["none"]["error"] == "no rows in the requested period"
    got = {(r["model"], r["time"].year, r["tas"]) for r in sinks.read_table(spark, f"{out}/models").collect()}
    assert got == {("a", 2001, 2.0), ("b", 2000, 1.0)}


def test_a_failing_job_fails_only_the_models_at_fault(spark, tmp_path):
    raw = raw_models(spark, cells("a", 2000) + cells("b", 2000))
    # Fails only while the values of b are written: the survey reads no `PRE` of it that is used.
    calls = []
    real = preprocess._store

    def store(spark, history, grid, names, *rest):
        calls.append(tuple(names))
        if "b" in names:
            raise RuntimeError("lost")
        return real(spark, history, grid, names, *rest)

    preprocess._store = store
    try:
        log = preprocess.process_and_save(spark, *sources(spark), raw, str(tmp_path / "p"), ["a", "b"])
    finally:
        preprocess._store = real
    assert {r["dataset"]: r["status"] for r in log.collect()} == {"reference": "completed", "target": "completed", "a": "completed", "b": "failed"}
    assert calls == [("a", "b"), ("a",), ("b",)]


def test_an_empty_training_table_warns(spark, cube, tmp_path):
    one, two = cube([(day(2000, 1), 0.0, 0.0, 1.0, 1.0)]), cube([(day(2001, 1), 0.0, 0.0, 1.0, 1.0)])
    with pytest.warns(UserWarning, match="share no time, month or cell"):
        training.save_training_table(training.training_table(one, one, two, mode="auto"), str(tmp_path / "t"))
    assert sinks.read_split(spark, str(tmp_path / "t")).count() == 0
