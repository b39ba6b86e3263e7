import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from isohyet.functions import units
from isohyet.functions.calendar import season_of
from isohyet.operators import naming, profile, quality, temporal
from isohyet.operators.grids import Grid
from isohyet.sources import cubes
from tests.conftest import day, plan_of


def test_nan_becomes_missing_and_is_not_wet(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (0.0,), (None,)], "pr double")
    clean = naming.nulls_for_nan(df, ["pr"])
    row = clean.agg(F.avg("pr"), F.count_if(F.col("pr") > 0), F.count("pr")).first()
    assert tuple(row) == (0.5, 1, 2)
    assert [r[0] for r in clean.select(units.clip_nonneg(F.col("pr"))).collect()] == [None, 1.0, 0.0, None]


def test_reference_is_clipped_with_the_whole_last_day(cube):
    rows = [(datetime(1979, 12, 31, 23), 0.0, 0.0, 1.0, 1.0), (day(1980, 1), 0.0, 0.0, 2.0, 1.0),
            (datetime(2014, 12, 31, 23, 59), 0.0, 1.0, 3.0, 1.0), (day(2015, 1), 0.0, 1.0, 4.0, 1.0)]
    got, grid = cubes.read_reference(cube(rows).withColumnsRenamed({"tas": "tmp", "pr": "pre"}))
    assert sorted(r["tas"] for r in got.collect()) == [2.0, 3.0]
    assert grid == Grid((0.0,), (0.0, 1.0))


def test_reference_errors(cube):
    late = cube([(day(2050, 1), 0.0, 0.0, 1.0, 1.0)])
    with pytest.raises(quality.DataQualityError, match="no rows"):
        cubes.read_reference(late)
    hot = cube([(day(2000, 1), 0.0, 0.0, 60.5, 1.0)])
    with pytest.raises(quality.DataQualityError, match="tas: error"):
        cubes.read_reference(hot)


@pytest.mark.parametrize("value, outside", [(-50.0, 0), (60.0, 0), (-50.1, 1), (60.1, 1)])
def test_range_bounds_are_inclusive(cube, value, outside):
    report = quality.validate_range(cube([(day(2000, 1), 0.0, 0.0, value, 1.0)]), {"tas": (-50, 60, True)}).first()
    assert report["n_outside"] == outside and report["status"] == ("error" if outside else "ok")


def test_lenient_range_only_warns(cube):
    report = quality.validate_range(cube([(day(2000, 1), 0.0, 0.0, 5.0, 2000.1)]), {"pr": (0, 2000, False)})
    assert report.first()["status"] == "warning"
    quality.enforce(report)


def test_empty_dataset_is_reported(cube):
    report = quality.validate_range(cube([]), {"tas": (-50, 60, False)})
    assert report.first()["status"] == "empty"
    with pytest.raises(quality.DataQualityError):
        quality.enforce(report)


def test_target_conversion_and_months(spark):
    rows = [(datetime(2000, 1, d), 0.0, 0.0, 283.15 + d, 0.001 * d, "1", 0) for d in (1, 3)]
    rows += [(datetime(2000, 2, 5), 0.0, 0.0, None, None, "1", 0)]
    raw = spark.createDataFrame(
        rows, "valid_time timestamp_ntz, latitude double, longitude double, t2m double, tp double, expver string, number int")
    got = {r["month"]: r for r in cubes.read_target(raw).collect()}
    assert got[1]["tas"] == pytest.approx(12.0) and got[1]["pr"] == pytest.approx(4.0)
    assert got[1]["time"] == day(2000, 1)
    assert got[2]["tas"] is None and got[2]["pr"] is None
    assert "expver" not in cubes.convert_target(raw).columns


def test_monthly_resample_is_idempotent(cube):
    df = cube([(day(2000, m), 0.0, 0.0, float(m), 1.0) for m in range(1, 5)])
    once = temporal.resample_monthly(df, {"tas": "mean", "pr": "sum"})
    twice = temporal.resample_monthly(once, {"tas": "mean", "pr": "sum"})
    assert sorted(once.collect()) == sorted(twice.collect())
    with pytest.raises(ValueError):
        temporal.resample_monthly(df, {"tas": "median"})


def test_only_history_is_clipped(cube):
    df = cube([(day(y, 1), 0.0, 0.0, 1.0, 1.0, s) for y in (1970, 2000, 2050) for s in ("hist", "ssp585")], ("scenario",))
    got = {(r["time"].year, r["scenario"]) for r in temporal.conditional_clip(df).collect()}
    assert got == {(2000, "hist"), (1970, "ssp585"), (2000, "ssp585"), (2050, "ssp585")}


def test_clip_is_pushed_to_parquet(spark, cube, tmp_path):
    cube([(day(2000, 1), 0.0, 0.0, 1.0, 1.0)]).write.parquet(str(tmp_path / "c"))
    plan = plan_of(temporal.clip_years(spark.read.parquet(str(tmp_path / "c")), 1990, 2010).select("lat", "tas"))
    assert "PushedFilters: [IsNotNull(time), GreaterThanOrEqual(time" in plan and "LessThan(time" in plan
    assert "ReadSchema: struct<time:timestamp_ntz,lat:double,tas:double>" in plan


def test_impossible_dates_drop_their_own_row(spark):
    df = spark.createDataFrame(
        [(2001, 2, 28, 1.0), (2001, 2, 30, 2.0), (2001, 3, 1, 3.0), (None, 1, 1, 4.0)], "y int, m int, d int, v double")
    got = [(r["time"], r["v"]) for r in temporal.decode_calendar(df).orderBy("v").collect()]
    assert got == [(day(2001, 2, 28), 1.0), (day(2001, 3), 3.0)]
    assert tuple(temporal.calendar_report(df).first()) == (4, 2)


def test_model_with_calendar_fields(spark):
    raw = spark.createDataFrame(
        [("m", "hist", 2000, 2, d, 0.0, 0.0, 5.0, 2.0) for d in (29, 30)],
        "model string, scenario string, year int, month int, day int, YAX double, XAX double, TMP double, PRE double")
    got = cubes.read_model(raw).collect()
    assert len(got) == 1 and got[0]["pr"] == 60.0 and got[0]["time"] == day(2000, 2, 29)


def test_exact_month_length(cube):
    df = cube([(day(2000, 2), 0.0, 0.0, 1.0, 2.0)])
    row = df.select(units.per_day_to_per_month(F.col("pr"), F.col("time"), True), units.per_day_to_per_month(F.col("pr"))).first()
    assert tuple(row) == (58.0, 60.0)


def test_unparsable_time_is_missing(spark):
    df = spark.createDataFrame([("2001-02-03",), ("soon",), ("2001-02-30",)], "s string")
    assert [r[0] for r in temporal.parse_times(df, "s").select("time").collect()] == [day(2001, 2, 3), None, None]


@pytest.mark.parametrize("kind, tas, pr, want", [
    ("target", 99.0, 11.0, (99.0, 11.0)), ("target", 101.0, 9.0, (101 - 273.15, 9000.0)),
    ("model", 99.0, 1.1, (99.0, 1.1)), ("model", 101.0, 0.9, (101 - 273.15, 0.9 * 2592000)),
])
def test_guarded_convert(cube, kind, tas, pr, want):
    df = cube([(day(2000, 1), 0.0, 0.0, tas, pr, "m"), (day(2000, 1), 0.0, 0.0, 5.0, 0.5, None)], ("model",))
    got = {r["model"]: (r["tas"], r["pr"]) for r in quality.guarded_convert(df, kind, ["model"]).collect()}
    assert got["m"] == pytest.approx(want)
    assert None in got  # a missing key is its own group, not lost


def test_standardize_coords(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "Valid_Time int, LATITUDE double, nav_lon double, tas double")
    assert naming.standardize_coords(df).columns == ["time", "lat", "lon", "tas"]
    with pytest.raises(ValueError):
        naming.standardize_coords(df.withColumn("lat_bounds", F.lit(0)))
    fluxes = df.withColumns({"longwave": F.lit(1.0), "latent_heat": F.lit(2.0)})
    assert naming.standardize_coords(fluxes, values=("tas", "longwave", "latent_heat")).columns == [
        "time", "lat", "lon", "tas", "longwave", "latent_heat"]


def test_broken_manifest_files_are_skipped(spark, tmp_path):
    from isohyet.sources import manifest

    path = str(tmp_path / "manifest")
    manifest.record(spark, path, [("a", "preprocess", "completed", None)])
    (tmp_path / "manifest" / "part-broken.parquet").write_bytes(b"not parquet")
    assert [r["dataset"] for r in manifest.load(spark, path).collect()] == ["a"]
    assert manifest.load(spark, str(tmp_path / "absent")).count() == 0


def test_alias_variable(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "TMP double, pr double")
    assert naming.alias_variable(df, ("tas", "TMP"), "gcm_tas").columns == ["gcm_tas", "pr"]
    with pytest.raises(KeyError, match="TMP"):
        naming.alias_variable(df, ("x",), "y")


def test_drop_missing_keeps_other_missing_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (float("nan"), 1.0)], "core double, cru double")
    assert quality.drop_missing(df, ["core"]).count() == 1
    assert tuple(quality.drop_report(df, ["core"]).first())[:3] == (3, 1, 2)


def test_seasons(spark):
    got = {r[0]: r[1] for r in spark.range(1, 13).select("id", season_of(F.col("id"))).collect()}
    assert [got[m] for m in (12, 1, 2, 3, 5, 6, 8, 9, 11)] == ["DJF"] * 3 + ["MAM"] * 2 + ["JJA"] * 2 + ["SON"] * 2


def test_formats(spark, cube, tmp_path):
    df = cube([(day(2000, 1), 0.0, 0.0, 1.5, 2.5)])
    schema = "time timestamp_ntz, lat double, lon double, tas double, pr double"
    for fmt in cubes.FORMATS:
        path = str(tmp_path / fmt)
        writer = df.write.option("header", True) if fmt == "csv" else df.write
        writer.format(fmt).save(path)
        assert cubes.read_cells(spark, path, fmt, schema).collect() == df.collect()
    with pytest.raises(ValueError):
        cubes.read_cells(spark, "x", "csv")


def test_processed_paths(spark, cube, tmp_path):
    cube([(day(2000, 1), 0.0, 0.0, 1.5, 2.5)]).write.parquet(str(tmp_path / "b"))
    assert cubes.first_existing(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).endswith("/b")
    with pytest.raises(FileNotFoundError, match=r"nowhere.*available: \['b'\]"):
        cubes.first_existing(spark, [str(tmp_path / "nowhere")])


def test_grid_info_of_one_value_has_no_spacing(cube):
    df = cube([(day(2000, 1), 5.0, lo, 1.0, 1.0, "d") for lo in (3.0, 1.0, 2.0)], ("dataset",))
    r = profile.grid_info(df).first()
    assert (r["lat_res"], r["lon_res"], r["n_lat"], r["n_lon"]) == (0.0, 1.0, 1, 3)


def test_profile_and_catalog(cube):
    df = cube([(day(2000, 1), 5.0, 1.0, None, 1.0, "d"), (day(2000, 2), 5.0, 1.0, None, 3.0, "d")], ("dataset",))
    rows = {r["variable"]: r for r in profile.profile(df, ["tas", "pr"]).collect()}
    assert rows["tas"]["n_missing"] == 2 and rows["pr"]["mean_value"] == 2.0 and rows["pr"]["dtype"] == "double"
    assert profile.catalog(df).first()["variables"] == "pr"
    assert math.isclose(profile.time_coverage(df).first()["n_times"], 2)
