import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from isohyet.operators import align, features
from isohyet.sources import manifest, registry
from tests.conftest import day, plan_of


def frame(cube, stamps, tas):
    return cube([(t, 0.0, 0.0, tas + i, 1.0) for i, t in enumerate(stamps)])


def pair(cube, a, b):
    first = frame(cube, a, 1.0).withColumnRenamed("tas", "x")
    second = frame(cube, b, 2.0).withColumnRenamed("tas", "y")
    return [(first, ["x"]), (second, ["y"])]


def test_exact_empty_then_month(cube):
    frames = pair(cube, [day(2000, 1), day(2000, 2)], [day(2000, 1, 16), day(2000, 2, 16)])
    assert align.align(frames, mode="exact").count() == 0
    for mode in ("month", "auto"):
        got = align.align(frames, mode=mode).collect()
        assert sorted((r["time"], r["x"], r["y"]) for r in got) == [(day(2000, 1), 1.0, 2.0), (day(2000, 2), 2.0, 3.0)]


def test_partial_exact_match_hides_months_from_auto(cube):
    frames = pair(cube, [day(2000, 1), day(2000, 2)], [day(2000, 1), day(2000, 2, 16)])
    assert align.align(frames, mode="auto").count() == 1
    assert align.align(frames).count() == 2


def test_auto_equals_the_exact_join(cube):
    """Several steps in a month, in a different number per source, and three sources."""
    a = [day(2000, 1, d) for d in (1, 2, 2, 3)] + [day(2000, 2)]
    frames = pair(cube, a, [day(2000, 1, d) for d in (2, 3, 3, 9)])
    third = cube([(day(2000, 1, d), 0.0, 0.0, 7.0 + d, 1.0) for d in (2, 3)]).withColumnRenamed("tas", "z")
    for given in (frames, [*frames, (third, ["z"])]):
        columns = ["time", "lat", "lon", "x", "y", *["z"] * (len(given) - 2)]
        want = sorted(tuple(r) for r in align.align(given, mode="exact").select(*columns).collect())
        assert want and sorted(tuple(r) for r in align.align(given, mode="auto").select(*columns).collect()) == want


def test_auto_is_one_plan(spark, cube, tmp_path):
    """No job before the result, and each source is shuffled once for both branches and the flag."""
    for i, (df, _names) in enumerate(pair(cube, [day(2000, 1)], [day(2000, 1, 16)])):
        df.write.parquet(str(tmp_path / str(i)))
    frames = [(spark.read.parquet(str(tmp_path / "0")), ["x"]), (spark.read.parquet(str(tmp_path / "1")), ["y"])]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sparkContext.setJobGroup("auto", "auto")
    try:
        got = align.align(frames, mode="auto")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("auto")
        assert [(r["time"], r["x"], r["y"]) for r in got.collect()] == [(day(2000, 1), 1.0, 2.0)]
        plan = plan_of(got)
        final = plan[plan.index("Final Plan"):plan.index("Initial Plan")] if "Initial Plan" in plan else plan
        assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") <= 2
        assert plan.count("Join") <= 8 and "CartesianProduct" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sparkContext.setJobGroup("other", "other")


def test_auto_finds_neither(cube):
    assert align.align(pair(cube, [day(2000, 1)], [day(2001, 1)]), mode="auto").count() == 0


def test_duplicate_month_is_an_error(cube):
    frames = pair(cube, [day(2000, 1), day(2000, 1, 15)], [day(2000, 1)])
    with pytest.raises(PySparkException, match="source 1: more than one row"):
        align.align(frames).collect()
    assert align.align_month(frames, duplicates="all").count() == 2
    with pytest.raises(ValueError):
        align.align(frames, mode="week")


def test_coordinates_join_despite_float_noise(cube):
    a = cube([(day(2000, 1), 0.1 + 0.2, 1.0, 1.0, 1.0)]).withColumnRenamed("tas", "x")
    b = cube([(day(2000, 1), 0.3, 1.0, 2.0, 1.0)]).withColumnRenamed("tas", "y")
    assert align.align([(a, ["x"]), (b, ["y"])]).count() == 1


def test_month_join_reuses_the_check_shuffle(spark, cube, tmp_path):
    for i, (df, _names) in enumerate(pair(cube, [day(2000, 1)], [day(2000, 1)])):
        df.write.parquet(str(tmp_path / str(i)))
    frames = [(spark.read.parquet(str(tmp_path / "0")), ["x"]), (spark.read.parquet(str(tmp_path / "1")), ["y"])]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan_of(align.align(frames)).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pred_obs_inner_and_outer(cube):
    months = lambda df: df.withColumns({"year": F.year("time"), "month": F.month("time")})
    pred, obs = months(frame(cube, [day(2000, 1), day(2000, 2)], 1.0)), months(frame(cube, [day(2000, 2), day(2000, 3)], 5.0))
    inner = align.subtract_fields(align.align_pred_obs(pred, obs)).collect()
    assert [(r["month"], r["bias_tas"]) for r in inner] == [(2, -3.0)]
    assert align.align_pred_obs(pred, obs, how="full_outer").count() == 3


def test_common_times_and_merge(cube):
    a, b = frame(cube, [day(2000, 1), day(2000, 2)], 1.0), frame(cube, [day(2000, 2), day(2000, 3)], 1.0)
    assert [r[0] for r in align.common_times([a, b]).collect()] == [day(2000, 2)]
    assert [d.count() for d in align.keep_common_times([a, b])] == [1, 1]
    merged = align.merge_variables(a.drop("pr"), b.drop("tas"), keys=()).orderBy("time").collect()
    assert [(r["tas"], r["pr"]) for r in merged] == [(1.0, None), (2.0, 1.0), (None, 1.0)]
    assert all(r["lat"] == 0.0 for r in merged)


def test_job_matrix_and_stack(spark, cube):
    assert align.job_matrix(spark).count() == 18
    stacked = align.stack_models({"a": frame(cube, [day(2000, 1)], 1.0), "b": frame(cube, [day(2000, 1)], 2.0).drop("pr")})
    assert sorted((r["model"], r["pr"]) for r in stacked.collect()) == [("a", 1.0), ("b", None)]


@pytest.fixture
def log(spark):
    rows = [("a", "s", "completed", None, day(2000, 1)), ("b", "s", "failed", "x", day(2000, 1)),
            ("c", "s", "failed", "x", day(2000, 1)), ("c", "s", "completed", None, day(2000, 2)),
            ("d", "s", "completed", None, day(2000, 1)), ("d", "s", "failed", "x", day(2000, 2))]
    return spark.createDataFrame(rows, manifest.SCHEMA)


def test_pending_uses_the_latest_status(spark, log):
    wanted = spark.createDataFrame([(x,) for x in "abcde"], "dataset string")
    assert sorted(r[0] for r in align.pending(wanted, log).collect()) == ["b", "d", "e"]
    assert {r["dataset"]: r["error"] for r in manifest.failures(log).collect()} == {"b": "x", "d": "x"}
    assert {r["status"]: r["n"] for r in manifest.batch_summary(log).collect()} == {"completed": 3, "failed": 3}


def test_manifest_on_disk(spark, tmp_path):
    path = str(tmp_path / "manifest")
    assert manifest.load(spark, path).count() == 0
    manifest.record(spark, path, [("a", "s", "failed", "why")])
    manifest.record(spark, path, [("a", "s", "completed", None)])
    assert manifest.latest_status(manifest.load(spark, path)).first()["status"] == "completed"


def test_complete_models(spark):
    df = spark.createDataFrame([("m", "s", "tas"), ("m", "s", "pr"), ("n", "s", "tas")], "model string, scenario string, variable string")
    assert [tuple(r) for r in align.complete_models(df).collect()] == [("m", "s")]


@pytest.mark.parametrize("names, want", [
    (["xgb_tas"], None), (["xgb_pr"], None),
    (["xgb_tas", "xgb_pr_occ", "xgb_pr_amt"], {"two_stage": True, "occ_path": "m/xgb_pr_occ", "amt_path": "m/xgb_pr_amt", "pr_path": None}),
    (["xgb_tas", "xgb_pr_occ"], {"two_stage": False, "pr_path": "m/xgb_pr_occ"}),
    (["b_tas", "a_tas", "b_pr", "a_pr"], {"two_stage": False, "tas_path": "m/a_tas", "pr_path": "m/a_pr"}),
    (["a_tas", "a_pr", "z_pr_occ", "z_pr_amount"], {"two_stage": True, "amt_path": "m/z_pr_amount"}),
])
def test_model_selection(spark, names, want):
    table = spark.createDataFrame([(f"m/{n}",) for n in names], "path string")
    if want is None:
        with pytest.raises(registry.ModelNotFound):
            registry.resolve_models(table)
        return
    got = registry.resolve_models(table)
    assert {k: got[k] for k in want} == want


def test_explicit_model_paths(spark):
    got = registry.resolve_models(None, "t", "p")
    assert got["tas_path"] == "t" and got["pr_path"] == "p" and not got["two_stage"]


def test_default_splits_are_disjoint_and_cover_the_period(spark):
    years = spark.range(1978, 2017).select(F.col("id").cast("int").alias("year"))
    got = {r["split"]: r["n_rows"] for r in features.split_counts(features.split_by_year(years)).collect()}
    assert got == {"train": 26, "validation": 5, "test": 4}
    assert features.split_by_year(years, keep_unassigned=True).filter("split is null").count() == 4


def test_features(cube):
    df = cube([(day(2000, 3), 0.0, 0.0, 1.0, math.e - 1)]).withColumnRenamed("pr", "gcm_pr_mm")
    r = features.scoring_features(df).first()
    assert (r["month_sin"], r["month_cos"], r["gcm_pr_log1p"]) == pytest.approx((1.0, 0.0, 1.0), abs=1e-12)
    with pytest.raises(ValueError):
        features.feature_target(df, "wind")


def test_sample_is_the_same_for_any_partitioning(spark):
    df = spark.range(20000)
    first = features.sample_rows(df, 0.1, ["id"]).collect()
    again = features.sample_rows(df.repartition(7), 0.1, ["id"]).collect()
    assert sorted(first) == sorted(again) and 1700 < len(first) < 2300
    assert features.sample_rows(df, 0.1, ["id"], seed=1).count() != 0


def test_validation_sample_is_at_least_a_fifth(spark):
    df = spark.range(9000).withColumn("split", F.element_at(F.array(*map(F.lit, ("train", "validation", "test"))), (F.col("id") % 3 + 1).cast("int")))
    got = {r["split"]: r["n_rows"] for r in features.split_counts(features.sample_splits(df, 0.05, ["id"])).collect()}
    assert got == {"test": 3000, "validation": 600, "train": 150}


@pytest.mark.parametrize("limit", [100_000, 1])
def test_exact_samples_are_the_smallest_hashes(spark, monkeypatch, limit):
    import hashlib

    monkeypatch.setattr(features, "HASH_LIMIT", limit)
    df = spark.range(5000).withColumn("split", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b"))
    got = features.sample_exact(df.repartition(5), {"a": 0.333, "b": 0.0}, ["id"])
    want = sorted((i for i in range(0, 5000, 3)), key=lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest())[:round(0.333 * 1667)]
    rows = got.collect()
    assert sorted(r["id"] for r in rows if r["split"] == "a") == sorted(want)
    assert sum(r["split"] is None for r in rows) == 1666 and not any(r["split"] == "b" for r in rows)
    again = features.sample_exact(df.coalesce(1), {"a": 0.333, "b": 0.0}, ["id"]).collect()
    assert sorted(again, key=str) == sorted(rows, key=str)


def test_exact_samples_with_equal_keys_and_without_rows(spark):
    df = spark.createDataFrame([("a", 1, float(i)) for i in range(10)] + [("b", None, 0.0)], "split string, k int, x double")
    got = features.sample_exact(df, {"a": 0.4, "b": 1.0, "none": 0.5}, ["k"]).collect()
    assert sorted(r["split"] for r in got) == ["a"] * 4 + ["b"] and len({r["x"] for r in got if r["split"] == "a"}) == 4
    assert features.sample_exact(df.limit(0), {"a": 0.4}, ["k"]).count() == 0
    with pytest.raises(ValueError):
        features.sample_exact(df, {"a": 1.5}, ["k"])
