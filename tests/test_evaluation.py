import math
import numpy as np
import pytest
from pyspark.sql import functions as F

from isohyet.operators import classify, ensemble, evaluate
from isohyet.operators.grids import Grid
from isohyet.operators.learning import two_stage_combine

PAIRS = "year int, month int, cell_id long, lat double, lon double, pred_tas double, obs_tas double, pred_pr double, obs_pr double"


@pytest.fixture(scope="module")
def uneven(spark):
    """Two cells with different record lengths and errors, one constant side, one single pair."""
    rng = np.random.default_rng(5)
    rows = []
    for cell, n, scale in ((1, 24, 1.0), (2, 6, 5.0)):
        for i in range(n):
            o = float(rng.normal(10, 3))
            rows.append((2000 + i // 12, i % 12 + 1, cell, float(cell), 0.0, o + scale * float(rng.normal()), o, 3.0, abs(o)))
    rows += [(2000, 1, 3, 3.0, 0.0, 1.0, 2.0, 1.0, 1.0), (2000, 1, 4, 4.0, 0.0, None, 2.0, None, 1.0)]
    return spark.createDataFrame(rows, PAIRS), rows


def test_cell_metrics_match_numpy(uneven):
    df, rows = uneven
    got = {r["cell_id"]: r for r in evaluate.cell_metrics(df).collect()}
    for cell in (1, 2):
        p, o = (np.array([r[i] for r in rows if r[2] == cell]) for i in (5, 6))
        assert got[cell]["rmse_tas"] == pytest.approx(np.sqrt(np.mean((p - o) ** 2)))
        assert got[cell]["corr_tas"] == pytest.approx(np.corrcoef(p, o)[0, 1])
        assert got[cell]["corr_pr"] is None  # the prediction is constant
    assert got[3]["corr_tas"] is None and got[3]["rmse_tas"] == 1.0
    assert got[4]["n_tas"] == 0 and got[4]["rmse_tas"] is None


def test_mean_of_cell_rmse_is_not_the_pooled_rmse(uneven):
    df, rows = uneven
    mean = evaluate.mean_of_cell_metric(df).first()["rmse_tas"]
    pooled = evaluate.regression_metrics(df, "obs_tas", "pred_tas").first()["rmse"]
    cells = [np.sqrt(np.mean([(r[5] - r[6]) ** 2 for r in rows if r[2] == c])) for c in (1, 2, 3)]
    assert mean == pytest.approx(np.mean(cells)) and abs(mean - pooled) > 0.01


def test_regression_metrics(uneven):
    df, rows = uneven
    good = [(r[5], r[6]) for r in rows if r[5] is not None]
    p, y = map(np.array, zip(*good))
    r = evaluate.regression_metrics(df, "obs_tas", "pred_tas").first()
    assert r["r2"] == pytest.approx(1 - np.sum((p - y) ** 2) / np.sum((y - y.mean()) ** 2))
    assert (r["mae"], r["bias"]) == pytest.approx((np.mean(np.abs(p - y)), np.mean(p - y)))
    scatter = evaluate.scatter_stats(df, "obs_tas", "pred_tas").first()
    assert scatter["r2"] == pytest.approx(np.corrcoef(p, y)[0, 1] ** 2) and scatter["n"] == len(p)


def test_r2_of_a_constant_truth(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (1.0, 1.0, 1.0)], "y double, same double, other double")
    assert evaluate.regression_metrics(df, "y", "same").first()["r2"] == 1.0
    assert evaluate.regression_metrics(df, "y", "other").first()["r2"] == 0.0


def _cube(spark, seed, drop=()):
    rng = np.random.default_rng(seed)
    rows = [(y, m, la, lo, float(rng.normal()), float(rng.gamma(1.0))) for y in (2011, 2012) for m in range(1, 13)
            for la in (0.0, 1.0, 2.0) for lo in (5.0, 6.0) if (m, la, lo) not in drop]
    return spark.createDataFrame(rows, "year int, month int, lat double, lon double, tas double, pr double"), rows


def test_report_matches_numpy(spark):
    pred, p = _cube(spark, 1)
    obs, o = _cube(spark, 2, drop={(1, 0.0, 5.0), (7, 1.0, 6.0)})
    got = {(r["scope"], r["variable"], r["metric"]): r["value"] for r in evaluate.evaluate_test_period(pred, obs).collect()}
    assert len(got) == 16
    pd_, od = {r[:4]: r[4] for r in p}, {r[:4]: r[4] for r in o}
    keys = [k for k in pd_ if k in od]
    d = np.array([pd_[k] - od[k] for k in keys])
    assert got["all", "tas", "bias"] == pytest.approx(d.mean())
    assert got["all", "tas", "mae"] == pytest.approx(np.abs(d).mean())
    cells = sorted({k[2:] for k in keys})
    rmse = [np.sqrt(np.mean([(pd_[k] - od[k]) ** 2 for k in keys if k[2:] == c])) for c in cells]
    corr = [np.corrcoef([pd_[k] for k in keys if k[2:] == c], [od[k] for k in keys if k[2:] == c])[0, 1] for c in cells]
    assert got["all", "tas", "rmse"] == pytest.approx(np.mean(rmse))
    assert got["all", "tas", "spatial_corr"] == pytest.approx(np.mean(corr))
    # Each side's own months make its map, so a month only one side has still counts.
    for season, months in (("DJF", (12, 1, 2)), ("JJA", (6, 7, 8))):
        maps = [[np.mean([v for k, v in side.items() if k[1] in months and k[2:] == c]) for c in cells] for side in (pd_, od)]
        assert got[season, "tas", "pattern_corr"] == pytest.approx(np.corrcoef(*maps)[0, 1])


def test_strict_pattern_correlation_is_missing_with_a_missing_cell(spark):
    pred, _ = _cube(spark, 1)
    obs, _ = _cube(spark, 2, drop={(m, 0.0, 5.0) for m in (12, 1, 2)})
    got = {(r["scope"], r["variable"]): r["value"] for r in evaluate.evaluate_test_period(pred, obs, strict=True).collect()
           if r["metric"] == "pattern_corr"}
    assert got["DJF", "tas"] is None and got["JJA", "tas"] is not None


def test_point_metrics_use_each_sides_grid(spark):
    pred, p = _cube(spark, 1)
    obs, o = _cube(spark, 2)
    grid = Grid((0.0, 1.0, 2.0), (5.0, 6.0))
    got = evaluate.point_metrics(pred, obs, grid, grid, "tas", [(0.5, 9.0)]).first()
    a = np.array([r[4] for r in p if r[2:4] == (1.0, 6.0)])
    b = np.array([r[4] for r in o if r[2:4] == (1.0, 6.0)])
    assert (got["rmse"], got["bias"]) == pytest.approx((np.sqrt(np.mean((a - b) ** 2)), np.mean(a - b)))
    assert got["corr"] == pytest.approx(np.corrcoef(a, b)[0, 1])


def test_density_bins_hold_every_pair(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=3000), rng.normal(size=3000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0)], "x double, y double")
    got = {(r["x_bin"], r["y_bin"]): r["n"] for r in evaluate.density_bins(df, "x", "y", 10).collect()}
    want, _, _ = np.histogram2d(x, y, bins=10)
    assert sum(got.values()) == 3000
    assert all(got.get((i, j), 0) == want[i, j] for i in range(10) for j in range(10))


def test_density_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert {(r["x_bin"], r["y_bin"]) for r in evaluate.density_bins(df, "x", "y").collect()} == {(0, 0), (0, 49)}


def _auc(label, score):
    pos, neg = score[label == 1], score[label == 0]
    return np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))


@pytest.mark.parametrize("ranges", [None, 1, 25])
def test_auc_matches_all_pairs_with_ties_and_a_hot_score(spark, ranges):
    rng = np.random.default_rng(9)
    # A third of all rows share one score.
    score = np.where(rng.random(3000) < 0.33, 0.5, np.round(rng.random(3000), 3))
    label = (rng.random(3000) < score).astype(int)
    key = rng.integers(0, 2, 3000)
    df = spark.createDataFrame([(int(k), int(a), float(b)) for k, a, b in zip(key, label, score)], "k int, y int, p double")
    got = {r["k"]: r for r in classify.classification_metrics(df, "y", "p", keys=["k"], ranges=ranges).collect()}
    for k in (0, 1):
        y, p = label[key == k], score[key == k]
        said = p > 0.5
        assert got[k]["roc_auc"] == pytest.approx(_auc(y, p))
        assert got[k]["accuracy"] == pytest.approx(np.mean(said == (y == 1)))
        assert got[k]["precision"] == pytest.approx(np.sum(said & (y == 1)) / said.sum())
        assert got[k]["recall"] == pytest.approx(np.sum(said & (y == 1)) / y.sum())


def test_classification_without_a_denominator(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.5)], "y int, p double")
    assert tuple(classify.classification_metrics(df, "y", "p").first()) == (1.0, 0.0, 0.0, None)


def test_tied_ranks_in_ranges(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.random(500), 2)
    df = spark.createDataFrame([(float(v),) for v in x], "s double")
    got = {r["score"]: r["rank"] for r in classify.tied_ranks(df, "s", ranges=6).collect()}
    assert all(got[v] == pytest.approx(np.sum(x < v) + (np.sum(x == v) + 1) / 2) for v in np.unique(x))


def test_two_stage_combine(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.5, -1.0), (None, 1.0)], "p double, a double")
    got = [r[0] for r in df.select(two_stage_combine(F.col("p"), F.col("a"))).collect()]
    assert got == [pytest.approx(0.5 * np.expm1(1.0)), 0.0, None]


ENS = "model string, scenario string, year int, month int, lat double, lon double, tas double, pr double"


def test_ensemble_skips_missing_and_one_model_has_no_spread(spark):
    rows = [("a", "s", 2000, 1, 0.0, 0.0, 1.0, 1.0), ("b", "s", 2000, 1, 0.0, 0.0, 3.0, None), ("a", "s", 2000, 2, 0.0, 0.0, 5.0, 1.0)]
    got = {r["month"]: r for r in ensemble.ensemble_stats(spark.createDataFrame(rows, ENS)).collect()}
    assert (got[1]["tas_mean"], got[1]["tas_std"], got[1]["pr_mean"]) == (2.0, 1.0, 1.0)
    assert got[2]["tas_std"] == 0.0 and got[2]["n_models"] == 1


def test_change_signal_takes_its_base_from_history(spark):
    rows = [("a", "hist", 2000, 1, 0.0, 0.0, 10.0, 4.0), ("a", "ssp585", 2080, 1, 0.0, 0.0, 13.0, 5.0),
            ("a", "ssp585", 2030, 1, 0.0, 0.0, 99.0, 99.0), ("a", "ssp126", 2080, 1, 0.0, 0.0, 11.0, 3.0)]
    got = {r["scenario"]: r for r in ensemble.change_signal(ensemble.ensemble_stats(spark.createDataFrame(rows, ENS))).collect()}
    assert set(got) == {"ssp126", "ssp585"}
    assert got["ssp585"]["change_tas"] == 3.0 and got["ssp585"]["change_percent_pr"] == 25.0
    assert got["ssp126"]["change_percent_pr"] == -25.0


def test_bias_map_limit_is_symmetric(uneven):
    rows = evaluate.bias_map(uneven[0]).collect()
    assert {round(r["limit"], 9) for r in rows} == {round(max(abs(r["bias"]) for r in rows if r["bias"] is not None), 9)}
    seasonal = evaluate.bias_map(uneven[0], by_season=True).collect()
    assert {r["season"] for r in seasonal} == {"DJF", "MAM", "JJA", "SON"}


def test_float_noise_does_not_split_a_cell(spark):
    from isohyet.operators.align import align_pred_obs

    schema = "year int, month int, lat double, lon double, tas double, pr double"
    pred = spark.createDataFrame([(2000, m, 0.3, 1.0, 1.0 * m, 1.0) for m in (1, 2)], schema)
    obs = spark.createDataFrame([(2000, 1, 0.1 + 0.2, 1.0, 2.0, 1.0), (2000, 2, 0.3, 1.0, 2.0, 1.0)], schema)
    rows = evaluate.cell_metrics(align_pred_obs(pred, obs)).collect()
    assert len(rows) == 1 and rows[0]["n_tas"] == 2


@pytest.mark.parametrize("ranges", [None, 14])
def test_missing_keys_and_nan_scores_at_every_size(spark, ranges):
    rows = [(None if i % 3 else "a", float(i % 2), float("nan") if i == 7 else i / 10) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, y double, p double")
    got = classify.classification_metrics(df, "y", "p", keys=["k"], ranges=ranges).collect()
    assert {r["k"] for r in got} == {None, "a"}
    for r in got:
        own = [(y, p) for k, y, p in rows if k == r["k"] and p == p]
        pairs = [(p > q) + (p == q) / 2 for y, p in own for z, q in own if y == 1 and z == 0]
        assert r["roc_auc"] == pytest.approx(sum(pairs) / len(pairs))


def test_metrics_run_their_input_once(spark):
    """No count and no quantiles before the job: every input row is made one time."""
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = spark.range(0, 400, 1, 4).selectExpr("int(id % 2) as y", "id / 400 as p").mapInArrow(counted, "y int, p double")
    got = classify.classification_metrics(df, "y", "p", ranges=8).first()
    assert made.value == 400 and got["roc_auc"] == pytest.approx(0.5, abs=0.01)


def test_ranks_of_a_long_tail_stay_in_their_ranges(spark):
    """Scores over 300 orders of magnitude, negative ones and infinities: ranges follow the rows, not the values."""
    values = [s * 10.0 ** e for e in range(-150, 150) for s in (1, -1)] + [float("inf"), float("-inf"), 0.0]
    df = spark.createDataFrame([(v,) for v in values * 2], "s double")
    got = {r["score"]: r["rank"] for r in classify.tied_ranks(df, "s", ranges=9).collect()}
    assert [got[v] for v in sorted(values)] == [2 * i + 1.5 for i in range(len(values))]


def test_hexagons_match_a_search_over_all_centres(spark):
    rng = np.random.default_rng(5)
    x, y = np.round(rng.random(400) * 7, 2), np.round(rng.random(400) * 3, 2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (float("nan"), 1.0)], "x double, y double")
    got = {(r["x"], r["y"]): r["n"] for r in evaluate.hexagon_bins(df, "x", "y", 10).collect()}
    assert sum(got.values()) == 400
    n_y = int(10 / math.sqrt(3))
    w, h = (x.max() - x.min()) / 10, (y.max() - y.min()) / n_y
    centres = [(i + o, j + o) for o in (0.0, 0.5) for i in range(-1, 12) for j in range(-1, n_y + 2)]
    want = {}
    for a, b in zip((x - x.min()) / w, (y - y.min()) / h):
        # The closest centre; of equally close ones the offset lattice, then the larger.
        i, j = min(centres, key=lambda c: (round((a - c[0]) ** 2 + 3 * (b - c[1]) ** 2, 9), -(c[0] % 1), -c[0], -c[1]))
        want[i, j] = want.get((i, j), 0) + 1
    near = lambda cells: {(round(a, 6), round(b, 6)): n for (a, b), n in cells.items()}
    assert near(got) == near({(x.min() + i * w, y.min() + j * h): n for (i, j), n in want.items()})
    one = spark.createDataFrame([(1.0, 2.0)] * 3, "x double, y double")
    assert [(r["n"], r["x"], r["y"]) for r in evaluate.hexagon_bins(one, "x", "y").collect()] == [(3, 1.0, 2.0)]
    assert evaluate.hexagon_bins(df, "x", "y", 10, min_count=3).count() == sum(n > 2 for n in want.values())


def test_correlation_of_a_side_that_varies_by_rounding_alone_is_missing(spark):
    """Seasonal means of one value differ in the last bit by the order of their sums."""
    c = 499 / 7.91907019
    rows = [(1, i, c if i % 3 else math.nextafter(c, 100), float(i * i % 7), c * (1 + 1e-9 * i)) for i in range(40)]
    df = spark.createDataFrame(rows, "month int, cell_id long, pred_tas double, obs_tas double, small double")
    assert evaluate.pattern_correlation(df, ["tas"]).first()["pattern_corr_tas"] is None
    swapped = df.select("month", "cell_id", F.col("obs_tas").alias("pred_tas"), F.col("pred_tas").alias("obs_tas"))
    assert evaluate.pattern_correlation(swapped, ["tas"]).first()["pattern_corr_tas"] is None
    real = df.withColumn("pred_tas", F.col("small")).withColumn("obs_tas", F.col("cell_id").cast("double"))
    assert evaluate.pattern_correlation(real, ["tas"]).first()["pattern_corr_tas"] == pytest.approx(1.0, abs=1e-6)
    odd = df.withColumn("pred_tas", F.when(F.col("cell_id") == 3, F.lit(float("nan"))).otherwise(F.col("small")))
    assert math.isnan(evaluate.pattern_correlation(odd, ["tas"]).first()["pattern_corr_tas"])
