import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from isohyet.operators import grids
from isohyet.operators.grids import Grid
from isohyet.operators.regrid import flatten, pivot_map, regrid, to_grid
from tests.conftest import day, plan_of

SRC = Grid((0.0, 1.0, 2.0, 3.0), (10.0, 11.0, 12.0, 13.0))


def plane(grid, a=1.0, b=2.0, c=-0.5, when=day(2000, 1)):
    return [(when, la, lo, a + b * la + c * lo, 5.0) for la in grid.lat for lo in grid.lon]


def result(df):
    return {(r["lat"], r["lon"]): (r["tas"], r["pr"]) for r in df.collect()}


def test_plane_is_exact_inside_and_missing_outside(cube):
    target = Grid((-0.5, 0.0, 0.25, 1.5, 3.0, 3.25), (9.5, 10.0, 10.75, 13.0, 14.0))
    got = result(regrid(cube(plane(SRC)), SRC, target))
    inside = {(la, lo) for la in (0.0, 0.25, 1.5, 3.0) for lo in (10.0, 10.75, 13.0)}
    assert set(got) == inside
    for (la, lo), (tas, pr) in got.items():
        assert tas == pytest.approx(1 + 2 * la - 0.5 * lo) and pr == pytest.approx(5.0)


def test_descending_axis_gives_the_same(cube):
    target = Grid((0.5, 1.25), (10.5, 12.75))
    rows = plane(SRC)
    up = result(regrid(cube(rows), grids.grid_of(cube(rows)), target))
    down = result(regrid(cube(rows[::-1]), grids.grid_of(cube(rows[::-1])), target))
    assert up == down and len(up) == 4


def test_identity_grid_returns_the_input(cube):
    df = cube(plane(SRC))
    assert result(regrid(df, SRC, SRC)) == result(df)


def test_missing_corner_makes_only_its_targets_missing(cube):
    rows = [r if (r[1], r[2]) != (1.0, 11.0) else (*r[:3], None, 5.0) for r in plane(SRC)]
    target = Grid((0.5, 1.0, 2.5), (10.5, 11.0, 12.0, 12.5))
    got = result(regrid(cube(rows), SRC, target))
    missing = {k for k, (tas, _) in got.items() if tas is None}
    assert missing == {(0.5, 10.5), (0.5, 11.0), (1.0, 10.5), (1.0, 11.0)}
    assert all(pr == pytest.approx(5.0) for _, pr in got.values())


def test_absent_source_row_counts_as_missing(cube):
    rows = [r for r in plane(SRC) if (r[1], r[2]) != (1.0, 11.0)]
    got = result(regrid(cube(rows), SRC, Grid((0.5, 2.5), (10.5, 12.5)), keep_missing=True))
    assert got[(0.5, 10.5)] == (None, None) and got[(2.5, 12.5)][0] is not None


def test_second_source_row_is_an_error(cube):
    rows = plane(SRC) + [plane(SRC)[5]]
    with pytest.raises(PySparkException, match="two source rows"):
        regrid(cube(rows), SRC, Grid((0.5,), (10.5,))).collect()


def test_nearest_tie_goes_up_and_edges_clamp(cube):
    got = result(regrid(cube(plane(SRC, c=0.0)), SRC, Grid((-4.0, 0.5, 1.4), (10.0, 99.0)), "nearest"))
    assert {la: tas for (la, lo), (tas, _) in got.items() if lo == 10.0} == {-4.0: 1.0, 0.5: 3.0, 1.4: 3.0}
    assert got[(0.5, 99.0)][0] == 3.0


def test_conservative_keeps_the_area_total(cube):
    rng = np.random.default_rng(3)
    source = Grid(tuple(np.arange(0.5, 8, 1.0).tolist()), tuple(np.arange(0.5, 6, 1.0).tolist()))
    target = Grid(tuple(np.arange(1.0, 8, 2.0).tolist()), tuple(np.arange(0.75, 6, 1.5).tolist()))
    rows = [(day(2000, 1), la, lo, float(rng.uniform(0, 9)), 0.0) for la in source.lat for lo in source.lon]

    def total(values, half_lat, half_lon):
        return sum(
            v * (math.sin(math.radians(la + half_lat)) - math.sin(math.radians(la - half_lat))) * 2 * half_lon
            for (la, lo), v in values.items()
        )

    got = {k: v[0] for k, v in result(regrid(cube(rows), source, target, "conservative")).items()}
    assert len(got) == target.size
    before = total({(r[1], r[2]): r[3] for r in rows}, 0.5, 0.5)
    assert total(got, 1.0, 0.75) == pytest.approx(before)


def test_conservative_weights_sum_to_one(spark):
    target = Grid((0.9, 1.7, 2.5), (10.5, 11.25, 12.0))
    w = grids.axis_weights(spark, {"g": SRC}, target, "conservative")
    sums = w.groupBy("axis", "dst").agg(F.sum("w").alias("s")).collect()
    assert len(sums) == 6 and all(r["s"] == pytest.approx(1.0) for r in sums)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    src=st.lists(st.integers(0, 400), min_size=2, max_size=8, unique=True),
    dst=st.lists(st.integers(-50, 450), min_size=1, max_size=8, unique=True),
)
def test_linear_weights_match_numpy(spark, src, dst):
    source = Grid(tuple(sorted(x / 8 for x in src)), (0.0, 1.0))
    target = Grid(tuple(sorted(x / 8 for x in dst)), (0.5,))
    values = {round(x * 1e6): (x * 7.3) % 5 for x in source.lat}
    got = {}
    for r in grids.axis_weights(spark, {"g": source}, target).filter("axis = 'lat'").collect():
        got[r["dst"]] = got.get(r["dst"], 0.0) + r["w"] * values[r["src_key"]]
    inside = [t for t in target.lat if source.lat[0] <= t <= source.lat[-1]]
    assert sorted(got) == inside
    want = np.interp(inside, source.lat, [values[round(x * 1e6)] for x in source.lat])
    assert [got[t] for t in inside] == pytest.approx(list(want))


def test_a_source_that_is_the_target_up_to_rounding(spark, cube):
    target = Grid((23.1, 24.1, 25.1), (60.3, 61.3))
    near = Grid(tuple(float(np.float32(x)) for x in target.lat), tuple(float(np.float32(x)) for x in target.lon))
    got = result(regrid(cube(plane(near)), near, target))
    assert set(got) == {(la, lo) for la in target.lat for lo in target.lon}
    rows = [(*r[:3], None, None) for r in plane(near)[:1]] + plane(near)[1:]
    assert len(regrid(cube(rows), near, target).collect()) == 5  # a cell without a value is dropped, as elsewhere
    with pytest.raises(PySparkException, match="two source rows"):
        regrid(cube(plane(near) + plane(near)[:1]), near, target).collect()


def test_border_keeps_its_rows_in_spite_of_rounding(cube):
    target = Grid((-2e-6, 1.5, 3.00001), (10.0, 13.0))
    got = result(regrid(cube(plane(SRC)), SRC, target))
    assert {la for la, _ in got} == set(target.lat)


def test_many_models_have_many_coordinates(spark):
    df = spark.range(450 * 60).selectExpr("cast(id % 450 as string) as model", "double(id div 450) as lat", "double(id div 450) + 0.5 as lon")
    found = grids.grids_of(df, "model")
    assert len(found) == 450 and found["7"].lat == tuple(float(i) for i in range(60))


def test_models_with_different_native_grids_in_one_plan(spark, cube):
    other = Grid((0.0, 2.0, 4.0), (10.0, 14.0))
    rows = [(*r, "a") for r in plane(SRC)] + [(*r, "b") for r in plane(other)]
    df = cube(rows, ("model",))
    found = grids.grids_of(df, "model")
    assert found == {"a": SRC, "b": other}
    target = Grid((0.5, 2.5), (10.5, 12.5))
    got = regrid(df, found, target, keys=("model", "time"), grid_key="model").collect()
    assert len(got) == 8
    assert all(r["tas"] == pytest.approx(1 + 2 * r["lat"] - 0.5 * r["lon"]) for r in got)


def test_regrid_plan_has_one_shuffle_and_no_nested_loop(spark, cube, tmp_path):
    cube(plane(SRC)).write.parquet(str(tmp_path / "c"))
    plan = plan_of(regrid(spark.read.parquet(str(tmp_path / "c")), SRC, Grid((0.5, 1.5), (10.5, 11.5))))
    assert plan.count("Exchange hashpartitioning") == 1
    # The bands before the shuffle, both axes' weights behind it: nothing is multiplied before.
    before, after = plan.split("Exchange hashpartitioning")
    assert after.count("BroadcastHashJoin") == 1 and before.count("BroadcastHashJoin") == 2
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


@pytest.mark.parametrize("method", grids.METHODS)
def test_shuffled_rows_are_the_source_rows_and_borders(spark, method):
    """A global regrid from 1 to 0.25 degrees sends on few more rows than the source has."""
    source = Grid(tuple(np.arange(-89.5, 90, 1.0).tolist()), (0.0, 1.0))
    target = Grid(tuple(np.arange(-89.375, 89.5, 0.25).tolist()), (0.5,))
    bands = [r["_bands"] for r in grids.weights_by_axis(grids.axis_weights(spark, {"g": source}, target, method), None)["bands"].collect()]
    assert len(bands) == 180 and max(map(len, bands)) <= 2 and sum(map(len, bands)) <= 1.3 * 180
    needed = {b for bs in bands for b in bs}
    assert needed == {int(t // 8) for t in target.lat}


def test_bands_give_the_same_cells_on_both_sides_of_a_border(cube):
    source = Grid((6.0, 7.0, 8.0, 9.0, 15.5, 16.5), (10.0, 11.0))
    target = Grid((6.25, 7.5, 7.999999, 8.0, 8.5, 15.75, 16.25), (10.5,))
    got = result(regrid(cube(plane(source)), source, target))
    assert len(got) == 7 and all(tas == pytest.approx(1 + 2 * la - 0.5 * lo) for (la, lo), (tas, _) in got.items())


def test_nearest_cell_ties_and_ends(spark):
    points = grids.points_table(spark, [(0.5, 10.49), (-3.0, 12.5), (2.2, 99.0)])
    got = [(r["grid_lat"], r["grid_lon"]) for r in grids.nearest_cell(points, SRC).orderBy("point").collect()]
    assert got == [(1.0, 10.0), (0.0, 13.0), (2.0, 13.0)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(axis=st.lists(st.integers(-40, 40), min_size=1, max_size=17, unique=True), points=st.lists(st.integers(-90, 90), min_size=1, max_size=30))
def test_nearest_cell_by_halving_equals_a_search_of_all(spark, axis, points):
    grid = Grid(tuple(sorted(x / 2 for x in axis)), (0.0,))
    df = grids.points_table(spark, [(p / 4, 1.0) for p in points])
    for r in grids.nearest_cell(df, grid).collect():
        assert r["grid_lat"] == min(grid.lat, key=lambda v: (abs(v - r["lat"]), -v)) and r["grid_lon"] == 0.0


def test_nearest_cell_has_no_filter_of_the_axis(spark):
    plan = plan_of(grids.nearest_cell(grids.points_table(spark, [(1.0, 1.0)]).repartition(2), SRC))
    assert "filter(" not in plan and "aggregate(" in plan and "Join" not in plan


def test_same_grid_tolerance():
    assert grids.same_grid(SRC, Grid(tuple(x + 1e-9 for x in SRC.lat), SRC.lon))
    assert not grids.same_grid(SRC, Grid(SRC.lat[:-1], SRC.lon))
    assert not grids.same_grid(SRC, Grid((0.0, 1.0, 2.0, 3.1), SRC.lon))


def test_grid_of_snaps_float_noise(cube):
    rows = [(day(2000, 1), 0.1 + 0.2, 10.0, 1.0, 1.0), (day(2000, 2), 0.3, 10.0, 1.0, 1.0)]
    assert len(grids.grid_of(cube(rows)).lat) == 1


def test_grid_table_and_axes(spark):
    rows = grids.grid_table(spark, SRC, "g").collect()
    assert len(rows) == 16 and len({r["cell_id"] for r in rows}) == 16
    assert {(r["lat_idx"], r["lon_idx"]) for r in rows} == {(i, j) for i in range(4) for j in range(4)}


def test_to_grid_is_dense_and_checks_rows(cube):
    rows = plane(SRC)[:5]
    dense = to_grid(cube(rows), SRC, ("tas",)).collect()
    assert len(dense) == 16 and sum(r["tas"] is not None for r in dense) == 5
    with pytest.raises(PySparkException, match="off the grid"):
        to_grid(cube(rows + [(day(2000, 1), 0.5, 10.0, 1.0, 1.0)]), SRC, ("tas",)).collect()
    with pytest.raises(PySparkException, match="two rows"):
        to_grid(cube(rows + rows[:1]), SRC, ("tas",)).collect()


def test_flatten_keeps_missing_cells(spark):
    df = spark.createDataFrame(
        [(day(2000, 1), [0.0, 1.0], [5.0, 6.0], [[1.0, None], [3.0, 4.0]])],
        "time timestamp_ntz, lats array<double>, lons array<double>, v array<array<double>>",
    )
    got = {(r["lat"], r["lon"]): r["value"] for r in flatten(df, "v").collect()}
    assert got == {(0.0, 5.0): 1.0, (0.0, 6.0): None, (1.0, 5.0): 3.0, (1.0, 6.0): 4.0}


def test_pivot_map_is_the_time_mean(cube):
    rows = [(day(2000, m), la, lo, float(m) + lo, 0.0) for m in (1, 3) for la in (0.0, 1.0) for lo in (-2.5, 6.0)]
    df = cube(rows)
    got = {r["lat"]: r.asDict() for r in pivot_map(df, "tas", grids.grid_of(df)).collect()}
    assert got[0.0]["lon_m2_5"] == pytest.approx(-0.5) and got[1.0]["lon_6"] == pytest.approx(8.0)
    with pytest.raises(ValueError):
        pivot_map(df, "tas", SRC, max_columns=1)


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        grids.axis_weights(spark, {"g": SRC}, SRC, "cubic")


def test_alignment_keeps_the_regrids_partitioning(spark, cube, tmp_path):
    from isohyet.operators.align import align_pred_obs
    from isohyet.operators.temporal import add_calendar

    target = Grid((0.5, 1.5), (10.5, 11.5))
    cube(plane(SRC)).write.parquet(str(tmp_path / "model"))
    cube(plane(target)).write.parquet(str(tmp_path / "obs"))
    model, obs = (add_calendar(spark.read.parquet(str(tmp_path / n))) for n in ("model", "obs"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = align_pred_obs(regrid(model, SRC, target, keys=("year", "month")), obs)
        plan = plan_of(pairs)
        # One exchange inside the regrid, one that brings the observations to it.
        assert plan.count("Exchange hashpartitioning") == 2
        assert pairs.count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
