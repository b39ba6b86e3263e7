"""Metrics, climatologies, ensembles and change signals.

The regridded coarse cube stands for the prediction.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet.operators import classify, ensemble, evaluate
from isohyet.operators.align import align_pred_obs
from isohyet.operators.grids import grid_of
from isohyet.operators.learning import two_stage_combine
from isohyet.plans.scoring import diagnostics
from isohyet.queries.base import (
    POINTS, SEASON_SQL, TEST_YEARS, corr_sql, multi, observed, observed_points, query, r2_sql, r6, scored,
)
from isohyet.queries.grid import regridded, regridded_wide
from isohyet.queries.sqltext import linear_tables


def pairs(spark, sf, how="inner"):
    return align_pred_obs(regridded(spark, sf), observed(spark, sf), how=how)


_RMSE_T, _RMSE_P = "sqrt(avg((pt-ot)*(pt-ot)))", "sqrt(avg((pp-op)*(pp-op)))"
_CORR_T, _CORR_P = corr_sql("pt", "ot"), corr_sql("pp", "op")


@query("cell_metrics", f"""select lat, lon, count(*) filter (where pt is not null and ot is not null) as n_tas,
    {r6(_RMSE_T, 'rmse_tas')}, {r6(_CORR_T, 'corr_tas')},
    count(*) filter (where pp is not null and op is not null) as n_pr, {r6(_RMSE_P, 'rmse_pr')}, {r6(_CORR_P, 'corr_pr')}
    from pairs group by 1,2""", ("pairs",))
def _(spark, sf):
    return evaluate.cell_metrics(pairs(spark, sf)).drop("cell_id")


@query("cell_metrics_wide", f"""with {linear_tables('gcm_wide', 'obs_wide', 'wide', ('yr', 'mon'), extra='gcm_wide, obs_wide')},
    pairs as (select o.lat, o.lon, p.tas as pt, o.tas as ot, p.pr as pp, o.pr as op from wide p
        join obs_wide o using (yr, mon, lat, lon))
    select lat, lon, count(*) filter (where pt is not null and ot is not null) as n_tas,
    {r6(_RMSE_T, 'rmse_tas')}, {r6(_CORR_T, 'corr_tas')},
    count(*) filter (where pp is not null and op is not null) as n_pr, {r6(_RMSE_P, 'rmse_pr')}, {r6(_CORR_P, 'corr_pr')}
    from pairs group by 1,2""")
def _(spark, sf):
    wide = align_pred_obs(regridded_wide(spark, sf), observed(spark, sf, 60, 72))
    return evaluate.cell_metrics(wide).drop("cell_id")


@query("cell_rmse", f"select lat, lon, {r6(_RMSE_T, 'rmse_tas')}, {r6(_RMSE_P, 'rmse_pr')} from pairs group by 1,2", ("pairs",))
def _(spark, sf):
    return evaluate.cell_rmse(pairs(spark, sf)).drop("cell_id")


@query("cell_correlation", f"select lat, lon, {r6(_CORR_T, 'corr_tas')}, {r6(_CORR_P, 'corr_pr')} from pairs group by 1,2", ("pairs",))
def _(spark, sf):
    return evaluate.cell_correlation(pairs(spark, sf)).drop("cell_id")


@query("mean_of_cell_metric", f"""select {r6('avg(rt)', 'rmse_tas')}, {r6('avg(ct)', 'corr_tas')}, {r6('avg(rp)', 'rmse_pr')},
    {r6('avg(cp)', 'corr_pr')} from (select lat, lon, {_RMSE_T} as rt, {_CORR_T} as ct, {_RMSE_P} as rp, {_CORR_P} as cp
    from pairs group by 1,2)""", ("pairs",))
def _(spark, sf):
    return evaluate.mean_of_cell_metric(pairs(spark, sf))


@query("mae_bias", f"""select {r6('avg(abs(pt-ot))', 'mae_tas')}, {r6('avg(pt-ot)', 'bias_tas')}, {r6('avg(abs(pp-op))', 'mae_pr')},
    {r6('avg(pp-op)', 'bias_pr')} from pairs""", ("pairs",))
def _(spark, sf):
    return evaluate.mae_bias(pairs(spark, sf))


@query("spatial_mean", f"select yr as year, mon as month, {r6('avg(tas)', 'tas')}, {r6('avg(pr)', 'pr')} from obs group by 1,2", ("obs",))
def _(spark, sf):
    return evaluate.spatial_mean(observed(spark, sf))


@query("seasonal_climatology", f"select {SEASON_SQL} as season, lat, lon, {r6('avg(tas)', 'tas')}, {r6('avg(pr)', 'pr')} from obs group by 1,2,3", ("obs",))
def _(spark, sf):
    return evaluate.seasonal_climatology(observed(spark, sf))


@query("monthly_climatology", f"select mon as month, lat, lon, {r6('avg(tas)', 'tas')}, {r6('avg(pr)', 'pr')} from obs group by 1,2,3", ("obs",))
def _(spark, sf):
    return evaluate.monthly_climatology(observed(spark, sf))


_MAPS = f"""select {SEASON_SQL} as season, lat, lon, avg(pt) as pt, avg(ot) as ot, avg(pp) as pp, avg(op) as op
    from {{}} group by 1,2,3"""


@query("pattern_correlation", f"select season, {r6(_CORR_T, 'pattern_corr_tas')}, {r6(_CORR_P, 'pattern_corr_pr')} "
       f"from ({_MAPS.format('sides')}) group by season", ("sides",))
def _(spark, sf):
    return evaluate.pattern_correlation(pairs(spark, sf, "full_outer"))


def _nearest_sql(v: str, axis: str) -> str:
    return f"(select first(g.v order by abs(g.v - {v}), -g.v) from axes_dst g where g.axis = '{axis}')"


_POINTS_SQL = "(values " + ", ".join(f"({i}, {la}::double, {lo}::double)" for i, (la, lo) in enumerate(POINTS)) + ") p(point, plat, plon)"
_LOCATED = f"""located as (select point, plat, plon, {_nearest_sql('plat', 'lat')} as glat, {_nearest_sql('plon', 'lon')} as glon
    from {_POINTS_SQL})"""
_SERIES = """select point, plat as lat, plon as lon, yr as year, mon as month, pt as pred, ot as obs from located
    join sides on lat = glat and lon = glon"""


@query("point_series", f"select point::int as point, lat, lon, year, month, {r6('pred', 'pred')}, {r6('obs', 'obs')} "
       f"from (with {_LOCATED} {_SERIES})", ("sides", "axes_dst"))
def _(spark, sf):
    pred, obs = regridded(spark, sf), observed(spark, sf)
    grid = grid_of(observed_points(spark, sf))
    return evaluate.point_series(pred, obs, grid, grid, "tas", POINTS)


@query("point_metrics", f"""select point::int as point, lat, lon, {r6('sqrt(avg((pred-obs)*(pred-obs)))', 'rmse')},
    {r6('avg(abs(pred-obs))', 'mae')}, {r6('avg(pred-obs)', 'bias')}, {r6(corr_sql('pred', 'obs'), 'corr')}
    from (with {_LOCATED} {_SERIES}) group by 1,2,3""", ("sides", "axes_dst"))
def _(spark, sf):
    pred, obs = regridded(spark, sf), observed(spark, sf)
    grid = grid_of(observed_points(spark, sf))
    return evaluate.point_metrics(pred, obs, grid, grid, "tas", POINTS)


def _report_sql() -> str:
    test = "(select * from sides where yr between 2000 and 2001)"
    per_cell = f"(select lat, lon, {_RMSE_T} as rt, {_CORR_T} as ct, {_RMSE_P} as rp, {_CORR_P} as cp from {test} group by 1,2)"
    rows = []
    for v, r, c, p, o in (("tas", "rt", "ct", "pt", "ot"), ("pr", "rp", "cp", "pp", "op")):
        for metric, expr, source in (
            ("rmse", f"avg({r})", per_cell), ("mae", f"avg(abs({p}-{o}))", test), ("bias", f"avg({p}-{o})", test),
            ("spatial_corr", f"avg({c})", per_cell),
        ):
            rows.append(f"select 'all' as scope, '{v}' as variable, '{metric}' as metric, {r6(expr, 'value')} from {source}")
        rows.append(f"select season, '{v}', 'pattern_corr', {r6(corr_sql(p, o), 'value')} from ({_MAPS.format(test)}) group by season")
    return " union all ".join(rows)


@query("test_report", _report_sql(), ("sides",))
def _(spark, sf):
    return evaluate.evaluate_test_period(regridded(spark, sf), observed(spark, sf), TEST_YEARS)


_D = "(y_pred-y_true)"


@query("regression_metrics", f"""select yr as year, {r6(f'sqrt(avg({_D}*{_D}))', 'rmse')}, {r6(f'avg(abs({_D}))', 'mae')},
    {r6(r2_sql('y_pred', 'y_true'), 'r2')}, {r6(f'avg({_D})', 'bias')} from scored group by yr""", ("scored",))
def _(spark, sf):
    return evaluate.regression_metrics(scored(spark, sf), "y_true", "y_pred", ["year"])


def _three(p: str, y: str, tag: str) -> str:
    d = f"({p}-{y})"
    return ", ".join([r6(f"sqrt(avg({d}*{d}))", f"rmse_{tag}"), r6(f"avg(abs{d})", f"mae_{tag}"), r6(r2_sql(p, y), f"r2_{tag}")])


@query("log_and_mm_metrics", f"""select yr as year, {_three('p', 'y', 'log')}, {_three('(exp(p)-1)', '(exp(y)-1)', 'mm')}
    from (select yr, ln(1+y_pred) as p, ln(1+y_true) as y from scored) group by yr""", ("scored",))
def _(spark, sf):
    rows = scored(spark, sf).select("year", F.log1p("y_pred").alias("p"), F.log1p("y_true").alias("y"))
    return evaluate.log_and_mm_metrics(rows, "y", "p", ["year"])


_CLASSES = f"""{r6('avg(case when (wet = 1) = (p_wet > 0.5) then 1.0 else 0.0 end)', 'accuracy')},
    {r6('coalesce(count(*) filter (where wet = 1 and p_wet > 0.5)/nullif(count(*) filter (where p_wet > 0.5), 0), 0)', 'precision')},
    {r6('coalesce(count(*) filter (where wet = 1 and p_wet > 0.5)/nullif(count(*) filter (where wet = 1), 0), 0)', 'recall')},
    {r6('(sum(case when wet = 1 then rk end) - sum(wet)*(sum(wet)+1)/2.0)/nullif(sum(wet)::double*(count(*)-sum(wet)), 0)', 'roc_auc')}"""
_RANKED = """select *, avg(rn) over (partition by yr, p_wet) as rk from (
    select *, row_number() over (partition by yr order by p_wet) as rn from scored)"""


@query("classification_metrics", f"select yr as year, {_CLASSES} from ({_RANKED}) group by yr", ("scored",))
def _(spark, sf):
    return classify.classification_metrics(scored(spark, sf), "wet", "p_wet", keys=["year"])


@query("auc_rank", """select score, count(*) as n, avg(rn) as rank from (
    select floor(y_pred*100) as score, row_number() over (order by floor(y_pred*100)) as rn from scored) group by score""", ("scored",))
def _(spark, sf):
    rows = scored(spark, sf).withColumn("score", F.floor(F.col("y_pred") * 100).cast("double"))
    return classify.tied_ranks(rows, "score", ranges=16)


_TWO_STAGE = "p_wet * greatest(exp(ln(1+y_pred)) - 1, 0)"


@query("two_stage_combine", f"select l_orderkey, l_linenumber, {r6(_TWO_STAGE, 'pred_pr')} from scored", ("scored",))
def _(spark, sf):
    return scored(spark, sf).select(
        "l_orderkey", "l_linenumber", two_stage_combine(F.col("p_wet"), F.log1p("y_pred")).alias("pred_pr")
    )


@query("two_stage_metrics", f"""select yr as year, {r6('sqrt(avg((p-y_true)*(p-y_true)))', 'rmse')}, {r6('avg(abs(p-y_true))', 'mae')},
    {r6(r2_sql('p', 'y_true'), 'r2')}, {r6('avg(case when y_true > 0 then 1.0 else 0.0 end)', 'obs_wet_fraction')},
    {r6('avg(case when p > 0 then 1.0 else 0.0 end)', 'pred_wet_fraction')}
    from (select *, {_TWO_STAGE} as p from scored) group by yr""", ("scored",))
def _(spark, sf):
    rows = scored(spark, sf).withColumn("p", two_stage_combine(F.col("p_wet"), F.log1p("y_pred")))
    return evaluate.two_stage_metrics(rows, "y_true", "p", ["year"])


@query("scatter_stats", f"""select yr as year, count(*) as n, {r6(f"power({corr_sql('y_pred', 'y_true')}, 2)", 'r2')},
    {r6(f'sqrt(avg({_D}*{_D}))', 'rmse')}, {r6(f'avg({_D})', 'bias')} from scored group by yr""", ("scored",))
def _(spark, sf):
    return evaluate.scatter_stats(scored(spark, sf), "y_true", "y_pred", ["year"])


def _bin(v: str, lo: str, hi: str) -> str:
    return f"least(floor(({v}-{lo})/(({hi}-{lo})/50))::int, 49)"


@query("density_bins", f"""select {_bin('y_true', 'x0', 'x1')} as x_bin, {_bin('y_pred', 'y0', 'y1')} as y_bin, count(*) as n
    from scored, (select min(y_true) as x0, max(y_true) as x1, min(y_pred) as y0, max(y_pred) as y1 from scored) group by 1,2""", ("scored",))
def _(spark, sf):
    return evaluate.density_bins(scored(spark, sf), "y_true", "y_pred")


_HEXAGON = """with box as (select min(y_true) as x0, max(y_true) as x1, min(y_pred) as y0, max(y_pred) as y1 from scored),
    uv as (select (y_true - x0)/((x1 - x0)/50) as u, (y_pred - y0)/((y1 - y0)/28) as v from scored, box),
    around as (select u, v, floor(u + 0.5) as i1, floor(v + 0.5) as j1, floor(u) as i2, floor(v) as j2 from uv),
    cell as (select *, (u - (i2 + 0.5))*(u - (i2 + 0.5)) + 3*(v - (j2 + 0.5))*(v - (j2 + 0.5)) <= (u - i1)*(u - i1) + 3*(v - j1)*(v - j1) as o from around)
    select o::int as lattice, (case when o then i2 else i1 end)::bigint as i, (case when o then j2 else j1 end)::bigint as j, count(*) as n
    from cell group by 1, 2, 3"""


@query("hexagon_bins", "select * from (" + _HEXAGON + ")", ("scored",))
def _(spark, sf):
    return evaluate.hexagon_bins(scored(spark, sf), "y_true", "y_pred").select("lattice", "i", "j", "n")


def _bias_sql(season: str) -> str:
    """Maps of both variables; `season` is a column of the statement or empty."""
    s = f"{season}, " if season else ""
    part = f"partition by {season}" if season else ""
    own = f"{SEASON_SQL} as season, " if season else ""
    group = "1,2,3" if season else "1,2"
    return " union all ".join(f"""select '{v}' as variable, {s}lat, lon, {r6('p', 'pred_mean')}, {r6('o', 'obs_mean')}, {r6('p-o', 'bias')},
        {r6(f'max(abs(p-o)) over ({part})', '"limit"')} from (select {own}lat, lon, avg({p}) as p, avg({o}) as o from pairs group by {group})"""
                              for v, p, o in (("tas", "pt", "ot"), ("pr", "pp", "op")))


@query("bias_map", _bias_sql(""), ("pairs",))
def _(spark, sf):
    return evaluate.bias_maps(pairs(spark, sf)).drop("cell_id")


@query("seasonal_bias_map", _bias_sql("season"), ("pairs",))
def _(spark, sf):
    return evaluate.bias_maps(pairs(spark, sf), by_season=True).drop("cell_id")


@query("prediction_summary", "select model, scenario, " + ", ".join(
    r6(f"{f}({v})", f"{n}_pred_{v}") for v in ("tas", "pr") for n, f in (("min", "min"), ("max", "max"), ("mean", "avg"))
) + " from multi group by 1,2", ("multi",))
def _(spark, sf):
    return evaluate.prediction_summary(multi(spark, sf).withColumnsRenamed({"tas": "pred_tas", "pr": "pred_pr"}))


@query("fit_diagnostics", f"""select yr as year, mon as month, {r6('rt', 'raw_tas')}, {r6('rp', 'raw_pr')}, {r6('dt', 'downscaled_tas')},
    {r6('dp', 'downscaled_pr')} from (select yr, mon, avg(tas) as rt, avg(pr) as rp from gcm group by 1,2)
    full join (select yr, mon, avg(tas) as dt, avg(pr) as dp from regridded group by 1,2) using (yr, mon)""", ("gcm", "regridded"))
def _(spark, sf):
    from isohyet.queries.base import coarse

    down = regridded(spark, sf).withColumnsRenamed({"tas": "pred_tas", "pr": "pred_pr"})
    return diagnostics(coarse(spark, sf), down, ("year", "month"))


_ENSEMBLE = "select scenario, yr as year, mon as month, lat, lon, {} from multi group by 1,2,3,4,5"


@query("ensemble_mean", _ENSEMBLE.format(f"{r6('avg(tas)', 'tas')}, {r6('avg(pr)', 'pr')}"), ("multi",))
def _(spark, sf):
    return ensemble.ensemble_mean(multi(spark, sf))


@query("ensemble_std", _ENSEMBLE.format(f"{r6('stddev_pop(tas)', 'tas')}, {r6('stddev_pop(pr)', 'pr')}"), ("multi",))
def _(spark, sf):
    return ensemble.ensemble_std(multi(spark, sf))


@query("ensemble_stats", _ENSEMBLE.format(
    f"count(*) as n_models, {r6('avg(tas)', 'tas_mean')}, {r6('avg(pr)', 'pr_mean')}, {r6('stddev_pop(tas)', 'tas_std')}, "
    f"{r6('stddev_pop(pr)', 'pr_std')}"), ("multi",))
def _(spark, sf):
    return ensemble.ensemble_stats(multi(spark, sf))


_STATS = """select scenario, yr, lat, lon, mon, avg(tas) as tm, avg(pr) as pm, stddev_pop(tas) as ts, stddev_pop(pr) as ps
    from multi group by 1,2,3,4,5"""
_CHANGE = f"""select 'ssp585' as scenario, {{}} from (select
    avg(tm) filter (where scenario = 'hist' and yr between 1995 and 1998) as bt,
    avg(pm) filter (where scenario = 'hist' and yr between 1995 and 1998) as bp,
    avg(tm) filter (where scenario = 'ssp585' and yr between 2000 and 2001) as ft,
    avg(pm) filter (where scenario = 'ssp585' and yr between 2000 and 2001) as fp,
    avg(ts) filter (where scenario = 'ssp585') as st, avg(ps) filter (where scenario = 'ssp585') as sp from ({_STATS}))"""


def _change(spark, sf):
    return ensemble.change_signal(ensemble.ensemble_stats(multi(spark, sf)), (2000, 2001), (1995, 1998))


@query("change_signal", _CHANGE.format(", ".join(r6(e, n) for e, n in [
    ("bt", "base_tas"), ("ft", "future_tas"), ("ft-bt", "change_tas"), ("st", "spread_tas")])), ("multi",))
def _(spark, sf):
    return _change(spark, sf).select("scenario", "base_tas", "future_tas", "change_tas", "spread_tas")


@query("change_percent", _CHANGE.format(", ".join(r6(e, n) for e, n in [
    ("bp", "base_pr"), ("fp", "future_pr"), ("fp-bp", "change_pr"), ("(fp-bp)*100/bp", "change_percent_pr"), ("sp", "spread_pr")])), ("multi",))
def _(spark, sf):
    return _change(spark, sf).select("scenario", "base_pr", "future_pr", "change_pr", "change_percent_pr", "spread_pr")
