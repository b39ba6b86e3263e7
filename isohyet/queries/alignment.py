"""Joins, set operations, features and the training table."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet.functions.calendar import month_start
from isohyet.operators import align, features
from isohyet.operators.quality import drop_report
from isohyet.plans.training import aligned_table, training_table
from isohyet.queries.base import (
    SPLITS, coarse, multi, observed, query, r6, raw_model, scored, status_log, table, target_months,
)
from isohyet.queries.grid import regridded
from isohyet.sources import manifest, registry

_SPLIT_SQL = """case when yr between 1995 and 1998 then 'train' when yr = 1999 then 'validation'
    when yr between 2000 and 2001 then 'test' end"""


def stamped_model(spark, sf):
    """The regridded cube stamped on the 1st in odd months, on the 16th in even ones."""
    cube = regridded(spark, sf)
    return cube.withColumn("time", month_start(F.col("year"), F.col("month")) + F.when(
        F.col("month") % 2 == 1, F.expr("INTERVAL '0' DAY")).otherwise(F.expr("INTERVAL '15' DAY")))


def frames(spark, sf):
    named = lambda df, t, p: df.withColumnsRenamed({"tas": t, "pr": p})
    return (
        named(observed(spark, sf), "cru_tmp", "cru_pre"), named(target_months(spark, sf), "era5_t2m", "era5_tp"),
        named(stamped_model(spark, sf), "gcm_tas", "gcm_pr"),
    )


_SIX = ", ".join(r6(e, n) for e, n in [
    ("o.tas", "cru_tmp"), ("o.pr", "cru_pre"), ("t.tas", "era5_t2m"), ("t.pr", "era5_tp"), ("g.tas", "gcm_tas"),
    ("g.pr", "gcm_pr")])
_ALIGNED = f"""select yr as year, mon as month, lat, lon, {_SIX} from obs o join tgt t using (yr, mon, lat, lon)
    join regridded g using (yr, mon, lat, lon)"""
_COLS = ["year", "month", "lat", "lon", "cru_tmp", "cru_pre", "era5_t2m", "era5_tp", "gcm_tas", "gcm_pr"]


def _aligned(spark, sf, mode):
    o, t, g = frames(spark, sf)
    joined = align.align([
        (o, ["cru_tmp", "cru_pre"]), (t, ["era5_t2m", "era5_tp"]), (g, ["gcm_tas", "gcm_pr"]),
    ], mode=mode)
    return joined.withColumns({"year": F.year("time"), "month": F.month("time")}).select(*_COLS)


@query("align_exact", _ALIGNED + " where mon % 2 = 1", ("obs", "tgt", "regridded"))
def _(spark, sf):
    return _aligned(spark, sf, "exact")


@query("align_month", _ALIGNED, ("obs", "tgt", "regridded"))
def _(spark, sf):
    return _aligned(spark, sf, "month")


@query("align_auto", _ALIGNED + " where mon % 2 = 1", ("obs", "tgt", "regridded"))
def _(spark, sf):
    return _aligned(spark, sf, "auto")


@query("align_auto_months", _ALIGNED, ("obs", "tgt", "regridded"))
def _(spark, sf):
    """No two sources share a time, so the months are matched."""
    o, t, g = frames(spark, sf)
    shift = lambda df, days: df.withColumn("time", F.col("time") + F.expr(f"INTERVAL '{days}' DAY"))
    joined = align.align([
        (o, ["cru_tmp", "cru_pre"]), (shift(t, 10), ["era5_t2m", "era5_tp"]), (shift(g, 5), ["gcm_tas", "gcm_pr"]),
    ], mode="auto")
    return joined.select(*_COLS)


@query("join_tas_pr", f"""select model, scenario, yr as year, mon as month, lat, lon, {r6('tas', 'gcm_tas_degC')},
    {r6('pr', 'gcm_pr_mm')} from multi where model not in ('1-URGENT', '5-LOW')""", ("multi",))
def _(spark, sf):
    cube = multi(spark, sf)
    # Each side lacks a model of its own.
    tas = cube.filter("model <> '1-URGENT'").withColumnRenamed("tas", "gcm_tas_degC").drop("pr")
    pr = cube.filter("model <> '5-LOW'").withColumnRenamed("pr", "gcm_pr_mm").drop("tas")
    return align.join_tas_pr(tas, pr).select(
        "model", "scenario", F.year("time").alias("year"), F.month("time").alias("month"), "lat", "lon",
        "gcm_tas_degC", "gcm_pr_mm",
    )


@query("subtract_fields", f"""select yr as year, mon as month, lat, lon, {r6('pt - ot', 'bias_tas')},
    {r6('pp - op', 'bias_pr')} from pairs""", ("pairs",))
def _(spark, sf):
    pairs = align.align_pred_obs(regridded(spark, sf), observed(spark, sf))
    return align.subtract_fields(pairs).select("year", "month", "lat", "lon", "bias_tas", "bias_pr")


@query("common_times", """select strftime(make_date(yr, mon, 1), '%Y-%m-%d 00:00:00') as time from (
    select distinct yr, mon from obs intersect select distinct yr, mon from gcm intersect
    select yr, mon from multi group by 1,2 having count(distinct model) = (select count(distinct model) from multi))""", ("obs", "gcm", "multi"))
def _(spark, sf):
    cube = multi(spark, sf)
    models = [cube.filter(F.col("model") == m) for m in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")]
    return align.common_times([observed(spark, sf), coarse(spark, sf), *models])


@query("keep_common_times", " union all ".join(
    f"select '{a}' as cube, yr as year, mon as month, lat, lon, {r6('tas', 'tas')}, {r6('pr', 'pr')} from {a} semi join {b} using (yr, mon)"
    for a, b in (("obs", "gcm"), ("gcm", "obs"))), ("obs", "gcm"))
def _(spark, sf):
    first, second = (
        df.select(F.lit(name).alias("cube"), "year", "month", "lat", "lon", "tas", "pr")
        for name, df in zip(("obs", "gcm"), align.keep_common_times([observed(spark, sf), coarse(spark, sf)])))
    return first.unionByName(second)


@query("merge_variables", f"""select model, scenario, yr as year, mon as month, lat, lon, {r6('a.tas', 'tas')},
    {r6('b.pr', 'pr')} from (select * from multi where model <> '1-URGENT') a
    full join (select * from multi where model <> '5-LOW') b using (model, scenario, yr, mon, lat, lon)""", ("multi",))
def _(spark, sf):
    cube = multi(spark, sf)
    merged = align.merge_variables(cube.filter("model <> '1-URGENT'").drop("pr"), cube.filter("model <> '5-LOW'").drop("tas"))
    return merged.select("model", "scenario", F.year("time").alias("year"), F.month("time").alias("month"),
                         "lat", "lon", "tas", "pr")


_LATEST = "select dataset, max(ts) as ts, max_by(status, (ts, status)) as status from status_log group by dataset"


@query("manifest_latest", f"select dataset, status, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts from ({_LATEST})", ("status_log",))
def _(spark, sf):
    return manifest.latest_status(status_log(spark, sf))


@query("pending_jobs", f"""select distinct p || '_' || c_custkey::varchar as dataset from customer
    cross join (select distinct o_orderpriority as p from orders)
    where p || '_' || c_custkey::varchar not in (select dataset from ({_LATEST}) where status = 'completed')""",
       ("status_log",))
def _(spark, sf):
    models = F.lit(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])
    wanted = table(spark, sf, "customer").select(F.explode(models).alias("model"), "c_custkey").select(
        F.concat_ws("_", "model", F.col("c_custkey").cast("string")).alias("dataset")
    ).distinct()
    return align.pending(wanted, status_log(spark, sf))


@query("batch_summary", "select status, count(*) as n from status_log group by status", ("status_log",))
def _(spark, sf):
    return manifest.batch_summary(status_log(spark, sf))


@query("failed_jobs", f"""select dataset, l.status || '@' || strftime(l.ts, '%Y-%m-%d') as error from (
    select dataset, max_by({{'status': status, 'ts': ts}}, (ts, status)) as l from status_log group by dataset)
    where l.status = 'failed'""", ("status_log",))
def _(spark, sf):
    rows = status_log(spark, sf).withColumn("error", F.concat_ws("@", "status", F.col("ts").cast("date").cast("string")))
    return manifest.failures(rows).select("dataset", "error")


@query("manifest_roundtrip", "select status, count(*) as n from status_log group by status", ("status_log",))
def _(spark, sf):
    from isohyet.queries.base import scratch

    path = f"{scratch(spark)}/manifest"
    rows = status_log(spark, sf).withColumns({"stage": F.lit("load"), "error": F.lit(None).cast("string")})
    rows.write.mode("append").parquet(path)
    return manifest.batch_summary(manifest.load(spark, path))


@query("complete_models", """select model, scenario from (
    select o_custkey as model, o_orderpriority as scenario, case when o_orderkey % 3 = 0 then 'tas' else 'pr' end as variable
    from orders) group by 1,2 having count(distinct variable) = 2""")
def _(spark, sf):
    outputs = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("model"), F.col("o_orderpriority").alias("scenario"),
        F.when(F.col("o_orderkey") % 3 == 0, "tas").otherwise("pr").alias("variable"),
    )
    return align.complete_models(outputs)


@query("stack_models", f"""select model, yr as year, mon as month, lat, lon, {r6('tas', 'tas')}, {r6('pr', 'pr')} from (
    select 'observed' as model, * from obs union all select 'target', * from tgt)""", ("obs", "tgt"))
def _(spark, sf):
    cubes = {"observed": observed(spark, sf), "target": target_months(spark, sf)}
    return align.stack_models(cubes).select("model", "year", "month", "lat", "lon", "tas", "pr")


@query("job_matrix", """select m.model, s.scenario, count(r.model) as n_rows from (select distinct o_orderpriority as model from orders) m
    cross join (values ('hist'), ('ssp126'), ('ssp585')) s(scenario)
    left join raw_model r on r.model = m.model and r.scenario = s.scenario group by 1,2""", ("raw_model",))
def _(spark, sf):
    models = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    jobs = align.job_matrix(spark, models, ["hist", "ssp126", "ssp585"])
    have = raw_model(spark, sf).groupBy("model", "scenario").agg(F.count(F.lit(1)).alias("n"))
    return jobs.join(have, ["model", "scenario"], "left").select(
        "model", "scenario", F.coalesce("n", F.lit(0)).alias("n_rows")
    )


_REGISTRY = """select 'dir' || (p_partkey % 97)::varchar as folder, 'models/dir' || (p_partkey % 97)::varchar || '/' ||
    split_part(p_name, ' ', 1) || case when p_size % 7 in (0, 1) then '_tas' when p_size % 7 = 2 then '_pr_occ'
    when p_size % 7 = 3 then '_pr_amt' when p_size % 7 = 4 then '_pr' else '_other' end as path from part"""
_PICK = "min(path) filter (where regexp_matches(path, '{}'))"


@query("select_models", f"""select folder, tas_path, case when occ is not null and amt is not null then occ end as occ_path,
    case when occ is not null and amt is not null then amt end as amt_path,
    case when occ is null or amt is null then pr end as pr_path, occ is not null and amt is not null as two_stage,
    tas_path is not null and pr is not null as complete from (
    select folder, {_PICK.format('_tas$')} as tas_path, {_PICK.format('_pr_occ')} as occ, {_PICK.format('_pr_amt')} as amt,
    {_PICK.format('_pr')} as pr from ({_REGISTRY}) group by folder)""")
def _(spark, sf):
    folder = F.concat(F.lit("dir"), (F.col("p_partkey") % 97).cast("string"))
    kind = F.col("p_size") % 7
    suffix = F.when(kind.isin(0, 1), "_tas").when(kind == 2, "_pr_occ").when(kind == 3, "_pr_amt").when(
        kind == 4, "_pr").otherwise("_other")
    rows = table(spark, sf, "part").select(
        folder.alias("folder"), F.concat(F.lit("models/"), folder, F.lit("/"), F.split_part("p_name", F.lit(" "), F.lit(1)), suffix).alias("path")
    )
    return registry.select_models(rows, ("folder",))


_TRAINING = f"""select yr as year, mon as month, lat, lon, {_SPLIT_SQL} as split, {r6('o.tas', 'cru_tmp_degC')},
    {r6('o.pr', 'cru_pre_mm')}, {r6('t.tas', 'era_t2m_degC')}, {r6('t.pr', 'era_tp_mm')}, {r6('g.tas', 'gcm_tas_degC')},
    {r6('g.pr', 'gcm_pr_mm')}, {r6('sin(2*pi()*mon/12)', 'month_sin')}, {r6('cos(2*pi()*mon/12)', 'month_cos')},
    {r6('ln(1+t.pr)', 'era_tp_log1p')}, {r6('ln(1+g.pr)', 'gcm_pr_log1p')}
    from obs o join tgt t using (yr, mon, lat, lon) join regridded g using (yr, mon, lat, lon)
    where t.tas is not null and t.pr is not null and g.tas is not null and g.pr is not null"""
_TRAINING_COLUMNS = [
    "year", "month", "lat", "lon", "split", "cru_tmp_degC", "cru_pre_mm", "era_t2m_degC", "era_tp_mm", "gcm_tas_degC",
    "gcm_pr_mm", "month_sin", "month_cos", "era_tp_log1p", "gcm_pr_log1p",
]
_NEED = ("obs", "tgt", "regridded")
TRAINING_SQL, TRAINING_TABLES = _TRAINING, _NEED


def training(spark, sf):
    return training_table(observed(spark, sf), target_months(spark, sf), stamped_model(spark, sf), splits=SPLITS)


@query("training_table", _TRAINING, _NEED)
def _(spark, sf):
    return training(spark, sf).select(*_TRAINING_COLUMNS)


@query("split_counts", f"select split, count(*) as n_rows from ({_TRAINING}) group by split", _NEED)
def _(spark, sf):
    return features.split_counts(training(spark, sf))


@query("split_by_year", f"select l_orderkey, l_linenumber, {_SPLIT_SQL} as split from scored", ("scored",))
def _(spark, sf):
    return features.split_by_year(scored(spark, sf), SPLITS).select("l_orderkey", "l_linenumber", "split")


@query("sample_splits", f"""select l_orderkey, l_linenumber, split from (select *, count(*) over (partition by split) as n,
        row_number() over (partition by split order by md5(l_orderkey::varchar || '|' || l_linenumber::varchar || '|42')) as k
        from (select l_orderkey, l_linenumber, {_SPLIT_SQL} as split from scored))
    where split is null or k <= round_even(case split when 'train' then 0.07::double when 'validation' then 0.2::double else 1.0::double end * n, 0)""", ("scored",))
def _(spark, sf):
    rows = features.split_by_year(scored(spark, sf), SPLITS, keep_unassigned=True)
    return features.sample_splits(rows, 0.07, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "split")


@query("training_drop_report", f"""select count(*) as rows_before, count(era5_t2m) as rows_after,
    count(*) - count(era5_t2m) as rows_dropped, {r6('(count(*) - count(era5_t2m))*100.0/count(*)', 'percent_dropped')}
    from ({_ALIGNED})""", _NEED)
def _(spark, sf):
    return drop_report(aligned_table(observed(spark, sf), target_months(spark, sf), stamped_model(spark, sf)))


@query("wet_share", f"select yr as year, {r6('avg(case when pr > 0 then 1.0 else 0.0 end)', 'wet_share')} from obs group by yr",
       ("obs",))
def _(spark, sf):
    return features.wet_share(observed(spark, sf), "pr", ["year"])


@query("feature_target", ", ".join([f"select {r6('g.pr', 'gcm_pr_mm')}", r6("g.tas", "gcm_tas_degC"), "lat", "lon",
       r6("sin(2*pi()*mon/12)", "month_sin"), r6("cos(2*pi()*mon/12)", "month_cos"), r6("t.tas", "era_t2m_degC")]) +
       """ from obs o join tgt t using (yr, mon, lat, lon) join regridded g using (yr, mon, lat, lon)
       where t.tas is not null and t.pr is not null and g.tas is not null and g.pr is not null""", _NEED)
def _(spark, sf):
    return features.feature_target(training(spark, sf), "temperature")


@query("feature_target_precip", ", ".join([f"select {r6('ln(1+g.pr)', 'gcm_pr_log1p')}", r6("g.tas", "gcm_tas_degC"), "lat", "lon",
       r6("sin(2*pi()*mon/12)", "month_sin"), r6("cos(2*pi()*mon/12)", "month_cos"), r6("ln(1+t.pr)", "era_tp_log1p")]) +
       """ from obs o join tgt t using (yr, mon, lat, lon) join regridded g using (yr, mon, lat, lon)
       where t.tas is not null and t.pr is not null and g.tas is not null and g.pr is not null""", _NEED)
def _(spark, sf):
    return features.feature_target(training(spark, sf), "precipitation")


@query("log_features", f"""select l_orderkey, l_linenumber, {r6('ln(1+l_quantity)', 'era_tp_log1p')},
    {r6('exp(ln(1+l_quantity)) - 1', 'era_tp_back')} from lineitem""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("era_tp_mm"))
    logged = features.add_log_features(rows, {"era_tp_mm": "era_tp_log1p"}).drop("era_tp_mm")
    return logged.withColumn("era_tp_back", F.expm1("era_tp_log1p"))


@query("calendar_features", f"""select l_orderkey, l_linenumber, year(l_shipdate)::int as year, month(l_shipdate)::int as month,
    {r6('sin(2*pi()*month(l_shipdate)/12)', 'month_sin')}, {r6('cos(2*pi()*month(l_shipdate)/12)', 'month_cos')} from lineitem""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("time"))
    return features.add_calendar_features(rows).drop("time")
