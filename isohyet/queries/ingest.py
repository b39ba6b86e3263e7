"""Sources, conversions, filters, quality rules and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet.constants import OUTPUT_ATTRIBUTES, RANGES, TARGET_RESOLUTION, VARIABLE_ALIASES
from isohyet.functions import units
from isohyet.functions.coords import cell_key
from isohyet.functions.names import dataset_name
from isohyet.operators import naming, profile as prof, quality, temporal
from isohyet.operators.features import scoring_features, prepare_features, sample_rows, wet_only
from isohyet.operators.grids import grid_of
from isohyet.queries.base import (
    coarse, multi, observed, observed_points, query, r6, raw_calendar, raw_model, raw_target, scored, scratch, table,
)
from isohyet.sources import cubes, sinks
from isohyet.queries.sqltext import linear_tables

STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"


@query("read_reference", f"select yr as year, mon as month, lat, lon, {r6('tas', 'tas')}, {r6('pr', 'pr')} "
       "from obs where yr between 1996 and 2000", ("obs",))
def _(spark, sf):
    raw = observed(spark, sf).withColumnsRenamed({"tas": "tmp", "pr": "pre"})
    cube, _grid = cubes.read_reference(raw, (1996, 2000))
    return cube.select("year", "month", "lat", "lon", "tas", "pr")


@query("read_target", f"""
    with {linear_tables('monthly', 'obs', 'tgt', ('yr', 'mon'), extra='''raw_target, obs''')}
    select yr as year, mon as month, lat, lon, {r6('tas', 'tas')}, {r6('pr', 'pr')} from tgt""")
def _(spark, sf):
    grid = grid_of(observed_points(spark, sf))
    cube = cubes.read_target(raw_target(spark, sf), grid, (1996, 2000))
    return cube.select("year", "month", "lat", "lon", "tas", "pr")


_MODEL_ROWS = f"""select o_orderkey, model, scenario, {STAMP.format('time')} as time, lat, lon,
    {r6('tas', 'tas')}, {r6('pr_day*30', 'pr')} from raw_model"""


@query("read_model_conditional_clip", _MODEL_ROWS + " where scenario <> 'hist' or year(time) between 1996 and 1997",
       ("raw_model",))
def _(spark, sf):
    cube = cubes.read_model(raw_model(spark, sf), years=(1996, 1997))
    return cube.select("o_orderkey", "model", "scenario", "time", "lat", "lon", "tas", "pr")


@query("read_model_regridded", f"""
    with {linear_tables('multi_mm', 'obs', 'out', ('model', 'scenario', 'yr', 'mon'), extra='multi, obs')}
    select model, scenario, yr as year, mon as month, lat, lon, {r6('tas', 'tas')}, {r6('pr', 'pr')} from out""")
def _(spark, sf):
    grid = grid_of(observed_points(spark, sf))
    raw = multi(spark, sf).withColumnsRenamed({"tas": "TMP", "pr": "PRE"})
    cube = cubes.read_model(raw, grid, years=(1995, 1998))
    return cube.select("model", "scenario", F.year("time").alias("year"), F.month("time").alias("month"),
                       "lat", "lon", "tas", "pr")


@query("read_processed", f"select yr as year, mon as month, lat, lon, {r6('tas', 'cru_tmp')}, {r6('pr', 'cru_pre')}, "
       f"{r6('tas', 'era5_t2m')}, {r6('pr', 'era5_tp')}, {r6('gt', 'gcm_tas')}, {r6('gp', 'gcm_pr')} from obs "
       "join (select yr, mon, lat as la, lon as lo, tas as gt, pr as gp from gcm) g using (yr, mon) "
       "where la = 22.5 + floor(lat - 22.5) and lo = 60 + floor(lon - 60)", ("obs", "gcm"))
def _(spark, sf):
    folder = scratch(spark)
    obs = observed(spark, sf)
    sinks.write_table(obs.withColumnsRenamed({"tas": "temperature", "pr": "precipitation"}), f"{folder}/cru_old")
    sinks.write_table(obs.withColumnsRenamed({"tas": "t2m", "pr": "tp"}), f"{folder}/era5")
    sinks.write_table(coarse(spark, sf).withColumnsRenamed({"tas": "TMP", "pr": "PRE"}), f"{folder}/gcm")
    data = cubes.read_processed(spark, {
        "cru": [f"{folder}/cru", f"{folder}/cru_old"], "era5": [f"{folder}/era5"], "gcm": [f"{folder}/gcm"],
    })
    home = (F.lit(22.5) + F.floor(F.col("lat") - 22.5), F.lit(60.0) + F.floor(F.col("lon") - 60))
    left = data["cru"].withColumn("home", cell_key(*home))
    right = data["gcm"].select("year", "month", cell_key(F.col("lat"), F.col("lon")).alias("home"), "gcm_tas", "gcm_pr")
    middle = data["era5"].select("time", "lat", "lon", "era5_t2m", "era5_tp")
    return left.join(right, ["year", "month", "home"]).join(middle, ["time", "lat", "lon"]).select(
        "year", "month", "lat", "lon", "cru_tmp", "cru_pre", "era5_t2m", "era5_tp", "gcm_tas", "gcm_pr"
    )


_FEATURES = f"""select model, scenario, yr as year, mon as month, lat, lon, {r6('tas', 'gcm_tas_degC')},
    {r6('pr', 'gcm_pr_mm')}, {r6('sin(2*pi()*mon/12)', 'month_sin')}, {r6('cos(2*pi()*mon/12)', 'month_cos')},
    {r6('ln(1+pr)', 'gcm_pr_log1p')} from multi"""
_FEATURE_COLUMNS = ["model", "scenario", "year", "month", "lat", "lon", "gcm_tas_degC", "gcm_pr_mm", "month_sin",
                    "month_cos", "gcm_pr_log1p"]


@query("read_future", _FEATURES, ("multi",))
def _(spark, sf):
    folder = scratch(spark)
    cube = multi(spark, sf)
    keys = ["model", "scenario", "time", "lat", "lon"]
    sinks.write_table(cube.select(*keys, "tas"), f"{folder}/tas", ("scenario", "model"))
    sinks.write_table(cube.select(*keys, "pr"), f"{folder}/pr", ("scenario", "model"))
    return cubes.read_future(spark, f"{folder}/tas", f"{folder}/pr").select(*_FEATURE_COLUMNS)


@query("prepare_features", _FEATURES, ("multi",))
def _(spark, sf):
    cube = multi(spark, sf)
    keys = ["model", "scenario", "time", "lat", "lon"]
    tas = cube.select(*keys, F.col("tas").alias("gcm_tas_degC"))
    pr = cube.select(*keys, F.col("pr").alias("gcm_pr_mm"))
    return prepare_features(tas, pr).select(*_FEATURE_COLUMNS)


@query("scoring_features", _FEATURES, ("multi",))
def _(spark, sf):
    cube = multi(spark, sf).withColumnsRenamed({"tas": "gcm_tas_degC", "pr": "gcm_pr_mm"})
    return scoring_features(cube).select(*_FEATURE_COLUMNS)


@query("convert_units", f"select {STAMP.format('time')} as time, lat, lon, {r6('t2m - 273.15', 'tas')}, "
       f"{r6('tp*1000', 'pr')} from raw_target", ("raw_target",))
def _(spark, sf):
    return cubes.convert_target(raw_target(spark, sf)).select("time", "lat", "lon", "tas", "pr")


@query("month_lengths", f"""select o_orderkey, {r6('pr_day*30', 'pr_fixed')},
    {r6('pr_day*day(last_day(time))', 'pr_exact')} from raw_model""", ("raw_model",))
def _(spark, sf):
    rows = raw_model(spark, sf)
    return rows.select(
        "o_orderkey", units.per_day_to_per_month(F.col("PRE")).alias("pr_fixed"),
        units.per_day_to_per_month(F.col("PRE"), F.col("TIME"), exact_days=True).alias("pr_exact"),
    )


@query("guarded_convert", f"""select time, dataset, lat, lon,
    {r6("case when max(tas) over (partition by dataset) > 100 then tas - 273.15 else tas end", 'tas')},
    {r6("case when max(pr) over (partition by dataset) < 10 then pr*1000 else pr end", 'pr')} from (
    select {STAMP.format('time')} as time, 'kelvin_metres' as dataset, lat, lon, t2m as tas, tp as pr from raw_target
    union all select {STAMP.format('time')}, 'celsius_mm', lat, lon, t2m - 273.15, tp*1000 from raw_target)""",
       ("raw_target",))
def _(spark, sf):
    raw = naming.rename_coords(raw_target(spark, sf), {"valid_time": "time", "latitude": "lat", "longitude": "lon"})
    first = raw.select("time", F.lit("kelvin_metres").alias("dataset"), "lat", "lon", F.col("t2m").alias("tas"),
                       F.col("tp").alias("pr"))
    second = first.withColumns({"dataset": F.lit("celsius_mm"), "tas": F.col("tas") - 273.15, "pr": F.col("pr") * 1000})
    return quality.guarded_convert(first.unionByName(second), "target", ["dataset"])


@query("guarded_convert_model", f"""select o_orderkey, dataset,
    {r6("case when max(tas) over (partition by dataset) > 100 then tas - 273.15 else tas end", 'tas')},
    {r6("case when max(pr) over (partition by dataset) < 1 then pr*2592000 else pr end", 'pr')} from (
    select o_orderkey, 'kelvin_flux' as dataset, tas + 273.15::double as tas, pr_day/86400 as pr from raw_model
    union all select o_orderkey, 'celsius_month', tas/10, pr_day*30 from raw_model)""", ("raw_model",))
def _(spark, sf):
    raw = raw_model(spark, sf).select("o_orderkey", F.col("TMP").alias("tas"), F.col("PRE").alias("pr"))
    first = raw.select("o_orderkey", F.lit("kelvin_flux").alias("dataset"), (F.col("tas") + 273.15).alias("tas"), (F.col("pr") / 86400).alias("pr"))
    second = raw.select("o_orderkey", F.lit("celsius_month").alias("dataset"), (F.col("tas") / 10).alias("tas"), (F.col("pr") * 30).alias("pr"))
    return quality.guarded_convert(first.unionByName(second), "model", ["dataset"])


@query("standardize_coords", f"select {STAMP.format('o_orderdate')} as time, "
       "22.5::double + (o_custkey % 5) as lat, 60.0::double + (o_orderkey % 5) as lon, o_totalprice as tas, "
       "o_totalprice as longwave, o_totalprice as latent_heat from orders")
def _(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("Valid_Time"), (F.lit(22.5) + F.col("o_custkey") % 5).alias("LATITUDE"),
        (F.lit(60.0) + F.col("o_orderkey") % 5).alias("nav_lon"), F.col("o_totalprice").alias("tas"),
        F.col("o_totalprice").alias("longwave"), F.col("o_totalprice").alias("latent_heat"),
    )
    return naming.standardize_coords(raw, values=("tas", "longwave", "latent_heat"))


@query("alias_variable", f"select {r6('l_quantity', 'cru_tmp')}, {r6('l_discount', 'cru_pre')}, l_orderkey, l_linenumber "
       "from lineitem")
def _(spark, sf):
    raw = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("temperature"), F.col("l_discount").alias("pr"),
    )
    one = naming.alias_variable(raw, VARIABLE_ALIASES["cru_tmp"], "cru_tmp")
    return naming.alias_variable(one, VARIABLE_ALIASES["cru_pre"], "cru_pre")


@query("clip_nonneg", f"select l_orderkey, l_linenumber, {r6('greatest(l_quantity - 25, 0)', 'pr')} from lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", units.clip_nonneg(F.col("l_quantity") - 25).alias("pr")
    )


@query("to_float32", f"select l_orderkey, l_linenumber, {r6('(l_quantity/8)::float', 'tas')} from lineitem")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 8).alias("tas"))
    return naming.to_float32(rows, ["tas"])


@query("decode_calendar", """select l_orderkey, l_linenumber, strftime(t, '%Y-%m-%d %H:%M:%S') as time, v from (
    select *, try_cast(printf('%04d-%02d-%02d', y, m, d) as timestamp) as t from raw_calendar) where t is not null""",
       ("raw_calendar",))
def _(spark, sf):
    return temporal.decode_calendar(raw_calendar(spark, sf)).select("l_orderkey", "l_linenumber", "time", "v")


@query("calendar_report", """select count(*) as n_rows, count(*) filter (where
    try_cast(printf('%04d-%02d-%02d', y, m, d) as timestamp) is null) as n_impossible from raw_calendar""",
       ("raw_calendar",))
def _(spark, sf):
    return temporal.calendar_report(raw_calendar(spark, sf))


@query("parse_time", """select l_orderkey, l_linenumber, strftime(try_cast(s as timestamp), '%Y-%m-%d %H:%M:%S') as time
    from (select *, printf('%04d-%02d-%02d', y, m, d) as s from raw_calendar)""", ("raw_calendar",))
def _(spark, sf):
    text = F.format_string("%04d-%02d-%02d", "y", "m", "d")
    rows = raw_calendar(spark, sf).withColumn("stamp", text)
    return temporal.parse_times(rows, "stamp").select("l_orderkey", "l_linenumber", "time")


@query("resample_monthly", f"""select strftime(date_trunc('month', time), '%Y-%m-%d %H:%M:%S') as time,
    year(time)::int as year, month(time)::int as month, lat, lon, {r6('avg(t2m - 273.15)', 'tas')},
    {r6('sum(tp*1000)', 'pr')} from raw_target group by all""".replace("group by all", "group by 1,2,3,4,5"),
       ("raw_target",))
def _(spark, sf):
    cube = cubes.convert_target(raw_target(spark, sf))
    return temporal.resample_monthly(cube, {"tas": "mean", "pr": "sum"})


@query("clip_years", f"""select o_orderkey, {STAMP.format('time')} as time, {r6('tas', 'tas')} from raw_model
    where time >= timestamp '1996-01-01' and time < timestamp '1999-01-01'""", ("raw_model",))
def _(spark, sf):
    rows = raw_model(spark, sf).withColumnsRenamed({"TIME": "time", "TMP": "tas"})
    return temporal.clip_years(rows, 1996, 1998).select("o_orderkey", "time", "tas")


@query("sorted_times", f"select distinct {STAMP.format('time')} as time from raw_model order by 1", ("raw_model",))
def _(spark, sf):
    return temporal.sorted_times(raw_model(spark, sf).withColumnRenamed("TIME", "time"))


@query("dataset_names", "select model || '_' || scenario || '_tas' as dataset, count(*) as n from raw_model group by 1",
       ("raw_model",))
def _(spark, sf):
    rows = raw_model(spark, sf).select(dataset_name(F.col("model"), F.col("scenario"), F.lit("tas")).alias("dataset"))
    return rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


@query("period_select", f"select yr as year, mon as month, lat, lon, {r6('tas', 'tas')} from obs where yr in (2000, 2001)",
       ("obs",))
def _(spark, sf):
    return temporal.period_select(observed(spark, sf), (2000, 2001)).select("year", "month", "lat", "lon", "tas")


@query("season_select", f"""select l_orderkey, l_linenumber, m as month, {r6('v', 'v')} from raw_calendar
    where m in (12, 1, 2)""", ("raw_calendar",))
def _(spark, sf):
    return temporal.season_select(raw_calendar(spark, sf).withColumnRenamed("m", "month"), "DJF").select(
        "l_orderkey", "l_linenumber", "month", "v"
    )


def _range_sql(v: str, name: str, lo: float, hi: float) -> str:
    outside = f"count(*) filter (where {v} < {lo} or {v} > {hi})"
    return f"""select model, scenario, count(*) as n_rows, '{name}' as variable, {lo}::double as low, {hi}::double as high,
        false as strict, {r6(f'min({v})', 'min_value')}, {r6(f'max({v})', 'max_value')}, {r6(f'avg({v})', 'mean_value')},
        count(*) filter (where {v} is null) as n_missing, {outside} as n_outside,
        case when {outside} > 0 then 'warning' else 'ok' end as status from raw_model group by model, scenario"""


@query("validate_range", _range_sql("tas", "tas", -50, 60) + " union all " + _range_sql("pr_day*30", "pr", 0, 2000),
       ("raw_model",))
def _(spark, sf):
    return cubes.model_report(raw_model(spark, sf))


@query("validate_strict", f"""select count(*) as n_rows, 'tas' as variable, -50.0::double as low, 60.0::double as high,
    true as strict, {r6('min(t2m-273.15)', 'min_value')}, {r6('max(t2m-273.15)', 'max_value')},
    {r6('avg(t2m-273.15)', 'mean_value')}, count(*) filter (where t2m is null) as n_missing,
    count(*) filter (where t2m-273.15 < -50 or t2m-273.15 > 60) as n_outside,
    case when count(*) filter (where t2m-273.15 < -50 or t2m-273.15 > 60) > 0 then 'error' else 'ok' end as status
    from raw_target""", ("raw_target",))
def _(spark, sf):
    return quality.validate_range(cubes.convert_target(raw_target(spark, sf)), {"tas": RANGES["target"]["tas"]})


@query("pairwise_valid", f"""select {STAMP.format('time')} as time, lat, lon, {r6('t2m', 't2m')}, {r6('tp', 'tp')}
    from raw_target where t2m is not null and tp is not null""", ("raw_target",))
def _(spark, sf):
    rows = naming.rename_coords(naming.drop_coords(raw_target(spark, sf)),
                                {"valid_time": "time", "latitude": "lat", "longitude": "lon"})
    return quality.pairwise_valid(rows, "t2m", "tp")


@query("drop_missing", f"""select {STAMP.format('time')} as time, lat, lon, {r6('t2m', 't2m')} from raw_target
    where t2m is not null""", ("raw_target",))
def _(spark, sf):
    rows = naming.rename_coords(raw_target(spark, sf), {"valid_time": "time", "latitude": "lat", "longitude": "lon"})
    return quality.drop_missing(rows, ["t2m"]).select("time", "lat", "lon", "t2m")


@query("drop_report", f"""select count(*) as rows_before, count(t2m) as rows_after, count(*) - count(t2m) as rows_dropped,
    {r6('(count(*) - count(t2m))*100.0/count(*)', 'percent_dropped')} from raw_target""", ("raw_target",))
def _(spark, sf):
    return quality.drop_report(raw_target(spark, sf), ["t2m", "tp"])


@query("wet_only", f"select l_orderkey, l_linenumber, {r6('p_wet', 'p_wet')} from scored where p_wet > 0", ("scored",))
def _(spark, sf):
    return wet_only(scored(spark, sf), "p_wet").select("l_orderkey", "l_linenumber", "p_wet")


@query("sample_rows", """select l_orderkey, l_linenumber, round(l_quantity::double, 6) + 0.0::double as l_quantity from lineitem
    where ('0x' || substr(md5(l_orderkey::varchar || '|' || l_linenumber::varchar || '|42'), 1, 8))::bigint < 0.2::double * 4294967296""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return sample_rows(rows, 0.2, ["l_orderkey", "l_linenumber"])


def _profile_sql(v: str, dtype: str) -> str:
    return f"""select count(*) as n_rows, '{v}' as variable, '{dtype}' as dtype, count(*) - count({v}) as n_missing,
        {r6(f'min({v})', 'min_value')}, {r6(f'max({v})', 'max_value')}, {r6(f'avg({v})', 'mean_value')} from raw_target"""


@query("profile", " union all ".join(_profile_sql(v, "double") for v in ("t2m", "tp", "lat", "lon")), ("raw_target",))
def _(spark, sf):
    rows = naming.rename_coords(raw_target(spark, sf), {"latitude": "lat", "longitude": "lon"})
    return prof.profile(rows, ["t2m", "tp", "lat", "lon"])


@query("profile_coordinates", " union all ".join(f"""select model, '{n}' as coordinate, '{t}' as dtype, count(distinct {c}) as size,
    {e.format(f'min({c})')} as first, {e.format(f'max({c})')} as last from raw_model group by model""" for n, t, c, e in (
    ("TIME", "timestamp_ntz", "time", STAMP), ("YAX", "double", "lat", "{}::varchar"), ("XAX", "double", "lon", "{}::varchar"))), ("raw_model",))
def _(spark, sf):
    return prof.coordinates(raw_model(spark, sf), ("TIME", "YAX", "XAX"), ("model",))


@query("time_coverage", f"""select model as dataset, {STAMP.format('min(time)')} as first_time,
    {STAMP.format('max(time)')} as last_time, count(distinct time) as n_times from raw_model group by model""",
       ("raw_model",))
def _(spark, sf):
    rows = raw_model(spark, sf).withColumnsRenamed({"model": "dataset", "TIME": "time"})
    return prof.time_coverage(rows)


@query("grid_info", """select model as dataset, min(lat) as lat_min, max(lat) as lat_max, count(distinct lat) as n_lat,
    coalesce((max(lat)-min(lat))/nullif(count(distinct lat)-1, 0), 0.0) as lat_res, min(lon) as lon_min,
    max(lon) as lon_max, count(distinct lon) as n_lon,
    coalesce((max(lon)-min(lon))/nullif(count(distinct lon)-1, 0), 0.0) as lon_res from raw_model group by model""",
       ("raw_model",))
def _(spark, sf):
    return prof.grid_info(raw_model(spark, sf).withColumnsRenamed({"model": "dataset", "YAX": "lat", "XAX": "lon"}))


_DATED = """select o_orderpriority as model, case when year(o_orderdate) <= 1998 then 'hist' else 'ssp585' end as scenario,
    year(o_orderdate) as y, try_cast(printf('%04d-%02d-%02d', year(o_orderdate), month(o_orderdate), 1 + o_orderkey % 31) as timestamp) as t,
    floor(o_totalprice/1000)/7.91907019::double as tas, 30*(floor(o_totalprice/1000)/7.91907019::double) as pr from orders"""


@query("model_check", f"""select *, case when n_in_period = 0 then 'empty' when n_outside_tas + n_outside_pr > 0 then 'warning' else 'ok' end as status
    from (select model, scenario, count(*) as n_rows, count(*) filter (where t is null) as n_impossible, count(*) filter (where ok) as n_in_period,
    count(*) filter (where ok and (tas < -50 or tas > 60)) as n_outside_tas, count(*) filter (where ok and (pr < 0 or pr > 2000)) as n_outside_pr
    from (select *, t is not null and (scenario <> 'hist' or y between 1980 and 1995) as ok from ({_DATED})) group by 1, 2)""")
def _(spark, sf):
    day = (1 + F.col("o_orderkey") % 31).cast("int")
    raw = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("model"), F.when(F.year("o_orderdate") <= 1998, "hist").otherwise("ssp585").alias("scenario"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), day.alias("day"), F.lit(1.0).alias("YAX"), F.lit(1.0).alias("XAX"),
        (F.floor(F.col("o_totalprice") / 1000) / 7.91907019).alias("TMP"), (F.floor(F.col("o_totalprice") / 1000) / 7.91907019).alias("PRE"),
    )
    return cubes.model_check(raw, (1980, 1995))


@query("catalog", f"""select model || '_' || scenario as dataset, count(*) as n_rows, count(distinct time) as n_times,
    count(distinct lat) as n_lat, count(distinct lon) as n_lon, {STAMP.format('min(time)')} as first_time,
    {STAMP.format('max(time)')} as last_time, 'tas,pr' as variables from raw_model group by 1""", ("raw_model",))
def _(spark, sf):
    rows = cubes.convert_model(raw_model(spark, sf))
    return prof.catalog(rows.withColumn("dataset", F.concat_ws("_", "model", "scenario")))


@query("write_table", f"""select yr as year, split, mon as month, lat, lon, {r6('tas', 'tas')} from (
    select *, case when yr between 1995 and 1998 then 'train' when yr = 1999 then 'validation' else 'test' end as split
    from obs where yr between 1995 and 2001)""", ("obs",))
def _(spark, sf):
    from isohyet.operators.features import split_by_year
    from isohyet.queries.base import SPLITS

    path = f"{scratch(spark)}/table"
    rows = split_by_year(observed(spark, sf), SPLITS).select("year", "split", "month", "lat", "lon", "tas")
    # A rebuilt table has nothing of the one before.
    sinks.write_table(rows.withColumns({"year": F.col("year") - 50, "tas": -F.col("tas")}), path, ("split", "year"))
    sinks.write_table(rows, path, ("split", "year"))
    return sinks.read_split(spark, path)


@query("write_downscaled", f"""select model, scenario, yr as year, mon as month, lat, lon, {r6('tas::float', 'tas')},
    {r6('pr::float', 'pr')} from multi""", ("multi",))
def _(spark, sf):
    path = scratch(spark)
    rows = multi(spark, sf).withColumnsRenamed({"tas": "pred_tas", "pr": "pred_pr"}).drop("time")
    sinks.write_downscaled(rows, path, {"tas_path": "gbt_tas", "pr_path": "gbt_pr"}, "gbt")
    return sinks.read_table(spark, f"{path}/data")


def _attribute_rows() -> str:
    """The attributes of both variables as SQL values."""
    made = {"model_algorithm": "gbt", "target_resolution": TARGET_RESOLUTION}
    rows = [(v, k, x) for v, of in OUTPUT_ATTRIBUTES.items() for k, x in {**of, "model_file": f"gbt_{v}", **made}.items()]
    return ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in rows)


@query("provenance", f"""select distinct model, scenario, v.variable, v.attribute, v.value from multi
    cross join (values {_attribute_rows()}) v(variable, attribute, value)""", ("multi",))
def _(spark, sf):
    rows = sinks.provenance(multi(spark, sf), {"tas_path": "gbt_tas", "pr_path": "gbt_pr"}, "gbt")
    return rows.select("model", "scenario", "variable", F.explode("attributes").alias("attribute", "value"))


@query("write_metrics", f"""select model, {r6('min(tas)', 'low')}, {r6('max(tas)', 'high')} from raw_model group by model""",
       ("raw_model",))
def _(spark, sf):
    path = f"{scratch(spark)}/metrics"
    rows = raw_model(spark, sf).groupBy("model").agg(F.min("TMP").alias("low"), F.max("TMP").alias("high"))
    sinks.write_metrics(rows, path)
    return spark.read.schema(rows.schema).json(path)
