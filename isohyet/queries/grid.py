"""Grids, regridding and reshaping."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from isohyet.operators import grids
from isohyet.operators.regrid import flatten, lon_name, pivot_map, regrid, to_grid
from isohyet.queries.base import coarse, coarse_points, observed, observed_points, query, r6, table, target_months
from isohyet.queries.sqltext import linear_tables

_XYM = ["year", "month", "lat", "lon", "tas", "pr"]
_REGRID_OUT = f"select yr as year, mon as month, lat, lon, {r6('tas', 'tas')}, {r6('pr', 'pr')} from "


def regridded(spark, sf, method: str = "bilinear"):
    """The coarse cube on the fine grid."""
    cube = coarse(spark, sf)
    grid = both_grids(spark, sf)
    return regrid(cube, grid["coarse"], grid["fine"], method, keys=("year", "month"))


def both_grids(spark, sf):
    return grids.grids_of_cubes({"coarse": coarse_points(spark, sf), "fine": observed_points(spark, sf)})


@query("regrid_bilinear", _REGRID_OUT + "regridded", ("regridded",))
def _(spark, sf):
    return regridded(spark, sf).select(*_XYM)


def regridded_wide(spark, sf):
    """The same on the 60 x 72 grid, from a 17 x 19 grid."""
    cube = coarse(spark, sf, 17, 19)
    grid = grids.grids_of_cubes({"coarse": coarse_points(spark, sf, 17, 19), "fine": observed_points(spark, sf, 60, 72)})
    return regrid(cube, grid["coarse"], grid["fine"], keys=("year", "month"))


@query("regrid_wide", f"""with {linear_tables('gcm_wide', 'obs_wide', 'wide', ('yr', 'mon'), extra='gcm_wide, obs_wide')}
    {_REGRID_OUT} wide""")
def _(spark, sf):
    return regridded_wide(spark, sf).select(*_XYM)


_NEAREST = """select axis, t, case when lo is null then hi when hi is null then lo when t-lo < hi-t then lo else hi end as s
    from brackets"""


@query("regrid_nearest", f"""{_REGRID_OUT} (select g.yr, g.mon, a.t as lat, b.t as lon, g.tas, g.pr from gcm g
    join ({_NEAREST}) a on a.axis = 'lat' and a.s = g.lat join ({_NEAREST}) b on b.axis = 'lon' and b.s = g.lon)""",
       ("brackets",))
def _(spark, sf):
    return regridded(spark, sf, "nearest").select(*_XYM)


def _edges(axes: str) -> str:
    step_down = "v - lag(v) over w"
    step_up = "lead(v) over w - v"
    return f"""select axis, v, v - coalesce({step_down}, {step_up})/2 as e0, v + coalesce({step_up}, {step_down})/2 as e1
        from {axes} window w as (partition by axis order by v)"""


_OVERLAPS = f"""select axis, t, s, part / sum(part) over (partition by axis, t) as w, count(*) over (partition by axis, t) as n from (
    select d.axis, d.v as t, s.v as s, case when d.axis = 'lat'
        then sin(radians(least(d.e1, s.e1))) - sin(radians(greatest(d.e0, s.e0)))
        else least(d.e1, s.e1) - greatest(d.e0, s.e0) end as part
    from ({_edges('axes_dst')}) d join ({_edges('axes_src')}) s on d.axis = s.axis and least(d.e1, s.e1) > greatest(d.e0, s.e0))"""


@query("regrid_conservative", f"""{_REGRID_OUT} (select g.yr, g.mon, a.t as lat, b.t as lon,
    case when count(g.tas) = max(a.n*b.n) then sum(a.w*b.w*g.tas) end as tas,
    case when count(g.pr) = max(a.n*b.n) then sum(a.w*b.w*g.pr) end as pr
    from gcm g join ({_OVERLAPS}) a on a.axis = 'lat' and g.lat = a.s join ({_OVERLAPS}) b on b.axis = 'lon' and g.lon = b.s
    group by 1,2,3,4) where tas is not null or pr is not null""", ("axes_src", "axes_dst"))
def _(spark, sf):
    return regridded(spark, sf, "conservative").select(*_XYM)


@query("regrid_same_grid", f"""select yr as year, mon as month, lat, lon, {r6('o.tas', 'tas')}, {r6('o.pr', 'pr')}, {r6('t.tas', 'target_tas')}
    from obs o join tgt t using (yr, mon, lat, lon) where o.tas is not null or o.pr is not null""", ("obs", "tgt"))
def _(spark, sf):
    """A source that misses the target's coordinates by rounding, then joined exactly."""
    cube = observed(spark, sf).withColumns({"lat": F.col("lat") + 1e-4, "lon": F.col("lon") - 1e-4})
    source = grids.grid_of(cube)
    target = grids.grid_of(observed_points(spark, sf))
    moved = regrid(cube, source, target, keys=("year", "month"))
    other = target_months(spark, sf).select("year", "month", "lat", "lon", F.col("tas").alias("target_tas"))
    return moved.join(other, ["year", "month", "lat", "lon"]).select(*_XYM, "target_tas")


@query("regrid_weights", f"select axis, s as src, t as dst, {r6('w', 'w')}, n as n_src from linear", ("linear",))
def _(spark, sf):
    grid = both_grids(spark, sf)
    return grids.axis_weights(spark, {"coarse": grid["coarse"]}, grid["fine"]).select(
        "axis", (F.col("src_key") / 1e6).alias("src"), "dst", "w", "n_src"
    )


@query("conservative_weights", f"select axis, s as src, t as dst, {r6('w', 'w')}, n::int as n_src from ({_OVERLAPS})",
       ("axes_src", "axes_dst"))
def _(spark, sf):
    grid = both_grids(spark, sf)
    return grids.axis_weights(spark, {"coarse": grid["coarse"]}, grid["fine"], "conservative").select(
        "axis", (F.col("src_key") / 1e6).alias("src"), "dst", "w", "n_src"
    )


@query("grid_table", """select (row_number() over (partition by lon order by lat) - 1)::int as lat_idx,
    (row_number() over (partition by lat order by lon) - 1)::int as lon_idx, lat, lon from (
    select a.v as lat, b.v as lon from axes_dst a join axes_dst b on a.axis = 'lat' and b.axis = 'lon')""", ("axes_dst",))
def _(spark, sf):
    return grids.grid_table(spark, grids.grid_of(observed_points(spark, sf))).select("lat_idx", "lon_idx", "lat", "lon")


@query("same_grid", f"""select coalesce(a.axis, b.axis) as axis, count(a.v) as n_first, count(b.v) as n_second,
    {r6('max(abs(a.v - b.v))', 'max_gap')},
    bool_and(coalesce(abs(a.v - b.v) <= 1e-8 + 1e-5*abs(b.v), false)) as same
    from (select axis, v, row_number() over (partition by axis order by v) as i from axes_src) a
    full join (select axis, v, row_number() over (partition by axis order by v) as i from axes_dst) b
    on a.axis = b.axis and a.i = b.i group by 1""", ("axes_src", "axes_dst"))
def _(spark, sf):
    first = grids.indexed_axes(grids.axis_values(coarse_points(spark, sf)))
    second = grids.indexed_axes(grids.axis_values(observed_points(spark, sf)))
    return grids.compare_grids(first, second)


@query("axis_bracket", "select axis, t as value, lo as below, hi as above from brackets", ("brackets",))
def _(spark, sf):
    source, target = grids.axis_values(coarse_points(spark, sf)), grids.axis_values(observed_points(spark, sf))
    return grids.axis_bracket(source, target).select("axis", "value", "below", "above")


@query("axis_step", """select model, axis, v as value, v - lag(v) over (partition by model, axis order by v) as step from (
    select distinct model, 'lat' as axis, lat as v from multi union select distinct model, 'lon', lon from multi)""",
       ("multi",))
def _(spark, sf):
    from isohyet.queries.base import multi

    return grids.axis_steps(grids.axis_values(multi(spark, sf), ["model"]), ["model"]).select(
        "model", "axis", "value", "step"
    )


@query("nearest_cell", """select s_suppkey, lat, lon, first(gla order by abs(gla - lat), -gla) as grid_lat,
    (select first(v order by abs(v - lon), -v) from axes_dst where axis = 'lon') as grid_lon
    from (select s_suppkey, 22.5::double + 0.125::double*(s_suppkey % 40) as lat, 59.5::double + 0.125::double*(s_suppkey % 37) as lon
        from supplier), (select v as gla from axes_dst where axis = 'lat') group by 1,2,3""", ("axes_dst",))
def _(spark, sf):
    points = table(spark, sf, "supplier").select(
        "s_suppkey", (F.lit(22.5) + F.lit(0.125) * (F.col("s_suppkey") % 40)).alias("lat"),
        (F.lit(59.5) + F.lit(0.125) * (F.col("s_suppkey") % 37)).alias("lon"),
    )
    return grids.nearest_cell(points, grids.grid_of(observed_points(spark, sf)))


@query("flatten", f"""select vec_id, label::double as lat, (i - 1)::double as lon, {r6('embedding[i]', 'value')}
    from embeddings, unnest(range(1, len(embedding) + 1)) t(i)""")
def _(spark, sf):
    steps = table(spark, sf, "embeddings").select(
        "vec_id", F.array(F.col("label").cast("double")).alias("lats"),
        F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda x: x.cast("double")).alias("lons"),
        F.array("embedding").alias("values"),
    )
    return flatten(steps, "values", keys=("vec_id",))


@query("to_grid", f"""select yr as year, mon as month, lat, lon, {r6('o.tas', 'tas')}, {r6('o.pr', 'pr')}
    from (select distinct yr, mon from obs) t cross join (select v as lat from axes_dst where axis = 'lat') a
    cross join (select v as lon from axes_dst where axis = 'lon') b left join obs o using (yr, mon, lat, lon)""",
       ("obs", "axes_dst"))
def _(spark, sf):
    cube = observed(spark, sf)
    return to_grid(cube, grids.grid_of(observed_points(spark, sf)), ("tas", "pr"), ("year", "month"))


_LONS = [60.125 + 0.25 * i for i in range(15)]


@query("pivot_map", " union all ".join(f"select '{v}' as variable, lat, " + ", ".join(
    r6(f"avg({v}) filter (where lon = {x})", lon_name(x)) for x in _LONS) + " from obs group by lat" for v in ("tas", "pr")), ("obs",))
def _(spark, sf):
    cube, grid = observed(spark, sf), grids.grid_of(observed_points(spark, sf))
    tas, pr = (pivot_map(cube, v, grid).withColumn("variable", F.lit(v)) for v in ("tas", "pr"))
    return tas.unionByName(pr)
