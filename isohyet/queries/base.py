"""Registry of queries, and cubes derived from the given tables.

Each cube is defined twice, as a DataFrame and as a SQL common table, so that a
query and its SQL equivalent start from the same rows. Coordinates are binary
fractions. Values have an odd divisor, which keeps sums and means off the ties
of the final rounding, where the last bit would decide.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet.functions.calendar import as_ntz, month_start
from isohyet.session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
ODD = 7.91907019
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Years of the given tables.
SPLITS = {"train": (1995, 1998), "validation": (1999, 1999), "test": (2000, 2001)}
TEST_YEARS = SPLITS["test"]
POINTS = ((23.3, 60.2), (24.5, 62.0), (25.25, 63.0))


def query(name: str, sql: str | None = None, tables: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; `tables` are the common tables its SQL reads."""
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_tables(sql, tables)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to six places, timestamps as text."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            out[f.name] = F.col(f.name).cast("string")
    return df.withColumns(out) if out else df


_OPENED: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its files are listed once per application."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _OPENED:
        _OPENED[key] = spark.read.parquet(path)
    return _OPENED[key]


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/isohyet-{uuid.uuid4().hex}"


def axis(start: float, step: float, key: str, size: int) -> Column:
    return F.lit(start) + F.lit(step) * (F.col(key) % size)


def _monthly(df: DataFrame, time: str, **keys: Column) -> DataFrame:
    return df.select(
        "*", F.year(time).alias("year"), F.month(time).alias("month"),
        *[c.alias(n) for n, c in keys.items()],
    )


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("time", month_start(F.col("year"), F.col("month")))


def observed_points(spark: SparkSession, sf_dir: str, n_lat: int = 12, n_lon: int = 15) -> DataFrame:
    """Rows of the fine grid before they are grouped; enough to find the grid."""
    return _monthly(
        table(spark, sf_dir, "lineitem"), "l_shipdate",
        lat=axis(23.125, 0.25, "l_partkey", n_lat), lon=axis(60.125, 0.25, "l_suppkey", n_lon),
    )


def observed(spark: SparkSession, sf_dir: str, n_lat: int = 12, n_lon: int = 15) -> DataFrame:
    """Fine monthly cube, 0.25 degrees."""
    rows = observed_points(spark, sf_dir, n_lat, n_lon)
    return _stamped(rows.groupBy("year", "month", "lat", "lon").agg(
        (F.avg("l_quantity") * 8 / ODD).alias("tas"), (F.round(F.min("l_discount") * 100) * 8 / ODD).alias("pr")
    ))


def target_months(spark: SparkSession, sf_dir: str, n_lat: int = 12, n_lon: int = 15) -> DataFrame:
    """A second fine monthly cube with other values; stands for the target."""
    rows = observed_points(spark, sf_dir, n_lat, n_lon)
    return _stamped(rows.groupBy("year", "month", "lat", "lon").agg(
        F.when(F.min("l_tax") > 0, F.max("l_quantity") * 8 / ODD).alias("tas"),
        (F.floor(F.min("l_extendedprice") / 1000) / ODD).alias("pr"),
    ))


def coarse_points(spark: SparkSession, sf_dir: str, n_lat: int = 5, n_lon: int = 5) -> DataFrame:
    return _monthly(
        table(spark, sf_dir, "orders"), "o_orderdate",
        lat=axis(22.5, 1.0, "o_custkey", n_lat), lon=axis(60.0, 1.0, "o_orderkey", n_lon),
    )


def coarse(spark: SparkSession, sf_dir: str, n_lat: int = 5, n_lon: int = 5) -> DataFrame:
    """Coarse monthly cube, 1 degree; its hull covers the fine grid."""
    rows = coarse_points(spark, sf_dir, n_lat, n_lon)
    return _stamped(rows.groupBy("year", "month", "lat", "lon").agg(
        (F.floor(F.max("o_totalprice") / 1000) / ODD).alias("tas"),
        (F.floor(F.min("o_totalprice") / 1000) / ODD).alias("pr"),
    ))


def multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five models and two scenarios on a 2 degree grid; pr in mm/day."""
    rows = _monthly(
        table(spark, sf_dir, "orders"), "o_orderdate", model=F.col("o_orderpriority"),
        lat=axis(22.5, 2.0, "o_custkey", 3), lon=axis(60.0, 2.0, "o_orderkey", 3),
    ).withColumn("scenario", F.when(F.col("year") <= 1998, "hist").otherwise("ssp585"))
    return _stamped(rows.groupBy("model", "scenario", "year", "month", "lat", "lon").agg(
        (F.floor(F.max("o_totalprice") / 1000) / ODD).alias("tas"),
        (F.floor(F.min("o_totalprice") / 1000) / (8 * ODD)).alias("pr"),
    ))


def raw_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily cells in K and m under source names, with missing values."""
    li = table(spark, sf_dir, "lineitem").withColumns({
        "latitude": axis(22.5, 1.0, "l_partkey", 5), "longitude": axis(60.0, 1.0, "l_suppkey", 5),
    })
    return li.groupBy(F.col("l_shipdate").alias("valid_time"), "latitude", "longitude").agg(
        F.when(F.min("l_tax") != 0, F.max("l_quantity") * 8 / ODD + F.lit(273.15)).alias("t2m"),
        (F.round(F.min("l_discount") * 100) / (1000 * ODD)).alias("tp"),
    ).withColumns({"expver": F.lit("0001"), "number": F.lit(0)})


def raw_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order under climate-model names; pr in mm/day."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("model"),
        F.when(F.year("o_orderdate") <= 1998, "hist").otherwise("ssp585").alias("scenario"),
        as_ntz(F.col("o_orderdate")).alias("TIME"),
        axis(22.5, 2.0, "o_custkey", 3).alias("YAX"), axis(60.0, 2.0, "o_orderkey", 3).alias("XAX"),
        (F.floor(F.col("o_totalprice") / 1000) / ODD).alias("TMP"),
        (F.floor(F.col("o_totalprice") / 1000) / (8 * ODD)).alias("PRE"),
    )


def raw_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar fields with impossible dates, one row per line."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"),
        (1 + F.col("l_orderkey") % 31).cast("int").alias("d"), F.col("l_quantity").alias("v"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A probability, a label and two value columns, one row per line."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("year"),
        (F.col("l_discount") * 10).alias("p_wet"),
        F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("wet"),
        F.col("l_quantity").alias("y_true"), (F.col("l_extendedprice") / (250 * ODD)).alias("y_pred"),
    )


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest with several entries per dataset, one row per order."""
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(
        F.col("o_orderstatus") == "O", "failed"
    ).otherwise("running")
    return table(spark, sf_dir, "orders").select(
        F.concat_ws("_", "o_orderpriority", F.col("o_custkey").cast("string")).alias("dataset"),
        status.alias("status"), as_ntz(F.col("o_orderdate")).alias("ts"),
    )


# Common tables: SQL texts of the cubes above.
TABLES = {
    "obs": """select year(l_shipdate)::int as yr, month(l_shipdate)::int as mon,
        23.125::double + 0.25::double*(l_partkey % 12) as lat, 60.125::double + 0.25::double*(l_suppkey % 15) as lon,
        avg(l_quantity)*8/7.91907019::double as tas, round(min(l_discount)*100)*8/7.91907019::double as pr from lineitem group by 1,2,3,4""",
    "tgt": """select year(l_shipdate)::int as yr, month(l_shipdate)::int as mon,
        23.125::double + 0.25::double*(l_partkey % 12) as lat, 60.125::double + 0.25::double*(l_suppkey % 15) as lon,
        case when min(l_tax) > 0 then max(l_quantity)*8/7.91907019::double end as tas, floor(min(l_extendedprice)/1000)/7.91907019::double as pr
        from lineitem group by 1,2,3,4""",
    "gcm": """select year(o_orderdate)::int as yr, month(o_orderdate)::int as mon,
        22.5::double + 1.0::double*(o_custkey % 5) as lat, 60.0::double + 1.0::double*(o_orderkey % 5) as lon,
        floor(max(o_totalprice)/1000)/7.91907019::double as tas, floor(min(o_totalprice)/1000)/7.91907019::double as pr
        from orders group by 1,2,3,4""",
    "multi": """select o_orderpriority as model, case when year(o_orderdate) <= 1998 then 'hist' else 'ssp585' end as scenario,
        year(o_orderdate)::int as yr, month(o_orderdate)::int as mon,
        22.5::double + 2.0::double*(o_custkey % 3) as lat, 60.0::double + 2.0::double*(o_orderkey % 3) as lon,
        floor(max(o_totalprice)/1000)/7.91907019::double as tas, floor(min(o_totalprice)/1000)/(8*7.91907019::double) as pr
        from orders group by 1,2,3,4,5,6""",
    "raw_target": """select l_shipdate as time, 22.5::double + 1.0::double*(l_partkey % 5) as lat,
        60.0::double + 1.0::double*(l_suppkey % 5) as lon,
        case when min(l_tax) <> 0 then max(l_quantity)*8/7.91907019::double + 273.15::double end as t2m, round(min(l_discount)*100)/(1000*7.91907019::double) as tp
        from lineitem group by 1,2,3""",
    "raw_model": """select o_orderkey, o_orderpriority as model,
        case when year(o_orderdate) <= 1998 then 'hist' else 'ssp585' end as scenario, o_orderdate as time,
        22.5::double + 2.0::double*(o_custkey % 3) as lat, 60.0::double + 2.0::double*(o_orderkey % 3) as lon,
        floor(o_totalprice/1000)/7.91907019::double as tas, floor(o_totalprice/1000)/(8*7.91907019::double) as pr_day from orders""",
    "raw_calendar": """select l_orderkey, l_linenumber, year(l_shipdate)::int as y, month(l_shipdate)::int as m,
        (1 + l_orderkey % 31)::int as d, l_quantity as v from lineitem""",
    "scored": """select l_orderkey, l_linenumber, year(l_shipdate)::int as yr, l_discount*10 as p_wet,
        case when l_quantity > 25 then 1 else 0 end as wet, l_quantity as y_true, l_extendedprice/(250*7.91907019::double) as y_pred from lineitem""",
    "status_log": """select o_orderpriority || '_' || o_custkey::varchar as dataset,
        case o_orderstatus when 'F' then 'completed' when 'O' then 'failed' else 'running' end as status,
        o_orderdate as ts from orders""",
    "obs_wide": """select year(l_shipdate)::int as yr, month(l_shipdate)::int as mon,
        23.125::double + 0.25::double*(l_partkey % 60) as lat, 60.125::double + 0.25::double*(l_suppkey % 72) as lon,
        avg(l_quantity)*8/7.91907019::double as tas, round(min(l_discount)*100)*8/7.91907019::double as pr
        from lineitem group by 1,2,3,4""",
    "gcm_wide": """select year(o_orderdate)::int as yr, month(o_orderdate)::int as mon,
        22.5::double + 1.0::double*(o_custkey % 17) as lat, 60.0::double + 1.0::double*(o_orderkey % 19) as lon,
        floor(max(o_totalprice)/1000)/7.91907019::double as tas, floor(min(o_totalprice)/1000)/7.91907019::double as pr
        from orders group by 1,2,3,4""",
    # Linear weights from the coarse to the fine grid, per axis.
    "axes_src": "select distinct 'lat' as axis, lat as v from gcm union select distinct 'lon', lon from gcm",
    "axes_dst": "select distinct 'lat' as axis, lat as v from obs union select distinct 'lon', lon from obs",
    "brackets": """select d.axis, d.v as t, max(s.v) filter (where s.v <= d.v) as lo, min(s.v) filter (where s.v >= d.v) as hi
        from axes_dst d join axes_src s on d.axis = s.axis group by 1,2""",
    "linear": """select axis, t, lo as s, case when lo = hi then 1.0::double else (hi-t)/(hi-lo) end as w,
        case when lo = hi then 1 else 2 end as n from brackets where lo is not null and hi is not null
        union all select axis, t, hi, (t-lo)/(hi-lo), 2 from brackets where lo < hi""",
    "regridded": """select * from (select g.yr, g.mon, a.t as lat, b.t as lon,
        case when count(g.tas) = max(a.n*b.n) then sum(a.w*b.w*g.tas) end as tas,
        case when count(g.pr) = max(a.n*b.n) then sum(a.w*b.w*g.pr) end as pr
        from gcm g join linear a on a.axis = 'lat' and g.lat = a.s join linear b on b.axis = 'lon' and g.lon = b.s
        group by 1,2,3,4) where tas is not null or pr is not null""",
    "pairs": """select o.yr, o.mon, o.lat, o.lon, p.tas as pt, o.tas as ot, p.pr as pp, o.pr as op
        from regridded p join obs o using (yr, mon, lat, lon)""",
    "sides": """select coalesce(o.yr,p.yr) as yr, coalesce(o.mon,p.mon) as mon, coalesce(o.lat,p.lat) as lat,
        coalesce(o.lon,p.lon) as lon, p.tas as pt, o.tas as ot, p.pr as pp, o.pr as op
        from regridded p full join obs o on p.yr=o.yr and p.mon=o.mon and p.lat=o.lat and p.lon=o.lon""",
}
_NEEDS = {
    "axes_src": ("gcm",), "axes_dst": ("obs",), "brackets": ("axes_src", "axes_dst"), "linear": ("brackets",),
    "regridded": ("gcm", "linear"), "pairs": ("regridded", "obs"), "sides": ("regridded", "obs"),
}


def with_tables(sql: str, names: tuple[str, ...]) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, ()):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return sql
    return "with " + ",\n".join(f"{n} as ({TABLES[n]})" for n in order) + "\n" + sql


def r6(expr: str, name: str) -> str:
    return f"round(({expr})::double, 6) + 0.0::double as {name}"


def corr_sql(x: str, y: str) -> str:
    """Pearson over complete pairs, missing when a side does not vary."""
    px = f"case when {y} is not null then {x} end"
    py = f"case when {x} is not null then {y} end"
    return f"covar_pop({px},{py})/nullif(stddev_pop({px})*stddev_pop({py}),0)"


def r2_sql(p: str, y: str) -> str:
    return (f"case when count(*)*var_pop({y}) = 0 then case when sum(({p}-{y})*({p}-{y})) = 0 then 1.0 else 0.0 end "
            f"else 1 - sum(({p}-{y})*({p}-{y}))/(count(*)*var_pop({y})) end")


SEASON_SQL = "case when mon in (12,1,2) then 'DJF' when mon in (3,4,5) then 'MAM' when mon in (6,7,8) then 'JJA' else 'SON' end"
