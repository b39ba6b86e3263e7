"""SQL texts of regridding, used by several SQL equivalents."""

from __future__ import annotations

from isohyet.queries.base import TABLES

_DERIVED = {
    "monthly": """select year(time)::int as yr, month(time)::int as mon, lat, lon, avg(t2m - 273.15) as tas,
        sum(tp*1000) as pr from raw_target where year(time) between 1996 and 2000 group by 1,2,3,4""",
    "monthly_95": """select year(time)::int as yr, month(time)::int as mon, lat, lon, avg(t2m - 273.15) as tas,
        sum(tp*1000) as pr from raw_target where year(time) between 1995 and 1998 group by 1,2,3,4""",
    "multi_hist": "select * replace (pr*30 as pr) from multi where scenario = 'hist' and yr between 1995 and 1998",
    "multi_mm": "select * replace (pr*30 as pr) from multi",
}


def linear_tables(source: str, target: str, out: str, keys: tuple[str, ...], extra: str, prefix: str = "") -> str:
    """Common tables that move `source` onto the grid of `target` as `out`; two uses in one statement need a prefix."""
    first = [f"{n.strip()} as ({TABLES[n.strip()]})" for n in extra.split(",")]
    k = ", ".join(f"g.{x}" for x in keys)
    groups = ",".join(str(i + 1) for i in range(len(keys) + 2))
    src = _DERIVED.get(source) or TABLES[source]
    return ",\n".join([
        *first, f"{prefix}src as ({src})",
        f"{prefix}sa as (select distinct 'lat' as axis, lat as v from {prefix}src union select distinct 'lon', lon from {prefix}src)",
        f"{prefix}da as (select distinct 'lat' as axis, lat as v from {target} union select distinct 'lon', lon from {target})",
        f"""{prefix}br as (select d.axis, d.v as t, max(s.v) filter (where s.v <= d.v) as lo, min(s.v) filter (where s.v >= d.v) as hi
            from {prefix}da d join {prefix}sa s on d.axis = s.axis group by 1,2)""",
        f"""{prefix}li as (select axis, t, lo as s, case when lo = hi then 1.0::double else (hi-t)/(hi-lo) end as w,
            case when lo = hi then 1 else 2 end as n from {prefix}br where lo is not null and hi is not null
            union all select axis, t, hi, (t-lo)/(hi-lo), 2 from {prefix}br where lo < hi)""",
        f"""{out} as (select * from (select {k}, a.t as lat, b.t as lon,
            case when count(g.tas) = max(a.n*b.n) then sum(a.w*b.w*g.tas) end as tas,
            case when count(g.pr) = max(a.n*b.n) then sum(a.w*b.w*g.pr) end as pr
            from {prefix}src g join {prefix}li a on a.axis = 'lat' and g.lat = a.s join {prefix}li b on b.axis = 'lon' and g.lon = b.s
            group by {groups}) where tas is not null or pr is not null)""",
    ])
