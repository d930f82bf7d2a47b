"""Shared parts of the SQL texts that the queries are compared with."""

from __future__ import annotations

from rimeframe import fixed_values as fv

_FRAME_7 = "rows between 6 preceding and current row"
_FRAME_30 = "rows between 29 preceding and current row"
_SERIES = "partition by id order by date"

COMMON = {
    "stations": """
        select 'S' || lpad(cast(s_suppkey as varchar), 6, '0') as id, s_name as name,
          case when s_acctbal >= 0 then 37.0::double + (s_suppkey % 4) * 1.0::double
            + (s_suppkey % 7) * 0.1::double end as latitude,
          case when s_acctbal >= 0 then -104.0::double
            + (cast(floor(s_suppkey / 4) as bigint) % 6) * 1.0::double
            + (s_suppkey % 9) * 0.1::double end as longitude,
          cast((s_suppkey * 37) % 1500 as double) as elevation_m,
          cast(s_nationkey as varchar) as state, 'US' as country_code
        from supplier""",
    "supplier_day": """
        select k, d, lo, hi, tx, dc, n, 40 * (6 - abs(month(d) - 7)) as season,
          k * 31 + year(d) * 372 + month(d) * 31 + day(d) as h
        from (
          select l_suppkey as k, cast(l_shipdate as date) as d,
            cast(min(l_quantity) as int) as lo, cast(max(l_quantity) as int) as hi,
            cast(sum(cast(round(l_tax * 100) as bigint)) as int) as tx,
            cast(sum(cast(round(l_discount * 100) as bigint)) as int) as dc,
            cast(count(*) as int) as n
          from lineitem group by l_suppkey, cast(l_shipdate as date))""",
    "readings": """
        select 'S' || lpad(cast(k as varchar), 6, '0') as id, d as date, element,
          cast(value as int) as value, q_flag, h as order_key
        from (
          select k, d, h, 'TMAX' as element,
            case when h % 211 = 0 then 9999 else hi * 10 + season - 250 end as value,
            '' as q_flag from supplier_day
          union all
          select k, d, h, 'TMIN',
            case when h % 101 = 0 then hi * 10 + season else lo * 10 + season - 350 end,
            case when h % 97 = 0 then 'X' else '' end from supplier_day
          union all
          select k, d, h, 'PRCP',
            case when h % 401 = 0 then -5 when h % 5 < 2 then 0 else tx * 10 end, null
            from supplier_day where h % 7 <> 0
          union all
          select k, d, h, 'SNOW', dc, null from supplier_day where season < 80
          union all
          select k, d, h, 'SNWD', n, null from supplier_day where season < 80)""",
    "user_readings": """
        select 'U' || lpad(cast(user_id as varchar), 6, '0') as id, cast(ts as date) as date,
          case event_type when 'click' then 'TMAX' when 'view' then 'TMIN'
            when 'purchase' then 'PRCP' when 'signup' then 'SNOW' else 'SNWD' end as element,
          case when event_type in ('click', 'view') then cast(floor(value * 4) as int) - 100
            else cast(floor(value * 10) as int) end as value,
          case when event_id % 50 = 0 then 'X' else '' end as q_flag, event_id as order_key
        from events""",
    "bronze": """
        select id, date, element, value, q_flag, order_key,
          cast(year(date) as int) as year, cast(month(date) as int) as month
        from readings where coalesce(q_flag, '') = ''""",
    "wide": "select id, date, " + ", ".join(
        f"min(case when element = '{e}' then value end) as {e.lower()}_raw" for e in fv.ELEMENTS
    ) + " from bronze group by id, date",
    "si": "select id, date, cast(year(date) as int) as year, cast(month(date) as int) as month, "
    + ", ".join(
        f"{e.lower()}_raw * {scale}::double as {column}"
        for e, (column, scale) in fv.ELEMENTS.items()
    ) + " from wide",
    "clipped": """
        select id, date, year, month,
          case when tmin_c between -90 and 60 then tmin_c end as tmin_c,
          case when tmax_c between -90 and 60 then tmax_c end as tmax_c,
          case when prcp_mm >= 0 then prcp_mm end as prcp_mm,
          case when snow_mm >= 0 then snow_mm end as snow_mm,
          case when snwd_mm >= 0 then snwd_mm end as snwd_mm
        from si""",
    "clean": """
        select id, date, year, month,
          case when tmin_c > tmax_c then null else tmin_c end as tmin_c,
          case when tmin_c > tmax_c then null else tmax_c end as tmax_c,
          prcp_mm, snow_mm, snwd_mm
        from clipped""",
    "derived": """
        select *, cast(dayofyear(date) as int) as day_of_year,
          (tmin_c + tmax_c) / 2.0::double as tavg_c, tmax_c - tmin_c as temp_range_c,
          tmin_c <= 0 as is_frost_day, tmax_c >= 30 as is_heat_stress_day
        from clean""",
    "silver": """
        select d.*, s.name, s.latitude, s.longitude, s.elevation_m, s.state, s.country_code
        from derived d left join stations s on d.id = s.id""",
    "known": """
        select s.* from silver s
        join (select id from silver group by id having count(*) >= 30) h on s.id = h.id""",
    "lagged": f"""
        select *,
          lag(tmin_c, 1) over ({_SERIES}) as tmin_c_lag_1,
          lag(tmin_c, 7) over ({_SERIES}) as tmin_c_lag_7,
          lag(tmax_c, 1) over ({_SERIES}) as tmax_c_lag_1,
          lag(tmax_c, 7) over ({_SERIES}) as tmax_c_lag_7,
          lag(prcp_mm, 1) over ({_SERIES}) as prcp_mm_lag_1,
          lag(prcp_mm, 7) over ({_SERIES}) as prcp_mm_lag_7
        from known""",
    "rolled": f"""
        select *,
          avg(tmin_c) over ({_SERIES} {_FRAME_7}) as tmin_c_roll7_mean,
          min(tmin_c) over ({_SERIES} {_FRAME_7}) as tmin_c_roll7_min,
          avg(tmax_c) over ({_SERIES} {_FRAME_7}) as tmax_c_roll7_mean,
          max(tmax_c) over ({_SERIES} {_FRAME_7}) as tmax_c_roll7_max,
          sum(prcp_mm) over ({_SERIES} {_FRAME_7}) as prcp_mm_roll7_sum,
          avg(tmin_c) over ({_SERIES} {_FRAME_30}) as tmin_c_roll30_mean,
          avg(tmax_c) over ({_SERIES} {_FRAME_30}) as tmax_c_roll30_mean,
          sum(prcp_mm) over ({_SERIES} {_FRAME_30}) as prcp_mm_roll30_sum,
          cast(sum(cast(is_frost_day as int)) over ({_SERIES} {_FRAME_30}) as bigint)
            as frost_days_roll30
        from lagged""",
    "grown": """
        select *,
          sum(gdd_corn_day) over (partition by id, year order by date
            rows unbounded preceding) as gdd_corn_ytd,
          sum(gdd_wheat_day) over (partition by id, year order by date
            rows unbounded preceding) as gdd_wheat_ytd
        from (select *,
          case when tavg_c is not null then greatest(0.0::double, tavg_c - 10.0::double) end
            as gdd_corn_day,
          case when tavg_c is not null then greatest(0.0::double, tavg_c - 4.0::double) end
            as gdd_wheat_day
          from rolled)""",
    "labels_ahead": f"""
        select *,
          lead(is_frost_day) over ({_SERIES}) as next_day_is_frost,
          lead(tmin_c) over ({_SERIES}) as next_day_tmin_c,
          lead(tmax_c) over ({_SERIES}) as next_day_tmax_c
        from grown""",
    "region_stats": """
        select cast(floor(latitude) as bigint) as cell_lat,
          cast(floor(longitude) as bigint) as cell_lon, date,
          avg(tmin_c) as region_tmin_mean, min(tmin_c) as region_tmin_min,
          count(*) as region_n_stations
        from known where tmin_c is not null group by 1, 2, 3""",
    "gold": """
        select g.*, r.region_tmin_mean, r.region_tmin_min, r.region_n_stations,
          g.tmin_c - r.region_tmin_mean as tmin_minus_region
        from labels_ahead g left join region_stats r
          on floor(g.latitude) = r.cell_lat and floor(g.longitude) = r.cell_lon
          and g.date = r.date""",
    "labelled": """
        select *, cast(next_day_is_frost as double) as label
        from gold where next_day_is_frost is not null""",
    "ruled": """
        select *, case when tmin_c <= 2.0 then 1.0::double else 0.0::double end as prediction
        from labelled where year = 2001""",
    "scored": "select *, 1 / (1 + exp(tmin_c)) as p1 from labelled where year = 2001",
    "oni": """
        select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
          (count(*) % 41 - 20) / 10.0::double as oni_anom
        from orders group by 1, 2""",
}


def oracle(
    body: str, upto: str | None = None, also: tuple[str, ...] = (), instead: dict[str, str] | None = None
) -> str:
    """``body`` preceded by the common tables it may use, up to and including ``upto``.

    ``instead`` replaces some of them.
    """
    names = list(COMMON)
    used = names[: names.index(upto) + 1] if upto else []
    used += [name for name in also if name not in used]
    if not used:
        return body
    texts = {**COMMON, **(instead or {})}
    tables = ",\n".join(f"{name} as ({texts[name]})" for name in used)
    return f"with {tables}\n{body}"


def r6(expression: str, name: str | None = None) -> str:
    """A double rounded to six places (adding zero turns -0.0 into 0.0)."""
    return f"round({expression}, 6) + 0.0::double as {name or expression}"


def day(expression: str = "date", name: str = "date") -> str:
    return f"cast({expression} as varchar) as {name}"


def flag(expression: str, name: str | None = None) -> str:
    return f"cast({expression} as int) as {name or expression}"


def columns(text: str) -> str:
    """Select list from names: ``x`` as is, ``x~`` a rounded double, ``x?`` a flag, ``date``."""
    parts = []
    for token in text.split():
        if token == "date":
            parts.append(day())
        elif token.endswith("~"):
            parts.append(r6(token[:-1]))
        elif token.endswith("?"):
            parts.append(flag(token[:-1]))
        else:
            parts.append(token)
    return ", ".join(parts)


SILVER_LIST = (
    "id date year month day_of_year tmax_c~ tmin_c~ tavg_c~ temp_range_c~ prcp_mm~ snow_mm~ "
    "snwd_mm~ is_frost_day? is_heat_stress_day? name latitude~ longitude~ elevation_m~ state "
    "country_code"
)
LAG_LIST = "tmin_c_lag_1~ tmin_c_lag_7~ tmax_c_lag_1~ tmax_c_lag_7~ prcp_mm_lag_1~ prcp_mm_lag_7~"
ROLL7_LIST = (
    "tmin_c_roll7_mean~ tmin_c_roll7_min~ tmax_c_roll7_mean~ tmax_c_roll7_max~ prcp_mm_roll7_sum~"
)
ROLL30_LIST = "tmin_c_roll30_mean~ tmax_c_roll30_mean~ prcp_mm_roll30_sum~ frost_days_roll30"
GDD_LIST = "gdd_corn_day~ gdd_corn_ytd~ gdd_wheat_day~ gdd_wheat_ytd~"
REGION_LIST = "region_tmin_mean~ region_tmin_min~ region_n_stations tmin_minus_region~"
LABEL_LIST = "next_day_is_frost? next_day_tmin_c~ next_day_tmax_c~"
GOLD_LIST = " ".join(
    [SILVER_LIST, LAG_LIST, ROLL7_LIST, ROLL30_LIST, GDD_LIST, REGION_LIST, LABEL_LIST]
)
