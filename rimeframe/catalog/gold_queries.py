"""Feature engineering on station series."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimeframe.catalog import adapters as data
from rimeframe.catalog.registry import query
from rimeframe.catalog.sql import (
    COMMON,
    GDD_LIST,
    GOLD_LIST,
    LABEL_LIST,
    LAG_LIST,
    REGION_LIST,
    ROLL7_LIST,
    ROLL30_LIST,
    columns,
    oracle,
    r6,
)
from rimeframe.operators import gold, silver
from rimeframe.sources.layers import write_years
from rimeframe.storage import fresh_path
from rimeframe.streaming.refresh import read_gold, refresh_gold
from rimeframe.streaming.slices import rebuild_gold_years

KEY = ("id", "date")


def known(spark, folder):
    return gold.with_enough_history(data.silver_days(spark, folder))


def names(text: str) -> list[str]:
    return [token.rstrip("~?") for token in text.split()]


def from_table(text: str, table: str) -> str:
    return oracle(f"select id, cast(date as varchar) as date, {columns(text)} from {table}", table)


@query("j3_known_stations", oracle(f"select {columns('id date tmin_c~')} from known", "known"))
def j3(spark, folder):
    """The same filter as a semi-join against counts taken elsewhere."""
    days = data.silver_days(spark, folder)
    kept = gold.with_enough_history(days, 30, history=gold.station_history(days))
    return kept.select(*KEY, "tmin_c")


@query("w1_lags", from_table(LAG_LIST, "lagged"))
def w1(spark, folder):
    return known(spark, folder).withColumns(gold.lags()).select(*KEY, *names(LAG_LIST))


@query("w2_rolling7", from_table(ROLL7_LIST, "rolled"))
def w2(spark, folder):
    return known(spark, folder).withColumns(gold.rolling()).select(*KEY, *names(ROLL7_LIST))


@query("w3_rolling30", from_table(ROLL30_LIST, "rolled"))
def w3(spark, folder):
    return known(spark, folder).withColumns(gold.rolling()).select(*KEY, *names(ROLL30_LIST))


_DAYS = "over (partition by id order by date range between interval {} days preceding and current row)"


@query("w3_rolling_calendar_days", oracle(
    "select id, cast(date as varchar) as date, "
    + r6("avg(tmin_c) " + _DAYS.format(6), "tmin_c_roll7_mean") + ", "
    + r6("sum(prcp_mm) " + _DAYS.format(29), "prcp_mm_roll30_sum") + ", "
    + "cast(sum(cast(is_frost_day as int)) " + _DAYS.format(29) + " as bigint) as frost_days_roll30"
    + " from known", "known"))
def w3_days(spark, folder):
    """Frames of calendar days instead of readings: gaps shorten them."""
    wanted = ("tmin_c_roll7_mean", "prcp_mm_roll30_sum", "frost_days_roll30")
    return known(spark, folder).withColumns(gold.rolling("days")).select(*KEY, *wanted)


@query("w4_gdd_year_to_date", from_table(GDD_LIST, "grown"))
def w4(spark, folder):
    return gold.with_growing_degrees(known(spark, folder)).select(*KEY, *names(GDD_LIST))


@query("w5_next_day_labels", from_table(LABEL_LIST, "labels_ahead"))
def w5(spark, folder):
    labelled = known(spark, folder).withColumns(gold.next_day_labels())
    return labelled.select(*KEY, *names(LABEL_LIST))


@query("w6_horizon_labels", oracle(
    "select id, cast(date as varchar) as date, "
    + ", ".join(
        f"cast(lead(is_frost_day, {k}) over (partition by id order by date) as double) as y_h{k}"
        for k in range(1, 16)
    ) + " from known", "known"))
def w6(spark, folder):
    labels = gold.horizon_labels()
    return known(spark, folder).withColumns(labels).select(*KEY, *labels)


@query("a2_region_stats", oracle(
    f"select {columns('cell_lat cell_lon date region_tmin_mean~ region_tmin_min~ region_n_stations')}"
    " from region_stats", "region_stats"))
def a2(spark, folder):
    return gold.region_day_stats(known(spark, folder))


@query("j4_region_join", oracle(
    f"select id, cast(date as varchar) as date, {columns(REGION_LIST)} from gold", "gold"))
def j4(spark, folder):
    return gold.with_region(known(spark, folder)).select(*KEY, *names(REGION_LIST))


@query("p11_offset_from_region", oracle(
    f"select {columns('id date tmin_c~ tmin_minus_region~')} from gold", "gold"))
def p11(spark, folder):
    return gold.with_region(known(spark, folder)).select(*KEY, "tmin_c", "tmin_minus_region")


@query("j4_region_without_self", oracle(
    "select k.id, cast(k.date as varchar) as date, region_n_stations, "
    + r6("""case when tmin_c is null then region_tmin_mean
        when region_n_stations > 1
        then (region_tmin_mean * region_n_stations - tmin_c) / (region_n_stations - 1) end""",
        "region_tmin_mean")
    + """ from known k left join region_stats r on floor(k.latitude) = r.cell_lat
    and floor(k.longitude) = r.cell_lon and k.date = r.date""", "region_stats"))
def j4_others(spark, folder):
    joined = gold.with_region(known(spark, folder), leave_one_out=True)
    return joined.select(*KEY, "region_n_stations", "region_tmin_mean")


@query("j5_climate_index", oracle(
    "select k.id, cast(k.date as varchar) as date, " + r6("oni_anom")
    + """, case when oni_anom <= -0.5 then 'nina' when oni_anom >= 0.5 then 'nino'
    when oni_anom is not null then 'neutral' end as enso_phase
    from silver k left join oni o on k.year = o.year and k.month = o.month""", "silver", ("oni",)))
def j5(spark, folder):
    joined = gold.with_climate(data.silver_days(spark, folder), data.climate_index(spark, folder))
    return joined.select(*KEY, "oni_anom", "enso_phase")


@query("g_gold_features", oracle(f"select {columns(GOLD_LIST)} from gold", "gold"))
def full_gold(spark, folder):
    """All 46 columns."""
    return data.gold_days(spark, folder)


@query("g_gold_with_climate", oracle(
    "select g.id, cast(g.date as varchar) as date, " + r6("oni_anom") + ", "
    + columns("tmin_c_roll30_mean~ gdd_corn_ytd~ tmin_minus_region~ next_day_is_frost?")
    + " from gold g left join oni o on g.year = o.year and g.month = o.month", "gold", ("oni",)))
def gold_with_climate(spark, folder):
    built = gold.to_gold(data.silver_days(spark, folder), data.climate_index(spark, folder))
    return built.select(*KEY, "oni_anom", "tmin_c_roll30_mean", "gdd_corn_ytd",
                        "tmin_minus_region", "next_day_is_frost")


@query("t2_rebuilt_years", oracle(
    f"select {columns(GOLD_LIST)} from gold where year between 1998 and 1999", "gold"))
def t2(spark, folder):
    """Two years rebuilt with a halo equal the same years of a full build."""
    return rebuild_gold_years(data.silver_days(spark, folder), 1998, 1999)


_EDITED = f"""
    select id, date, element, case when element = 'TMIN' and year = 1998 and id like '%7' then value + 10
      else value end as value, q_flag, order_key, year, month
    from ({COMMON["bronze"]}) where not (id like '%3' and year = 1999)"""


@query("t2_refreshed_gold", oracle(
    f"select {columns(GOLD_LIST)} from gold", "gold", instead={"bronze": _EDITED}))
def t2_refreshed(spark, folder):
    """Gold built once, then brought up to date after some stations' readings were corrected or withdrawn."""
    silver_path, target = fresh_path(spark, "silver"), fresh_path(spark, "gold")
    bronze, stations = data.bronze_readings(spark, folder), data.stations(spark, folder)
    write_years(silver.to_silver(bronze, stations), silver_path, sort_by=KEY, in_place=True)
    refresh_gold(spark, silver_path, target)
    raised = (F.col("element") == "TMIN") & (F.col("year") == 1998) & F.col("id").endswith("7")
    withdrawn = F.col("id").endswith("3") & (F.col("year") == 1999)
    edited = bronze.filter(F.col("year").isin(1998, 1999) & ~withdrawn).withColumn(
        "value", F.when(raised, F.col("value") + 10).otherwise(F.col("value")))
    write_years(silver.to_silver(edited, stations), silver_path, sort_by=KEY, in_place=True)
    refresh_gold(spark, silver_path, target)
    return read_gold(spark, target).select(*names(GOLD_LIST))
