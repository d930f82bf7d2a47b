"""Seasonal, spatial, rainfall and storage questions, and the small SQL and text examples."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.catalog import adapters as data
from rimeframe.catalog.registry import query
from rimeframe.catalog.sql import columns, oracle, r6
from rimeframe.functions import climate, space
from rimeframe.operators import analysis as an
from rimeframe.operators import gold
from rimeframe.sources.layers import layer_report

FROST = "avg(cast(is_frost_day as double))"
KNOWN_FROST = "from silver where is_frost_day is not null"


# --- volumes and quality ------------------------------------------------------------------

_REPORT = (
    "count(*) as n_rows, count(distinct id) as n_stations, "
    "count(*) filter (where is_frost_day) as n_frost, "
    "count(*) filter (where is_heat_stress_day) as n_heat, "
    + r6("100.0 * count(*) filter (where is_frost_day) / count(*)", "frost_pct") + ", "
    + r6("100.0 * count(*) filter (where is_heat_stress_day) / count(*)", "heat_pct")
)


@query("s16_silver_report", oracle(f"select {_REPORT} from silver", "silver"))
def s16_silver(spark, folder):
    return layer_report(data.silver_days(spark, folder))


@query("s16_gold_report", oracle(
    f"select {_REPORT}, count(next_day_is_frost) as n_labelled, "
    + r6("avg(cast(next_day_is_frost as double))", "positive_rate") + " from labels_ahead",
    "labels_ahead"))
def s16_gold(spark, folder):
    return layer_report(data.gold_days(spark, folder))


@query("a4_distinct_stations", oracle(
    "select count(distinct id) as n_stations from silver", "silver"))
def a4(spark, folder):
    return data.silver_days(spark, folder).agg(F.countDistinct("id").alias("n_stations"))


@query("a5_element_counts", oracle(
    "select element, count(*) as n from bronze group by element", "bronze"))
def a5(spark, folder):
    return an.element_counts(data.bronze_readings(spark, folder))


_CHECKED = ("tmax_c", "tmin_c", "prcp_mm", "snow_mm", "snwd_mm", "tavg_c", "elevation_m")


@query("a6_null_fractions", oracle(" union all ".join(
    f"select '{c}' as column_name, "
    f"{r6(f'avg(case when {c} is null then 1.0::double else 0.0::double end)', 'null_fraction')}"
    " from silver" for c in _CHECKED), "silver"))
def a6(spark, folder):
    return an.null_fractions(data.silver_days(spark, folder), _CHECKED)


_SUMMARISED = ("tmin_c", "tmax_c", "tavg_c", "prcp_mm", "elevation_m")


@query("a7_summary", oracle(" union all ".join(
    f"select '{c}' as column_name, count({c}) as n, {r6(f'avg({c})', 'mean')}, "
    f"{r6(f'stddev_samp({c})', 'stddev')}, {r6(f'min({c})', 'min')}, {r6(f'max({c})', 'max')} "
    "from silver" for c in _SUMMARISED), "silver"))
def a7(spark, folder):
    return an.summary(data.silver_days(spark, folder), _SUMMARISED)


# --- seasonality and terrain --------------------------------------------------------------

@query("a8_frost_by_month", oracle(
    f"select month, {r6(FROST, 'frost_rate')} {KNOWN_FROST} group by month", "silver"))
def a8(spark, folder):
    return an.frost_rate_by(data.silver_days(spark, folder), "month")


@query("a9_frost_by_day_of_year", oracle(
    f"select day_of_year, {r6(FROST, 'frost_rate')} {KNOWN_FROST} group by day_of_year", "silver"))
def a9(spark, folder):
    return an.frost_rate_by(data.silver_days(spark, folder), "day_of_year")


@query("f10_frost_by_elevation", oracle(
    f"select * from (select cast(trunc(elevation_m / 250) as int) * 250 as elev_band, "
    f"{r6(FROST, 'frost_rate')}, count(*) as n {KNOWN_FROST} and elevation_m is not null "
    "group by 1) where elev_band between 0 and 3500 and n > 5000", "silver"))
def f10(spark, folder):
    return an.frost_by_elevation(data.silver_days(spark, folder))


@query("a10_frost_by_elevation_all_bands", oracle(
    f"select cast(trunc(elevation_m / 250) as int) * 250 as elev_band, {r6(FROST, 'frost_rate')}, "
    f"count(*) as n {KNOWN_FROST} and elevation_m is not null group by 1", "silver"))
def a10(spark, folder):
    return an.frost_by_elevation(data.silver_days(spark, folder), more_than=0, limits=None)


@query("a10_frost_by_elevation_low_and_high", oracle(
    "select cast(trunc((elevation_m * 4 - 1500) / 250) as int) * 250 as elev_band, "
    f"{r6(FROST, 'frost_rate')}, count(*) as n {KNOWN_FROST} and elevation_m is not null group by 1",
    "silver"))
def a10_low_and_high(spark, folder):
    """Stretched from far below sea level to above the usual limits."""
    days = data.silver_days(spark, folder)
    stretched = days.withColumn("elevation_m", F.col("elevation_m") * 4 - 1500)
    return an.frost_by_elevation(stretched, more_than=0, limits=None)


def _grid(size: int, where: str = "") -> str:
    return (
        f"select cast(floor(latitude / {size}) * {size} as bigint) as glat, "
        f"cast(floor(longitude / {size}) * {size} as bigint) as glon, {FROST} as frost_rate, "
        f"count(*) as n {KNOWN_FROST} {where} group by 1, 2"
    )


@query("a11_frost_grid", oracle(
    f"select {columns('glat glon frost_rate~ n')} from ({_grid(1)}) where n > 200", "silver"))
def a11(spark, folder):
    return an.frost_grid(data.silver_days(spark, folder))


@query("a12_frost_grid_three_degrees", oracle(
    f"select {columns('glat glon frost_rate~ n')} from ({_grid(3, 'and year = 2001')}) "
    "where n > 200", "silver"))
def a12(spark, folder):
    days = data.silver_days(spark, folder).filter(F.col("year") == data.TEST_YEAR)
    return an.frost_grid(days, degrees=3)


_LONS = (-104, -98)


@query("a13_grid_matrix", oracle(
    "select glat, " + ", ".join(
        r6(f"max(case when glon = {e} then 100.0 * frost_rate end)", an.column_for(e))
        for e in range(_LONS[0], _LONS[1] + 1)
    ) + f", count(*) filter (where glon is null or glon not between {_LONS[0]} and {_LONS[1]}) "
    f"as cells_outside from ({_grid(1)}) where n > 200 and glat is not null group by glat",
    "silver"))
def a13(spark, folder):
    return an.grid_matrix(an.frost_grid(data.silver_days(spark, folder)), *_LONS)


@query("a19_station_means", oracle(
    f"select id, {r6('latitude')}, {r6('longitude')}, {r6('avg(tmin_c)', 'mean_tmin')} from silver "
    "where tmin_c is not null and latitude is not null group by id, latitude, longitude",
    "silver"))
def a19(spark, folder):
    return an.station_means(data.silver_days(spark, folder))


_BOXES = {
    "us_corn_belt": fv.REGION_BOXES["us_corn_belt"],
    "north_west": {"country": None, "lat": (39.0, 42.0), "lon": (-104.0, -101.0)},
    "south_east": {"country": None, "lat": (37.0, 39.5), "lon": (-101.5, -98.0)},
}


def _box_sql(name: str, box: dict) -> str:
    country = f"and country_code = '{box['country']}'" if box["country"] else ""
    return (
        f"select '{name}' as series, month, {FROST} as frost_rate {KNOWN_FROST} "
        f"and latitude between {box['lat'][0]} and {box['lat'][1]} "
        f"and longitude between {box['lon'][0]} and {box['lon'][1]} {country} group by month"
    )


_BOX_UNION = " union all ".join(_box_sql(name, box) for name, box in _BOXES.items())


@query("a20_box_climatology", oracle(
    f"select series, month, {r6('frost_rate')}, "
    + r6("100.0 * frost_rate / nullif(max(frost_rate) over (partition by series), 0)", "pct_of_peak")
    + f" from ({_BOX_UNION})", "silver"))
def a20(spark, folder):
    return an.climatology_by_box(data.silver_days(spark, folder), _BOXES)


@query("p19_relative_to_peak", oracle(
    f"select state, month, {r6('rain')}, "
    + r6("100.0 * rain / nullif(max(rain) over (partition by state), 0)", "pct_of_peak")
    + " from (select state, month, avg(prcp_mm) as rain from silver group by state, month)",
    "silver"))
def p19(spark, folder):
    monthly = data.silver_days(spark, folder).groupBy("state", "month").agg(
        F.avg("prcp_mm").alias("rain")
    )
    return an.relative_to_peak(monthly, "state", "rain")


# --- rain ---------------------------------------------------------------------------------

_RECENT = "date >= (select max(date) from silver) - interval 90 day and prcp_mm is not null"


@query("f9_recent_days", oracle(
    f"select {columns('id date prcp_mm~')} from silver "
    "where date >= (select max(date) from silver) - interval 90 day", "silver"))
def f9(spark, folder):
    return an.recent(data.silver_days(spark, folder)).select("id", "date", "prcp_mm")


@query("a14_recent_rain_by_station", oracle(
    f"select id, {r6('max(latitude)', 'lat')}, {r6('max(longitude)', 'lon')}, "
    f"{r6('sum(prcp_mm)', 'total_prcp')}, count(*) filter (where prcp_mm > 0) as wet_days "
    f"from silver where {_RECENT} and latitude is not null group by id", "silver"))
def a14(spark, folder):
    return an.recent_rain_by_station(data.silver_days(spark, folder))


@query("a15_recent_daily_rain", oracle(
    f"select cast(date as varchar) as date, {r6('avg(prcp_mm)', 'mean_prcp')} from silver "
    f"where {_RECENT} group by date", "silver"))
def a15(spark, folder):
    return an.recent_daily_rain(data.silver_days(spark, folder))


_CLASS = """case when {0} <= 0.1::double then '0 (dry)' when {0} <= 5 then '0–5 mm'
    when {0} <= 15 then '5–15 mm' when {0} <= 40 then '15–40 mm'
    when {0} is not null then '40+ mm' end"""
_RANK = """case when {0} <= 0.1::double then 0 when {0} <= 5 then 1 when {0} <= 15 then 2
    when {0} <= 40 then 3 when {0} is not null then 4 end"""


@query("p14_rain_class", oracle(
    f"select {columns('id date prcp_mm~')}, {_CLASS.format('prcp_mm')} as rain_class, "
    f"{_RANK.format('prcp_mm')} as class_rank from silver", "silver"))
def p14(spark, folder):
    rain = F.col("prcp_mm")
    return data.silver_days(spark, folder).select(
        "id", "date", "prcp_mm",
        climate.rain_class(rain).alias("rain_class"),
        climate.rain_class_rank(rain).alias("class_rank"),
    )


_SUM7 = "round(prcp_mm_roll7_sum, 6)"


@query("a16_frost_by_rain_class", oracle(
    f"select {_RANK.format(_SUM7)} as class_rank, {_CLASS.format(_SUM7)} as rain_class, "
    + r6("avg(cast(next_day_is_frost as double))", "frost_rate")
    + ", count(*) as n from labels_ahead where next_day_is_frost is not null "
    "and prcp_mm_roll7_sum is not null group by 1, 2", "labels_ahead"))
def a16(spark, folder):
    return an.frost_by_rain_class(data.gold_days(spark, folder))


# --- storage priority ---------------------------------------------------------------------

_CELLS = """select cast(floor(latitude) as bigint) as clat, cast(floor(longitude) as bigint) as clon,
    count(*) filter (where is_frost_day) as n_frost, count(distinct id) as n_stations,
    count(*) as n_obs from known where is_frost_day is not null and month in (9, 10) group by 1, 2"""
_CELL_OUT = (
    "clat, clon, n_frost, n_stations, n_obs, "
    + r6("n_frost / n_obs::double", "frost_rate") + ", " + r6("clat + 0.5::double", "clat_c") + ", "
    + r6("clon + 0.5::double", "clon_c") + ", "
    + r6("n_frost / n_obs::double * n_stations", "priority")
)


@query("f11_pre_harvest_mid_latitude", oracle(
    f"select {columns('id date tmin_c~')} from known where is_frost_day is not null "
    "and month in (9, 10) and abs(latitude) between 30 and 55", "known"))
def f11(spark, folder):
    days = an.pre_harvest(gold.with_enough_history(data.silver_days(spark, folder)))
    inside = days.filter(space.in_latitude_band(F.col("latitude")))
    return inside.select("id", "date", "tmin_c")


@query("a17_pre_harvest_cells", oracle(
    f"select {_CELL_OUT} from ({_CELLS}) where n_obs >= 20", "known"))
def a17(spark, folder):
    return an.pre_harvest_cells(data.gold_days(spark, folder), at_least=20)


@query("p18_cell_priority", oracle(
    f"select clat, clon, {r6('clat + 0.5::double', 'clat_c')}, "
    f"{r6('clon + 0.5::double', 'clon_c')}, "
    f"{r6('n_frost / n_obs::double * n_stations', 'priority')} from ({_CELLS}) where n_obs >= 500",
    "known"))
def p18(spark, folder):
    cells = an.pre_harvest_cells(data.gold_days(spark, folder))
    return cells.select("clat", "clon", "clat_c", "clon_c", "priority")


@query("a18_cells_above_regional_rate", oracle(
    "select " + r6("max(rate)", "regional_rate") + ", "
    + r6("avg(case when n_obs >= 20 then cast(n_frost / n_obs::double > rate as double) end)",
         "share_above")
    + ", count(*) filter (where n_obs >= 20) as n_cells "
    f"from ({_CELLS}) c, (select sum(n_frost) / sum(n_obs)::double as rate from ({_CELLS})) t",
    "known"))
def a18(spark, folder):
    return an.cells_above_regional_rate(data.gold_days(spark, folder), at_least=20)


@query("o1_storage_priority", oracle(
    f"select {_CELL_OUT} from ({_CELLS}) where n_obs >= 20 "
    "order by n_frost / n_obs::double * n_stations desc, clat, clon limit 10", "known"))
def o1(spark, folder):
    return an.storage_priority(data.gold_days(spark, folder), at_least=20)


@query("o2_busiest_station", oracle(
    "select id, count(*) as n from known group by id order by n desc, id limit 1", "known"))
def o2(spark, folder):
    return an.busiest_station(data.gold_days(spark, folder))


@query("o3_ordered_counts", oracle(
    "select state, month, count(*) as n from silver group by state, month", "silver"))
def o3(spark, folder):
    return (
        data.silver_days(spark, folder)
        .groupBy("state", "month")
        .agg(an.rows().alias("n"))
        .orderBy(F.desc("n"), "state", "month")
    )


@query("a21_base_rate", oracle(
    f"select {r6('avg(cast(next_day_is_frost as double))', 'base_rate')}, "
    "count(next_day_is_frost) as n_labelled from labels_ahead", "labels_ahead"))
def a21(spark, folder):
    return an.base_rate(data.gold_days(spark, folder))


# --- one station through the layers -------------------------------------------------------

_BUSIEST = "(select id from known group by id order by count(*) desc, id limit 1)"


def _busiest(spark, folder):
    return an.busiest_station(gold.with_enough_history(data.silver_days(spark, folder)))


@query("f12_station_in_bronze", oracle(
    f"select {columns('id date element value')} from bronze where id = {_BUSIEST} "
    "order by date, element limit 8", "known"))
def f12_bronze(spark, folder):
    return an.station_rows(
        data.bronze_readings(spark, folder), _busiest(spark, folder),
        ("date", "element"), ("id", "date", "element", "value"), 8,
    )


@query("f12_station_in_silver", oracle(
    f"select {columns('id date name tmin_c~ tmax_c~ prcp_mm~')} from silver "
    f"where id = {_BUSIEST} order by date limit 5", "known"))
def f12_silver(spark, folder):
    return an.station_rows(
        data.silver_days(spark, folder), _busiest(spark, folder),
        ("date",), ("id", "date", "name", "tmin_c", "tmax_c", "prcp_mm"), 5,
    )


_GOLD_SLICE = (
    "id date tmin_c~ tmin_c_lag_1~ tmin_c_roll7_mean~ region_tmin_mean~ gdd_corn_ytd~ "
    "next_day_is_frost?"
)


@query("f12_station_in_gold", oracle(
    f"select {columns(_GOLD_SLICE)} from gold where id = {_BUSIEST} order by date limit 5", "gold"))
def f12_gold(spark, folder):
    wanted = tuple(token.rstrip("~?") for token in _GOLD_SLICE.split())
    return an.station_rows(
        data.gold_days(spark, folder), _busiest(spark, folder), ("date",), wanted, 5
    )


# --- joins, SQL text, words and sales ------------------------------------------------------

def _labels_vectors(spark, folder, how):
    """Two tables that cover different ranges of ids, so both sides have unmatched rows."""
    labels = data.table(spark, folder, "labels").withColumnRenamed("doc_id", "key")
    vectors = data.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("key"), F.col("label").alias("cluster")
    )
    return labels.join(vectors, "key", how).select("key", "quality", "toxic", "cluster")


def _join_sql(how: str) -> str:
    return f"""select coalesce(l.doc_id, e.vec_id) as key, quality, toxic, e.label as cluster
    from labels l {how} join embeddings e on l.doc_id = e.vec_id"""


@query("j7_inner_join", _join_sql("inner"))
def j7_inner(spark, folder):
    return _labels_vectors(spark, folder, "inner")


@query("j7_left_join", _join_sql("left"))
def j7_left(spark, folder):
    return _labels_vectors(spark, folder, "left")


@query("j7_right_join", _join_sql("right"))
def j7_right(spark, folder):
    return _labels_vectors(spark, folder, "right")


@query("j7_outer_join", _join_sql("full"))
def j7_outer(spark, folder):
    return _labels_vectors(spark, folder, "outer")


_A23 = """select c_mktsegment as segment, count(*) as headcount,
    round(avg(c_acctbal), 2){0} as avg_balance, max(c_acctbal) as max_balance,
    min(c_acctbal) as min_balance, round(sum(c_acctbal), 2){0} as total
    from {1} group by c_mktsegment order by avg_balance desc"""


@query("a23_sql_over_a_view", _A23.format(" + 0.0::double", "customer"))
def a23_sql(spark, folder):
    data.table(spark, folder, "customer").createOrReplaceTempView("customer_accounts")
    return spark.sql(_A23.format("", "customer_accounts"))


@query("a23_group_statistics", oracle(
    "select o_orderpriority as priority, count(*) as n, "
    + r6("avg(o_totalprice)", "avg_price") + ", " + r6("max(o_totalprice)", "max_price") + ", "
    + r6("min(o_totalprice)", "min_price") + ", round(sum(o_totalprice), 2) as total "
    "from orders group by o_orderpriority"))
def a23_groups(spark, folder):
    price = "o_totalprice"
    return (
        data.table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("priority"))
        .agg(
            an.rows().alias("n"),
            F.avg(price).alias("avg_price"),
            F.max(price).alias("max_price"),
            F.min(price).alias("min_price"),
            F.round(F.sum(price), 2).alias("total"),
        )
    )


@query("a24_word_count", oracle(
    "select word, count(*) as n from (select unnest(string_split_regex(text, '[ \\t\\r\\n]+')) "
    "as word from documents) where word <> '' group by word"))
def a24_words(spark, folder):
    return an.word_counts(data.table(spark, folder, "documents"))


@query("a24_mean_by_key", oracle(
    "select l_partkey, count(*) as n, " + r6("sum(l_quantity)", "sum_qty") + ", "
    + r6("avg(l_quantity)", "mean_qty") + " from lineitem group by l_partkey"))
def a24_means(spark, folder):
    return (
        data.table(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(
            an.rows().alias("n"),
            F.sum("l_quantity").alias("sum_qty"),
            F.avg("l_quantity").alias("mean_qty"),
        )
    )


@query("a24_total_spend", oracle(
    "select cast(sum(cast(round(l_quantity * l_extendedprice * 100) as bigint)) as bigint) "
    "as total_cents from lineitem"))
def a24_total(spark, folder):
    cents = F.round(F.col("l_quantity") * F.col("l_extendedprice") * 100).cast("bigint")
    return data.table(spark, folder, "lineitem").agg(F.sum(cents).alias("total_cents"))


@query("o7_dearest_parts", oracle(
    "select p_partkey, p_name, " + r6("p_retailprice")
    + " from part order by part.p_retailprice desc, p_partkey limit 5"))
def o7(spark, folder):
    return (
        data.table(spark, folder, "part")
        .select("p_partkey", "p_name", "p_retailprice")
        .orderBy(F.desc("p_retailprice"), "p_partkey")
        .limit(5)
    )
