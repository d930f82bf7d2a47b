"""Bronze and silver operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.catalog import adapters as data
from rimeframe.catalog.registry import query
from rimeframe.catalog.sql import SILVER_LIST, columns, oracle, r6
from rimeframe.functions import climate, space
from rimeframe.functions.sampling import hash_sampled
from rimeframe.operators import bronze, gold, silver

BRONZE_LIST = columns("id date year month element value")
KEY = ("id", "date")


def wide(spark, folder):
    return silver.widen(data.bronze_readings(spark, folder))


def si(spark, folder):
    return silver.to_si(wide(spark, folder))


# --- bronze -------------------------------------------------------------------------------

@query("p1_bronze_typing", oracle(
    "select id, cast(date as varchar) as date, cast(year(date) as int) as year, "
    "cast(month(date) as int) as month, element, value, strftime(date, '%Y%m%d') as text "
    "from readings", "readings"))
def p1(spark, folder):
    raw = data.raw_readings(spark, folder).withColumn("value", F.col("value").try_cast("int"))
    typed = bronze.type_dates(raw)
    return typed.select(
        *KEY, "year", "month", "element", "value", F.date_format("date", "yyyyMMdd").alias("text")
    )


@query("f1_drop_undated", oracle(
    "select o_custkey as id, cast(cast(o_orderdate as date) as varchar) as date, count(*) as n "
    "from orders where o_orderpriority <> '5-LOW' group by 1, 2"))
def f1(spark, folder):
    """Orders of the lowest priority get a date text that is no date."""
    text = F.when(F.col("o_orderpriority") == "5-LOW", "20210231").otherwise(
        F.date_format("o_orderdate", "yyyyMMdd")
    )
    raw = data.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"), text.alias("date_raw")
    )
    dated = bronze.drop_undated(bronze.type_dates(raw))
    return dated.groupBy("id", "date").agg(F.count(F.lit(1)).alias("n"))


@query("f2_quality_filter", oracle(f"select {BRONZE_LIST} from bronze", "bronze"))
def f2(spark, folder):
    return data.bronze_readings(spark, folder).select(*KEY, "year", "month", "element", "value")


@query("f3_element_whitelist", oracle(
    f"select {BRONZE_LIST} from bronze where element in ('TMAX', 'TMIN')", "bronze"))
def f3(spark, folder):
    kept = bronze.only_elements(data.bronze_readings(spark, folder), ["TMAX", "TMIN"])
    return kept.select(*KEY, "year", "month", "element", "value")


@query("f4_year_range", oracle(
    f"select {BRONZE_LIST} from bronze where year between 1997 and 1999", "bronze"))
def f4(spark, folder):
    kept = bronze.only_years(data.bronze_readings(spark, folder), 1997, 1999)
    return kept.select(*KEY, "year", "month", "element", "value")


@query("f4_open_year_range", oracle(
    f"select {BRONZE_LIST} from bronze where year >= 2000", "bronze"))
def f4_open(spark, folder):
    kept = bronze.only_years(data.bronze_readings(spark, folder), first=2000)
    return kept.select(*KEY, "year", "month", "element", "value")


BOX = {"country": "US", "lat": (38.0, 40.0), "lon": (-103.0, -100.0)}
BOX_SQL = (
    "select id from stations where country_code = 'US' and latitude between 38.0 and 40.0 "
    "and longitude between -103.0 and -100.0"
)


@query("f5_stations_in_box", oracle(BOX_SQL, "stations"))
def f5(spark, folder):
    return bronze.stations_in_box(data.stations(spark, folder), BOX)


@query("j2_region_semi_join", oracle(
    f"select {BRONZE_LIST} from bronze where id in ({BOX_SQL})", "bronze"))
def j2(spark, folder):
    ids = bronze.stations_in_box(data.stations(spark, folder), BOX)
    kept = bronze.only_stations(data.bronze_readings(spark, folder), ids)
    return kept.select(*KEY, "year", "month", "element", "value")


# --- silver -------------------------------------------------------------------------------

@query("a1_widen", oracle(
    "select id, cast(date as varchar) as date, cast(year(date) as int) as year, "
    "cast(month(date) as int) as month, tmax_raw as tmax, tmin_raw as tmin, prcp_raw as prcp, "
    "snow_raw as snow, snwd_raw as snwd from wide", "wide"))
def a1(spark, folder):
    df = wide(spark, folder)
    return df.select(*KEY, "year", "month", *[F.col(e).alias(e.lower()) for e in fv.ELEMENTS])


def _user_oracle(pick: str) -> str:
    picks = ", ".join(
        f"{pick}(case when element = '{e}' then value end, case when element = '{e}' "
        f"then order_key end) as {e.lower()}" for e in fv.ELEMENTS
    )
    return oracle(
        f"select id, cast(date as varchar) as date, {picks} from user_readings "
        "where q_flag = '' group by id, date", None, ("user_readings",))


def _user_wide(spark, folder, latest):
    readings = bronze.passed_quality(data.user_readings(spark, folder))
    df = silver.widen(readings, "order_key", latest)
    return df.select(*KEY, *[F.col(e).alias(e.lower()) for e in fv.ELEMENTS])


@query("a1_widen_first", _user_oracle("min_by"))
def a1_first(spark, folder):
    return _user_wide(spark, folder, latest=False)


@query("a1_widen_latest", _user_oracle("max_by"))
def a1_latest(spark, folder):
    return _user_wide(spark, folder, latest=True)


SI_LIST = "id date year month tmax_c~ tmin_c~ prcp_mm~ snow_mm~ snwd_mm~"
SI_NAMES = [name.rstrip("~") for name in SI_LIST.split()]


@query("p2_units", oracle(f"select {columns(SI_LIST)} from si", "si"))
def p2(spark, folder):
    return si(spark, folder).select(*SI_NAMES)


@query("p3_temperature_range", oracle(
    f"select {columns('id date tmax_c~ tmin_c~')} from clipped", "clipped"))
def p3(spark, folder):
    return silver.clip_to_physics(si(spark, folder)).select(*KEY, "tmax_c", "tmin_c")


@query("p4_contradictions", oracle(
    f"select {columns('id date tmax_c~ tmin_c~')} from clean", "clean"))
def p4(spark, folder):
    clean = silver.drop_contradictions(silver.clip_to_physics(si(spark, folder)))
    return clean.select(*KEY, "tmax_c", "tmin_c")


@query("p4_contradictions_minimum_only", oracle(
    "select id, cast(date as varchar) as date, "
    f"{r6('case when tmin_c > tmax_c then null else tmin_c end', 'tmin_c')}, {r6('tmax_c')} "
    "from clipped", "clipped"))
def p4_minimum(spark, folder):
    clipped = silver.clip_to_physics(si(spark, folder))
    return silver.drop_contradictions(clipped, also_maximum=False).select(*KEY, "tmin_c", "tmax_c")


@query("p5_non_negative", oracle(
    f"select {columns('id date prcp_mm~ snow_mm~ snwd_mm~')} from clipped", "clipped"))
def p5(spark, folder):
    return silver.clip_to_physics(si(spark, folder)).select(*KEY, "prcp_mm", "snow_mm", "snwd_mm")


def _derived(spark, folder):
    return silver.derive(silver.drop_contradictions(silver.clip_to_physics(si(spark, folder))))


@query("p6_derived", oracle(
    f"select {columns('id date day_of_year tavg_c~ temp_range_c~')} from derived", "derived"))
def p6(spark, folder):
    return _derived(spark, folder).select(*KEY, "day_of_year", "tavg_c", "temp_range_c")


@query("p7_flags", oracle(
    f"select {columns('id date is_frost_day? is_heat_stress_day?')} from derived", "derived"))
def p7(spark, folder):
    return _derived(spark, folder).select(*KEY, "is_frost_day", "is_heat_stress_day")


@query("j1_station_enrichment", oracle(
    f"select {columns('id date name latitude~ longitude~ elevation_m~ state country_code')} "
    "from silver", "silver"))
def j1(spark, folder):
    joined = silver.describe_stations(wide(spark, folder), data.stations(spark, folder))
    return joined.select(
        *KEY, "name", "latitude", "longitude", "elevation_m", "state", "country_code"
    )


@query("p8_silver", oracle(f"select {columns(SILVER_LIST)} from silver", "silver"))
def p8(spark, folder):
    return data.silver_days(spark, folder)


# --- scalar expressions used elsewhere -----------------------------------------------------

@query("p9_daily_gdd", oracle(
    f"select id, cast(date as varchar) as date, {r6('tavg_c')}, "
    + r6("case when tavg_c is not null then greatest(0.0::double, tavg_c - 10.0) end", "corn")
    + ", " + r6("case when tavg_c is not null then greatest(0.0::double, tavg_c - 4.0) end", "wheat")
    + ", " + r6("case when tavg_c is not null then greatest(0.0::double, tavg_c - 7.5) end", "oat")
    + ", " + r6("greatest(0.0::double, tavg_c - 10.0)", "corn_missing_as_zero")
    + " from silver", "silver"))
def p9(spark, folder):
    tavg = F.col("tavg_c")
    bases = {**fv.GDD_BASE_C, "oat": 7.5}
    return data.silver_days(spark, folder).select(
        *KEY,
        "tavg_c",
        *[climate.growing_degrees(tavg, base).alias(crop) for crop, base in bases.items()],
        climate.growing_degrees(tavg, fv.GDD_BASE_C["corn"], missing_as_zero=True)
        .alias("corn_missing_as_zero"),
    )


@query("p10_grid_cells", oracle(
    f"select id, {r6('latitude')}, {r6('longitude')}, "
    "cast(floor(latitude) as bigint) as lat_1, cast(floor(longitude) as bigint) as lon_1, "
    "cast(floor(latitude / 3) * 3 as bigint) as lat_3, "
    "cast(floor(longitude / 3) * 3 as bigint) as lon_3, "
    f"{r6('floor(latitude / 0.5::double) * 0.5::double', 'lat_half')} from stations", "stations"))
def p10(spark, folder):
    lat, lon = F.col("latitude"), F.col("longitude")
    return data.stations(spark, folder).select(
        "id", "latitude", "longitude",
        space.cell(lat).alias("lat_1"), space.cell(lon).alias("lon_1"),
        space.cell(lat, 3).alias("lat_3"), space.cell(lon, 3).alias("lon_3"),
        space.cell(lat, 0.5).alias("lat_half"),
    )


@query("p13_elevation_band", oracle(
    f"select id, {r6('elevation_m')}, cast(trunc((elevation_m - 300) / 250) as int) * 250 as band "
    "from stations", "stations"))
def p13(spark, folder):
    """Shifted below sea level, so that truncation toward zero shows."""
    return data.stations(spark, folder).select(
        "id", "elevation_m", space.elevation_band(F.col("elevation_m") - 300).alias("band")
    )


@query("p17_absolute_and_negated", oracle(
    f"select id, {r6('abs(longitude)', 'abs_lon')}, {r6('-elevation_m', 'negated')} from stations",
    "stations"))
def p17(spark, folder):
    return data.stations(spark, folder).select(
        "id", F.abs("longitude").alias("abs_lon"), (-F.col("elevation_m")).alias("negated")
    )


@query("p20_expressions", oracle(
    f"""select event_id, kind, {r6('amount')}, whole,
    cast(amount between 10 and 50 as int) as middling,
    cast(kind in ('click', 'view') as int) as browsing, cast(props is null as int) as no_props,
    cast(hour(ts) as int) as hour, cast(dayofweek(ts) + 1 as int) as day_of_week, 1 as one
    from (select event_id, event_type as kind, round(value, 1) as amount, cast(floor(value) as int)
    as whole, ts, props from events)"""))
def p20(spark, folder):
    renamed = (
        data.table(spark, folder, "events")
        .withColumnRenamed("event_type", "kind")
        .withColumn("amount", F.round("value", 1))
        .withColumn("whole", F.floor("value").cast("int"))
        .drop("value", "user_id")
    )
    return renamed.select(
        "event_id", "kind", "amount", "whole",
        F.col("amount").between(10, 50).alias("middling"),
        F.col("kind").isin("click", "view").alias("browsing"),
        F.col("props").isNull().alias("no_props"),
        F.hour("ts").alias("hour"),
        F.dayofweek("ts").alias("day_of_week"),
        F.lit(1).alias("one"),
    )


@query("p21_delimited_text", oracle(
    f"select l_orderkey, l_linenumber, {r6('l_quantity', 'qty')}, {r6('l_tax', 'rate')}, "
    f"{r6('l_quantity * l_tax', 'amount')} from lineitem"))
def p21(spark, folder):
    """Lines of text split on a semicolon, typed safely and multiplied."""
    parts = ("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    lines = data.table(spark, folder, "lineitem").select(F.concat_ws(";", *parts).alias("line"))
    fields = F.split("line", ";")
    kinds = {"l_orderkey": "bigint", "l_linenumber": "int", "qty": "double", "rate": "double"}
    typed = lines.select(
        *[fields[i].try_cast(kind).alias(name) for i, (name, kind) in enumerate(kinds.items())]
    )
    return typed.withColumn("amount", F.col("qty") * F.col("rate"))


# --- sampling -----------------------------------------------------------------------------

def _point(keys: str, seed: int) -> str:
    text = f"concat_ws('|', '{seed}', {keys})"
    return f"cast(('0x' || substr(md5({text}), 1, 8)) as bigint) / 4294967296.0::double"


@query("j6_station_sample", oracle(
    f"select {columns('id date tmin_c~ is_frost_day?')} from silver where {_point('id', 42)} < 0.1",
    "silver"))
def j6(spark, folder):
    """A tenth of the stations, each with its whole series; no distinct and no join."""
    chosen = hash_sampled([F.col("id")], 0.10, seed=42, portable=True)
    return data.silver_days(spark, folder).filter(chosen).select(*KEY, "tmin_c", "is_frost_day")


@query("o4_row_sample", oracle(
    f"select {columns('id date tmin_c~')} from silver "
    f"where {_point('id, cast(date as varchar)', 1)} < 0.2", "silver"))
def o4(spark, folder):
    chosen = hash_sampled([F.col("id"), F.col("date")], 0.20, seed=1, portable=True)
    return data.silver_days(spark, folder).filter(chosen).select(*KEY, "tmin_c")


@query("o6_distinct_stations", oracle("select distinct id from silver", "silver"))
def o6(spark, folder):
    return data.silver_days(spark, folder).select("id").distinct()


@query("f6_min_history", oracle(
    "select id, count(*) as station_days from silver group by id having count(*) >= 45", "silver"))
def f6(spark, folder):
    kept = gold.with_enough_history(data.silver_days(spark, folder), 45)
    return kept.groupBy("id").agg(F.count(F.lit(1)).alias("station_days"))


@query("a3_rows_per_station", oracle(
    "select id, count(*) as station_days from silver group by id", "silver"))
def a3(spark, folder):
    return gold.station_history(data.silver_days(spark, folder))
