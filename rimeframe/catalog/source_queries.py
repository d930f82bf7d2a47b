"""Files written from the test tables and read back, and incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.catalog import adapters as data
from rimeframe.catalog.registry import query
from rimeframe.catalog.sql import columns, oracle, r6
from rimeframe.functions import climate
from rimeframe.operators import bronze, silver
from rimeframe.operators import evaluation as ev
from rimeframe.operators import modelling as ml
from rimeframe.plans.training import SUMMARY_SCHEMA, train_frost_model
from rimeframe.sources import fixed_width as fw
from rimeframe.sources import layers, readings
from rimeframe.storage import fresh_path
from rimeframe.streaming.ingest import OWNED, ingest_landed
from rimeframe.streaming.owned import ingest_changed, read_owned

LONG = "id date year month element value"
LONG_SQL = oracle(f"select {columns(LONG)} from bronze", "bronze")
LONG_NAMES = LONG.split()


#: Line items, of up to five readings each, beyond which a year is cut into one more file.
ITEMS_PER_SLICE = 16_000_000


def by_year(raw, folder, parts, per_slice=ITEMS_PER_SLICE):
    """The rows in ``parts`` partitions of whole years, on larger tables in as many for each slice of the years.

    So no writer gets more than a slice of a year, or of the few years that share a partition.
    """
    year = F.substring("date_raw", 1, 4)
    slices = 1 + data.table(raw.sparkSession, folder, "lineitem").count() // per_slice
    if slices == 1:
        return raw.repartition(parts, year)
    part = year.try_cast("int") * slices + F.pmod(F.xxhash64("id", "date_raw"), F.lit(slices)).cast("int")
    return raw.repartitionById(parts * slices, F.coalesce(F.pmod(part, F.lit(parts * slices)), F.lit(0)).cast("int"))


def landed_csv(spark, folder, name="landing"):
    """All readings as headerless CSV, about one year per file; years of larger tables in several."""
    path = fresh_path(spark, name)
    by_year(data.raw_readings(spark, folder), folder, 8).write.csv(path)
    return path


# --- readings -----------------------------------------------------------------------------

@query("s1_csv_scan", LONG_SQL)
def s1(spark, folder):
    raw = readings.read_readings(spark, landed_csv(spark, folder))
    return bronze.to_bronze(raw).select(*LONG_NAMES)


@query("s1_reject_counts", oracle(
    "select element, count(*) as n, count(*) filter (where value = 9999) as n_rejected, "
    "count(*) filter (where value = 9999) as n_null from readings group by element", "readings"))
def s1_rejects(spark, folder):
    """Text in the integer column: the line is kept, the field is NULL, the reject is counted."""
    path = fresh_path(spark, "rejects")
    raw = data.raw_readings(spark, folder)
    raw.withColumn(
        "value", F.when(F.col("value") == "9999", "n/a").otherwise(F.col("value"))
    ).write.csv(path)
    read = readings.read_readings(spark, path, keep_rejects=True)
    return read.groupBy("element").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(readings.CORRUPT).alias("n_rejected"),
        F.count_if(F.col("value").isNull()).alias("n_null"),
    )


@query("s2_year_inputs", oracle(
    "select element, cast(year(date) as int) as year, count(*) as n from readings "
    "where year(date) between 1996 and 2001 group by 1, 2", "readings"))
def s2(spark, folder):
    """Years landed as plain or packed files (one as both); the wanted range is read.

    The last wanted year has not landed at all and only warns.
    """
    path = fresh_path(spark, "by-year")
    raw = data.raw_readings(spark, folder)
    for year in range(1995, 2002):
        of_year = raw.filter(F.col("date_raw").startswith(str(year)))
        if year % 2 or year == 1998:
            of_year.write.csv(f"{path}/{year}.csv")
        if year % 2 == 0:
            of_year.write.option("compression", "gzip").csv(f"{path}/{year}.csv.gz")
    paths = readings.resolve_year_files(spark, path, 1996, 2002)
    typed = bronze.type_dates(readings.read_readings(spark, paths))
    return typed.groupBy("element", "year").agg(F.count(F.lit(1)).alias("n"))


# --- fixed-width metadata -----------------------------------------------------------------

def _at(column, width, right=False):
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.lpad(text, width, " ") if right else F.rpad(text, width, " ")


def _station_lines(spark, folder):
    number = lambda name: F.round(name, 4).cast("decimal(9,4)")
    return data.stations(spark, folder).select(
        F.concat(
            _at(F.concat(F.lit("US"), F.lpad("id", 9, "0")), 11), F.lit(" "),
            _at(number("latitude"), 8, True), F.lit(" "),
            _at(number("longitude"), 9, True), F.lit(" "),
            _at(F.col("elevation_m").cast("decimal(6,1)"), 6, True), F.lit(" "),
            _at(F.col("state"), 2), F.lit(" "),
            _at(F.col("name"), 30), F.lit(" "),
            _at(F.lit("GSN"), 3), F.lit(" "), _at(F.lit(""), 3), F.lit(" "),
            _at(F.substring("id", 3, 5), 5),
        ).alias("value")
    )


@query("s4_station_file", oracle(
    f"select 'US' || lpad(id, 9, '0') as id, {r6('latitude')}, {r6('longitude')}, "
    f"{r6('elevation_m', 'elevation')}, state, name, 'GSN' as gsn_flag, "
    "cast(null as varchar) as hcn_crn_flag, substr(id, 3, 5) as wmo_id, 'US' as country_code "
    "from stations", "stations"))
def s4(spark, folder):
    path = fresh_path(spark, "stations")
    _station_lines(spark, folder).write.text(path)
    return fw.read_stations(spark, path)


@query("s3_fixed_width", oracle(
    "select p_partkey as part, p_name as name, p_size as size, " + r6("p_retailprice", "price")
    + " from part"))
def s3(spark, folder):
    """Another layout with the same reader; it is data, not code."""
    path = fresh_path(spark, "parts")
    data.table(spark, folder, "part").select(
        F.concat(
            _at(F.col("p_partkey"), 10, True), F.lit(" "), _at(F.col("p_name"), 40), F.lit(" "),
            _at(F.col("p_size"), 4, True), F.lit(" "),
            _at(F.col("p_retailprice").cast("decimal(12,2)"), 12, True),
        ).alias("value")
    ).write.text(path)
    layout = (("part", 1, 10, "bigint"), ("name", 12, 51, "string"), ("size", 53, 56, "int"),
              ("price", 58, 69, "double"))
    return fw.read_fixed_width(spark, path, layout)


@query("s5_code_tables", oracle(
    "select 'country' as kind, substr(n_name, 1, 1) || cast(n_regionkey as varchar) as code, "
    "n_name as name from nation union all "
    "select 'state', lpad(cast(r_regionkey as varchar), 2, '0'), r_name from region"))
def s5(spark, folder):
    nations, regions = fresh_path(spark, "countries"), fresh_path(spark, "states")
    code = F.concat(F.substring("n_name", 1, 1), F.col("n_regionkey").cast("string"))
    data.table(spark, folder, "nation").select(
        F.concat(_at(code, 2), F.lit(" "), F.col("n_name")).alias("value")
    ).write.text(nations)
    data.table(spark, folder, "region").select(
        F.concat(F.lpad(F.col("r_regionkey").cast("string"), 2, "0"), F.lit(" "), F.col("r_name"))
        .alias("value")
    ).write.text(regions)
    return (
        fw.read_countries(spark, nations).withColumn("kind", F.lit("country"))
        .unionByName(fw.read_states(spark, regions).withColumn("kind", F.lit("state")))
    )


@query("s6_inventory_file", oracle(
    f"select 'US' || lpad(r.id, 9, '0') as id, {r6('latitude')}, {r6('longitude')}, element, "
    "cast(min(year(date)) as int) as first_year, cast(max(year(date)) as int) as last_year "
    "from readings r join stations s on r.id = s.id group by r.id, latitude, longitude, element",
    "readings"))
def s6(spark, folder):
    """Element coverage per station, written in the inventory layout and parsed."""
    path = fresh_path(spark, "inventory")
    coverage = (
        data.readings(spark, folder)
        .groupBy("id", "element")
        .agg(F.min(F.year("date")).alias("first"), F.max(F.year("date")).alias("last"))
        .join(data.stations(spark, folder), "id")
    )
    coverage.select(
        F.concat(
            F.concat(F.lit("US"), F.lpad("id", 9, "0")), F.lit(" "),
            _at(F.col("latitude").cast("decimal(8,4)"), 8, True), F.lit(" "),
            _at(F.col("longitude").cast("decimal(9,4)"), 9, True), F.lit(" "),
            _at(F.col("element"), 4), F.lit(" "),
            _at(F.col("first"), 4), F.lit(" "), _at(F.col("last"), 4),
        ).alias("value")
    ).write.text(path)
    return fw.read_inventory(spark, path)


# --- layers -------------------------------------------------------------------------------

SILVER_PART = "id date year tmax_c~ tmin_c~ prcp_mm~ name"
SILVER_PART_NAMES = [token.rstrip("~") for token in SILVER_PART.split()]


@query("s7_parquet_scan", oracle(
    f"select {columns(SILVER_PART)} from silver where year between 1998 and 2000", "silver"))
def s7(spark, folder):
    """Partition pruning and column pruning on a written layer."""
    path = fresh_path(spark, "silver")
    layers.write_years(data.silver_days(spark, folder), path, sort_by=("id", "date"))
    return bronze.only_years(layers.read_layer(spark, path), 1998, 2000).select(*SILVER_PART_NAMES)


@query("s8_dynamic_overwrite", oracle(f"select {columns(SILVER_PART)} from silver", "silver"))
def s8(spark, folder):
    """All years are written, then one of them again: nothing doubles, nothing is lost."""
    path = fresh_path(spark, "silver")
    days = data.silver_days(spark, folder)
    layers.write_years(days, path)
    layers.write_years(days.filter(F.col("year") == data.TEST_YEAR), path)
    return layers.read_layer(spark, path).select(*SILVER_PART_NAMES)


@query("s9_append", LONG_SQL)
def s9(spark, folder):
    """Two disjoint ranges of years appended to one table."""
    path = fresh_path(spark, "bronze")
    long = data.bronze_readings(spark, folder).select(*LONG_NAMES)
    layers.append_years(bronze.only_years(long, last=1998), path)
    layers.append_years(bronze.only_years(long, first=1999), path)
    return layers.read_layer(spark, path).select(*LONG_NAMES)


@query("s10_dimension_file", oracle(
    f"select id, name, {r6('latitude')}, {r6('longitude')}, {r6('elevation_m')}, state, "
    "country_code from stations", "stations"))
def s10(spark, folder):
    path = fresh_path(spark, "dimension")
    layers.write_dimension(data.stations(spark, folder), path)
    return layers.read_layer(spark, path)


@query("s11_climate_csv", oracle(
    f"select year, month, {r6('oni_anom')}, case when oni_anom <= -0.5 then 'nina' "
    "when oni_anom >= 0.5 then 'nino' else 'neutral' end as phase from oni", None, ("oni",)))
def s11(spark, folder):
    path = fresh_path(spark, "climate")
    data.climate_index(spark, folder).write.option("header", True).csv(path)
    index = readings.read_climate_index(spark, path)
    return index.withColumn("phase", climate.enso_phase(F.col("oni_anom")))


_ORDER_SQL = "select o_orderkey, o_orderstatus, " + r6("o_totalprice") + " from orders"


def _orders_csv(spark, folder, separator):
    path = fresh_path(spark, "orders")
    wanted = data.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    wanted.write.option("header", True).option("sep", separator).csv(path)
    return path


@query("s12_header_csv_with_schema", _ORDER_SQL)
def s12_schema(spark, folder):
    path = _orders_csv(spark, folder, ";")
    schema = "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
    return readings.read_delimited(spark, path, schema, ";")


@query("s12_header_csv_inferred", _ORDER_SQL)
def s12_inferred(spark, folder):
    path = _orders_csv(spark, folder, ",")
    inferred = readings.read_delimited(spark, path)
    return inferred.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("s13_rows_in_memory", oracle(
    "select element, case element when 'TMAX' then 'tmax_c' when 'TMIN' then 'tmin_c' "
    "when 'PRCP' then 'prcp_mm' when 'SNOW' then 'snow_mm' else 'snwd_mm' end as target, "
    + r6("sum(value) * case when element in ('TMAX', 'TMIN', 'PRCP') then 0.1::double else 1 end",
         "total") + " from bronze group by element", "bronze"))
def s13(spark, folder):
    """The element map as a table made from rows, joined to all readings."""
    elements = spark.createDataFrame(
        [(element, target, scale) for element, (target, scale) in fv.ELEMENTS.items()],
        "element STRING, target STRING, scale DOUBLE",
    )
    totals = data.bronze_readings(spark, folder).groupBy("element").agg(F.sum("value").alias("v"))
    return totals.join(elements, "element").select(
        "element", "target", (F.col("v") * F.col("scale")).alias("total")
    )


@query("s14_metrics_file", oracle(
    "select 'rule' as model, 2001 as test_year, count(*) as n_test, "
    + r6("avg(cast(label = prediction as double))", "accuracy") + " from ruled", "ruled"))
def s14(spark, folder):
    path = fresh_path(spark, "metrics")
    judged = ev.with_rule(ml.labelled(data.gold_days(spark, folder))).filter(
        F.col("year") == data.TEST_YEAR
    )
    counts = ev.confusion(judged)
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    layers.write_metrics(
        counts.select(
            F.lit("rule").alias("model"),
            F.lit(data.TEST_YEAR).alias("test_year"),
            total.alias("n_test"),
            ((F.col("tn") + F.col("tp")) / total).alias("accuracy"),
        ),
        path,
    )
    return spark.read.schema("model STRING, test_year INT, n_test BIGINT, accuracy DOUBLE").json(path)


@query("s14_training_record")
def s14_record(spark, folder):
    """The whole record of a tuned training job, read back from its file."""
    gold_path, path = fresh_path(spark, "gold"), fresh_path(spark, "record")
    layers.write_years(data.gold_days(spark, folder), gold_path)
    gold = layers.read_layer(spark, gold_path)
    train_frost_model(spark, gold, fresh_path(spark, "model"), path, data.TEST_YEAR, "lr", tuned=True, parallelism=4)
    return spark.read.schema(SUMMARY_SCHEMA).json(path).select(
        "algorithm", "test_year", "sample_fraction", "n_train", "n_test", "tuning.cv_folds",
        "tuning.param_grid_size", "tuning.metric", "tuning.best_cv_score",
        F.to_json("tuning.best_params").alias("best_params"), F.size("tuning.all_cv_scores").alias("n_scores"),
        F.map_entries("metrics").alias("metrics"), F.to_json("confusion").alias("confusion"),
        F.size("top_features").alias("n_features"))


@query("s15_sample_export", oracle(
    f"select {columns('id date tmin_c~ next_day_is_frost?')} from labels_ahead where "
    "cast(('0x' || substr(md5(concat_ws('|', '7', id, cast(date as varchar))), 1, 8)) as bigint) "
    "/ 4294967296.0::double < 0.05", "labels_ahead"))
def s15(spark, folder):
    path = fresh_path(spark, "sample")
    layers.export_sample(
        data.gold_days(spark, folder), path, 0.05, ("id", "date"), seed=7, portable=True
    )
    return layers.read_layer(spark, path).select("id", "date", "tmin_c", "next_day_is_frost")


# --- incremental ingest -------------------------------------------------------------------

@query("t1_stream_ingest", LONG_SQL)
def t1(spark, folder):
    """Files ingested, ingested again (nothing new), and replayed under a new checkpoint."""
    landing, target = landed_csv(spark, folder), fresh_path(spark, "bronze")
    first, second = fresh_path(spark, "checkpoint"), fresh_path(spark, "checkpoint")
    for checkpoint in (first, first, second):
        ingest_landed(spark, landing, target, checkpoint, tuple(fv.ELEMENTS), files_per_batch=4)
    return layers.read_layer(spark, target).select(*LONG_NAMES)


@query("t1_correction_file", oracle(
    f"select id, cast(date as varchar) as date, {r6('tmin_raw / 10.0::double + 1', 'tmin_c')} "
    "from wide where tmin_raw is not null", "wide"))
def t1_correction(spark, folder):
    """A second delivery raises every minimum by one degree; the later landing wins."""
    target, checkpoint = fresh_path(spark, "bronze"), fresh_path(spark, "checkpoint")
    landing = landed_csv(spark, folder)
    ingest_landed(spark, landing, target, checkpoint, files_per_batch=8)
    raised = data.raw_readings(spark, folder).filter(F.col("element") == "TMIN").withColumn(
        "value", (F.col("value").cast("int") + 10).cast("string")
    )
    by_year(raised, folder, 8).write.mode("append").csv(landing)
    ingest_landed(spark, landing, target, checkpoint, files_per_batch=8)
    long = layers.read_layer(spark, target)
    wide = silver.to_si(silver.widen(long))
    return wide.filter(F.col("tmin_c").isNotNull()).select("id", "date", "tmin_c")


@query("t1_same_name_files", LONG_SQL)
def t1_same_names(spark, folder):
    """Two landing folders with files of the same names: each keeps its rows."""
    landing, target = fresh_path(spark, "landing"), fresh_path(spark, "bronze")
    raw = data.raw_readings(spark, folder)
    half = F.pmod(F.crc32("id"), F.lit(2))
    for part in (0, 1):
        by_year(raw.filter(half == part), folder, 4).write.csv(f"{landing}/part{part}/2000.csv")
    ingest_landed(spark, f"{landing}/*/*", target, fresh_path(spark, "checkpoint"),
                  tuple(fv.ELEMENTS))
    return layers.read_layer(spark, target).select(*LONG_NAMES)


@query("s8_stray_year", oracle(
    "select cast(year(date) as int) as year, count(*) as n from readings where "
    "coalesce(q_flag, '') = '' group by 1", "readings"))
def s8_stray_year(spark, folder):
    """Files whose readings spill over into a neighbour's year; each is ingested on its own."""
    target = fresh_path(spark, "bronze")
    raw = data.raw_readings(spark, folder)
    odd = F.pmod(F.crc32("id"), F.lit(3)) == 0
    for part in (odd, ~odd):
        path = fresh_path(spark, "stray")
        raw.filter(part).write.csv(path)
        typed = bronze.to_bronze(readings.with_origin(readings.read_readings(spark, path)))
        layers.write_years(typed, target, by=OWNED)
    return layers.read_layer(spark, target).groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@query("s8_owned_partitions", oracle(
    f"select {columns(LONG)} from bronze where not (cast(substr(id, 2) as int) % 4 = 0 and year < 1998)",
    "bronze"))
def s8_owned(spark, folder):
    """Deliveries of all years; one is landed again without its first years, which go with it."""
    landing, target = fresh_path(spark, "landing"), fresh_path(spark, "bronze")
    raw = data.raw_readings(spark, folder)
    part = F.substring("id", 2, 9).cast("int") % 4
    for k in range(4):
        raw.filter(part == k).write.csv(f"{landing}/delivery{k}.csv")
    ingest_changed(spark, landing, target)
    later = raw.filter((part == 0) & (F.substring("date_raw", 1, 4).cast("int") >= 1998))
    later.write.mode("overwrite").csv(f"{landing}/delivery0.csv")
    ingest_changed(spark, landing, target, drop_missing=True)
    return read_owned(spark, target).select(*LONG_NAMES)
