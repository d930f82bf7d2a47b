import pytest
from helpers import D, column, rows_of
from pyspark.sql import functions as F

from rimeframe.functions import climate, space
from rimeframe.operators import bronze, silver


def test_bad_dates_are_dropped_without_an_error(spark):
    raw = spark.createDataFrame(
        [("a", "20200101"), ("b", "20200231"), ("c", "2020AB01"), ("d", None)],
        "id STRING, date_raw STRING",
    )
    typed = bronze.type_dates(raw)
    assert column(typed, "date", order=("id",)) == [D(2020, 1, 1), None, None, None]
    kept = bronze.drop_undated(typed).collect()
    assert [(r.id, r.year, r.month) for r in kept] == [("a", 2020, 1)]


def test_quality_flag(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "X")], "id STRING, q_flag STRING")
    assert sorted(r.id for r in bronze.passed_quality(df).collect()) == ["a", "b"]


def test_year_bounds_may_be_open(spark):
    df = spark.range(2000, 2010).select(F.col("id").cast("int").alias("year"))
    assert bronze.only_years(df, first=2008).count() == 2
    assert bronze.only_years(df, last=2001).count() == 2
    assert bronze.only_years(df, 2003, 2005).count() == 3
    assert bronze.only_years(df).count() == 10


def test_station_list_cannot_multiply_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id STRING, v INT")
    ids = spark.createDataFrame([("a",), ("a",)], "id STRING")
    assert [tuple(r) for r in bronze.only_stations(df, ids).collect()] == [("a", 1)]


def test_box_needs_country_and_position(spark):
    stations = spark.createDataFrame(
        [("in", "US", 40.0, -90.0), ("edge", "US", 37.0, -104.0), ("other", "CA", 40.0, -90.0),
         ("south", "US", 36.9, -90.0), ("nowhere", "US", None, None)],
        "id STRING, country_code STRING, latitude DOUBLE, longitude DOUBLE",
    )
    box = {"country": "US", "lat": (37.0, 49.0), "lon": (-104.0, -80.0)}
    assert sorted(r.id for r in bronze.stations_in_box(stations, box).collect()) == ["edge", "in"]


def _long(spark, rows):
    return spark.createDataFrame(rows, "id STRING, date DATE, element STRING, value INT, o BIGINT")


def test_pivot_pick_is_deterministic(spark):
    day = D(2020, 1, 1)
    rows = [("a", day, "TMIN", 5, 3), ("a", day, "TMIN", 9, 1), ("a", day, "TMIN", None, 0),
            ("a", day, "TMAX", 50, 2), ("a", day, "XXXX", 1, 0)]
    for ordered in (rows, rows[::-1]):
        df = _long(spark, ordered).repartition(3)
        assert silver.widen(df).first().TMIN == 5
        assert silver.widen(df, "o").first().TMIN == 9
        assert silver.widen(df, "o", latest=True).first().TMIN == 5
        assert silver.widen(df).first().TMAX == 50
        assert silver.widen(df).first().PRCP is None
        assert silver.widen(df).count() == 1


def test_units(spark):
    day = D(2020, 1, 1)
    wide = silver.to_si(silver.widen(_long(
        spark, [("a", day, "TMAX", 263, 0), ("a", day, "PRCP", 5, 0), ("a", day, "SNOW", 5, 0)]
    ))).first()
    assert (round(wide.tmax_c, 9), wide.prcp_mm, wide.snow_mm, wide.tmin_c) == (26.3, 0.5, 5.0, None)


def test_physical_limits_are_inclusive(spark):
    df = spark.createDataFrame([(-90.0,), (-90.1,), (60.0,), (60.1,), (None,)], "t DOUBLE")
    got = [r[0] for r in df.select(climate.plausible_temperature(F.col("t"))).collect()]
    assert got == [-90.0, None, 60.0, None, None]


def test_contradictions(spark):
    df = spark.createDataFrame(
        [(5.0, 1.0), (None, 3.0), (3.0, None), (1.0, 5.0)], "tmin_c DOUBLE, tmax_c DOUBLE"
    )
    both = [tuple(r) for r in silver.drop_contradictions(df).select("tmin_c", "tmax_c").collect()]
    assert both == [(None, None), (None, 3.0), (3.0, None), (1.0, 5.0)]
    one = silver.drop_contradictions(df, also_maximum=False).select("tmin_c", "tmax_c").collect()
    assert tuple(one[0]) == (None, 1.0)


def test_rain_and_flags(spark):
    df = spark.createDataFrame([(-0.1,), (0.0,)], "p DOUBLE")
    assert [r[0] for r in df.select(climate.non_negative(F.col("p"))).collect()] == [None, 0.0]
    t = spark.createDataFrame(
        [(0.0, 30.0), (0.1, 29.9), (None, None)], "tmin DOUBLE, tmax DOUBLE"
    )
    got = t.select(climate.is_frost(F.col("tmin")), climate.is_heat_stress(F.col("tmax"))).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False), (None, None)]


def test_mean_and_range_need_both_temperatures(spark):
    df = spark.createDataFrame(
        [(D(2020, 12, 31), None, 10.0), (D(2020, 3, 1), 2.0, 10.0)],
        "date DATE, tmin_c DOUBLE, tmax_c DOUBLE",
    )
    a, b = silver.derive(df).collect()
    assert (a.tavg_c, a.temp_range_c, a.is_frost_day, a.day_of_year) == (None, None, None, 366)
    assert (b.tavg_c, b.temp_range_c, b.is_frost_day, b.is_heat_stress_day) == (6.0, 8.0, False, False)


def test_unknown_station_keeps_its_days(spark):
    day = D(2020, 1, 1)
    readings = _long(spark, [("a", day, "TMIN", 10, 0), ("b", day, "TMIN", 20, 0)])
    stations = spark.createDataFrame(
        [("a", "Alpha", 40.0, -90.0, 100.0, "KS", "US")],
        "id STRING, name STRING, latitude DOUBLE, longitude DOUBLE, elevation DOUBLE, state STRING,"
        " country_code STRING",
    )
    out = silver.to_silver(readings, stations)
    assert out.columns == list(silver.SILVER_COLUMNS)
    assert column(out, "name", "elevation_m") == [("Alpha", 100.0), (None, None)]


def test_silver_does_not_depend_on_layout(spark, sf):
    from rimeframe.catalog import adapters

    readings = adapters.bronze_readings(spark, sf)
    stations = adapters.stations(spark, sf)
    one = silver.to_silver(readings, stations)
    other = silver.to_silver(readings.orderBy(F.rand(1)).repartition(7), stations)
    assert rows_of(one) == rows_of(other)
    assert one.count() == one.select("id", "date").distinct().count()


@pytest.mark.parametrize(
    "meters,band", [(-10.0, 0), (249.0, 0), (250.0, 250), (-250.0, -250), (3500.0, 3500)]
)
def test_elevation_bands(spark, meters, band):
    df = spark.createDataFrame([(meters,)], "e DOUBLE")
    assert df.select(space.elevation_band(F.col("e"))).first()[0] == band


def test_cells(spark):
    df = spark.createDataFrame([(40.9, -80.5)], "lat DOUBLE, lon DOUBLE")
    cells = df.select(space.cell(F.col("lat")).alias("a"), space.cell(F.col("lon")).alias("b"),
                      space.cell(F.col("lat"), 0.5).alias("c"), space.cell(F.col("lon"), 3).alias("d"))
    assert dict(cells.dtypes) == {"a": "bigint", "b": "bigint", "c": "double", "d": "bigint"}
    assert tuple(cells.first()) == (40, -81, 40.5, -81)


def test_rain_classes(spark):
    amounts = [0.1, 0.11, 5.0, 15.0, 40.0, 40.1, None]
    df = spark.createDataFrame([(a,) for a in amounts], "p DOUBLE")
    got = [tuple(r) for r in df.select(climate.rain_class(F.col("p")),
                                       climate.rain_class_rank(F.col("p"))).collect()]
    assert got == [("0 (dry)", 0), ("0–5 mm", 1), ("0–5 mm", 1), ("5–15 mm", 2),
                   ("15–40 mm", 3), ("40+ mm", 4), (None, None)]


def test_overlapping_boxes(spark):
    boxes = {"all": {"lat": (0, 90), "lon": (-180, 180)}, "west": {"lat": (0, 90), "lon": (-180, 0)}}
    df = spark.createDataFrame([(1.0, -5.0), (1.0, 5.0), (-1.0, 5.0)], "lat DOUBLE, lon DOUBLE")
    got = df.select(space.boxes_containing(F.col("lat"), F.col("lon"), boxes)).collect()
    assert [r[0] for r in got] == [["all", "west"], ["all"], []]
