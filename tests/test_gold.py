from datetime import timedelta

import pytest
from helpers import D, column, daily, rows_of, silver_row, silver_table
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.catalog import adapters
from rimeframe.operators import gold
from rimeframe.streaming.slices import rebuild_gold_years, with_halo


def gappy(spark):
    return silver_table(spark, [
        silver_row("a", D(2020, 1, 1), 1.0, 5.0),
        silver_row("a", D(2020, 1, 9), None, 5.0),
        silver_row("a", D(2020, 1, 10), 3.0, 9.0),
    ])


def test_lags_and_frames_count_rows_by_default(spark):
    df = gappy(spark).withColumns({**gold.lags(), **gold.rolling()})
    assert column(df, "tmin_c_lag_1") == [None, 1.0, None]
    assert column(df, "tmin_c_roll7_mean") == [1.0, 1.0, 2.0]
    assert column(df, "tmax_c_roll7_max") == [5.0, 5.0, 9.0]
    assert column(df, "frost_days_roll30") == [0, 0, 0]


def test_frames_may_count_days(spark):
    df = gappy(spark).withColumns(gold.rolling("days"))
    assert column(df, "tmin_c_roll7_mean") == [1.0, None, 3.0]
    with pytest.raises(ValueError):
        gold.trailing(7, "weeks")


def test_lag_seven_and_full_frames(spark):
    values = [float(v) for v in range(40)]
    df = silver_table(spark, daily("a", D(2020, 1, 1), values)).withColumns(
        {**gold.lags(), **gold.rolling()}
    )
    assert column(df, "tmin_c_lag_7") == [None] * 7 + values[:-7]
    means = column(df, "tmin_c_roll30_mean")
    assert means[39] == pytest.approx(sum(values[10:]) / 30) and means[1] == 0.5


def test_labels_and_horizons(spark):
    df = silver_table(spark, daily("a", D(2020, 1, 1), [1.0, -1.0, None, 2.0]) +
                      daily("b", D(2020, 1, 1), [-5.0]))
    labelled = df.withColumns({**gold.next_day_labels(), **gold.horizon_labels((1, 3))})
    assert column(labelled, "next_day_is_frost") == [True, None, False, None, None]
    assert column(labelled, "next_day_tmin_c") == [-1.0, None, 2.0, None, None]
    assert column(labelled, "y_h1") == [1.0, None, 0.0, None, None]
    assert column(labelled, "y_h3") == [0.0, None, None, None, None]


def test_growing_degrees(spark):
    rows = [
        silver_row("a", D(2020, 12, 30), 10.0, 20.0),
        silver_row("a", D(2020, 12, 31), None, 20.0),
        silver_row("a", D(2021, 1, 1), 0.0, 10.0),
        silver_row("a", D(2021, 1, 2), 11.0, 13.0),
    ]
    df = gold.with_growing_degrees(silver_table(spark, rows))
    assert column(df, "gdd_corn_day") == [5.0, None, 0.0, 2.0]
    assert column(df, "gdd_corn_ytd") == [5.0, 5.0, 0.0, 2.0]
    assert column(df, "gdd_wheat_ytd") == [11.0, 11.0, 1.0, 9.0]
    zero = gold.with_growing_degrees(silver_table(spark, rows), missing_as_zero=True)
    assert column(zero, "gdd_corn_day") == [5.0, 0.0, 0.0, 2.0]
    more = gold.with_growing_degrees(silver_table(spark, rows), {"rye": 5.0})
    assert column(more, "gdd_rye_day") == [10.0, None, 0.0, 7.0]


def test_region(spark):
    day = D(2020, 1, 1)
    at = {"lat": 40.2, "lon": -90.7}
    df = silver_table(spark, [
        silver_row("a", day, 2.0, **at), silver_row("b", day, 4.0, lat=40.9, lon=-90.1),
        silver_row("c", day, None, **at), silver_row("d", day, 9.0, lat=41.0, lon=-90.7),
        silver_row("e", day, 7.0),
    ])
    out = gold.with_region(df)
    assert column(out, "region_tmin_mean") == [3.0, 3.0, 3.0, 9.0, None]
    assert column(out, "region_tmin_min") == [2.0, 2.0, 2.0, 9.0, None]
    assert column(out, "region_n_stations") == [2, 2, 2, 1, None]
    assert column(out, "tmin_minus_region") == [-1.0, 1.0, None, 0.0, None]
    others = gold.with_region(df, leave_one_out=True)
    assert column(others, "region_tmin_mean") == [4.0, 2.0, 3.0, None, None]


def test_min_history(spark):
    rows = daily("a", D(2020, 1, 1), [1.0] * 29) + daily("b", D(2020, 1, 1), [1.0] * 30)
    df = silver_table(spark, rows)
    assert gold.with_enough_history(df, 30).select("id").distinct().collect()[0].id == "b"
    assert gold.with_enough_history(df, 0).count() == 59
    listed = gold.with_enough_history(df, 30, history=gold.station_history(df))
    assert rows_of(listed) == rows_of(gold.with_enough_history(df, 30))


def test_climate_index(spark):
    df = silver_table(spark, daily("a", D(2020, 1, 30), [1.0, 1.0, 1.0]))
    index = spark.createDataFrame(
        [(2020, 1, -0.5), (2020, 1, -0.7), (2020, 13, 9.0)], "year INT, month INT, oni_anom DOUBLE"
    )
    out = gold.with_climate(df, index)
    assert column(out, "oni_anom", "enso_phase") == [(-0.5, "nina")] * 2 + [(None, None)]


def test_gold_keeps_every_row_and_has_its_columns(spark, sf):
    days = adapters.silver_days(spark, sf)
    built = gold.to_gold(days)
    assert len(built.columns) == 46 and built.columns[:20] == days.columns
    assert built.count() == gold.with_enough_history(days).count()
    assert set(fv.FEATURES) <= set(built.columns)
    with_index = gold.to_gold(days, adapters.climate_index(spark, sf))
    assert len(with_index.columns) == 48 and with_index.count() == built.count()


def test_gold_does_not_depend_on_layout(spark, sf):
    days = adapters.silver_days(spark, sf)
    shuffled = days.orderBy(F.rand(3)).repartition(5)
    assert rows_of(gold.to_gold(days)) == rows_of(gold.to_gold(shuffled))


def test_slice_with_halo_equals_full_build(spark, sf):
    days = adapters.silver_days(spark, sf)
    full = gold.to_gold(days)
    for first, last in ((1998, 1999), (1995, 1995), (2001, 2001)):
        part = rebuild_gold_years(days, first, last)
        expected = full.filter(F.col("year").between(first, last))
        assert part.count() > 0
        assert rows_of(part) == rows_of(expected)


def test_halo_takes_rows_not_days(spark):
    old = daily("a", D(1990, 1, 1), [float(i) for i in range(50)])
    rows = old + daily("a", D(2020, 6, 1), [1.0, 2.0]) + daily("a", D(2030, 1, 1), [9.0, 8.0])
    rows += daily("gone", D(1990, 1, 1), [1.0] * 60)
    halo = with_halo(silver_table(spark, rows), 2020, 2020)
    got = column(halo, "id", "date")
    assert len(got) == 50 + 2 + 2  # whole years, those that hold enough rows
    assert got[0] == ("a", D(1990, 1, 1)) and got[-1] == ("a", D(2030, 1, 2))


def test_one_sparse_station_does_not_widen_the_halo_of_others(spark):
    rows = daily("dense", D(2010, 1, 1), [1.0] * 4000)
    for year in range(1941, 2021, 3):
        rows += daily("sparse", D(year, 5, 1), [2.0])
    df = silver_table(spark, rows)
    halo = with_halo(df, 2019, 2020)
    years = {r.id: r.years for r in halo.groupBy("id").agg(
        F.sort_array(F.collect_set("year")).alias("years")).collect()}
    assert years["dense"] == [2018, 2019, 2020]
    assert years["sparse"] == list(range(1941, 2021, 3))
    built = rebuild_gold_years(df, 2019, 2020, min_days=0)
    expected = gold.to_gold(df, min_days=0).filter(F.col("year").between(2019, 2020))
    assert rows_of(built) == rows_of(expected)


def test_long_row_frames_are_exact(spark):
    """Tiny, huge and invalid readings: a 30-row frame is what the same frame of days is."""
    small = [i * 1e-7 for i in range(1, 41)]
    df = silver_table(spark, daily("a", D(2020, 1, 1), small) + daily(
        "b", D(2020, 1, 1), [float("nan"), 1.0, 2.0]))
    by_rows = df.withColumns(gold.rolling("rows"))
    by_days = df.withColumns(gold.rolling("days"))
    name = "tmin_c_roll30_mean"
    assert column(by_rows, name)[:40] == pytest.approx(column(by_days, name)[:40], rel=1e-12)
    assert column(by_rows, name)[9] == pytest.approx(5.5e-7, rel=1e-9)


def test_one_station_with_a_third_of_all_rows(spark):
    """Uneven stations and a crowded cell: sums must still hold over the whole table."""
    rows = daily("big", D(1950, 1, 1), [float(i % 9 - 4) for i in range(3000)], lat=40.5, lon=-90.5)
    for s in range(60):
        rows += daily(f"s{s:02d}", D(1958, 1, 1) + timedelta(days=s), [float(s % 5)] * 100,
                      lat=40.1, lon=-90.1)
    df = silver_table(spark, rows)
    out = gold.to_gold(df)
    assert out.count() == len(rows)
    expected = {}
    for row in rows:
        expected.setdefault(row[1], []).append(row[6])
    for r in out.select("date", "region_tmin_mean", "region_n_stations").distinct().collect():
        known = expected[r.date]
        assert r.region_n_stations == len(known)
        assert r.region_tmin_mean == pytest.approx(sum(known) / len(known))


def test_running_totals_equal_the_sliding_frame(spark):
    """Long histories, gaps of NULL longer than the frame, and large leading values."""
    values = [None if 100 <= i < 150 or i % 11 == 0 else (i * 37 % 401 - 200) / 10.0 for i in range(400)]
    values[0] = 1234567.8
    df = silver_table(spark, daily("a", D(2018, 1, 1), values) + daily("b", D(2019, 1, 1), values[:5]))
    wanted = gold.rolling()
    direct = {
        "tmin_c_roll30_mean": F.avg("tmin_c").over(gold.trailing(30)),
        "prcp_mm_roll30_sum": F.sum("prcp_mm").over(gold.trailing(30)),
        "frost_days_roll30": F.sum(F.col("is_frost_day").cast("int")).over(gold.trailing(30)),
    }
    assert dict(df.withColumns(wanted).dtypes)["frost_days_roll30"] == "bigint"
    for name, column_ in direct.items():
        ours = column(df.withColumn(name, wanted[name]), name)
        plain = column(df.withColumn(name, column_), name)
        assert [v is None for v in ours] == [v is None for v in plain]
        assert [v for v in ours if v is not None] == pytest.approx(
            [v for v in plain if v is not None])
