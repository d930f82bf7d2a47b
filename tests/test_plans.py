"""The physical plans are part of the contract: shuffles, pruning, no Python rows."""

import re

import pytest
from pyspark.sql import functions as F

from rimeframe.catalog import adapters
from rimeframe.operators import analysis as an
from rimeframe.operators import evaluation as ev
from rimeframe.operators import gold, silver
from rimeframe.operators import modelling as ml
from rimeframe.sources import layers
from rimeframe.streaming.slices import needed_years, rebuild_gold_years, station_years


@pytest.fixture(scope="module")
def lake(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    long = adapters.bronze_readings(spark, sf)
    days = adapters.silver_days(spark, sf)
    layers.write_years(long, f"{root}/bronze")
    layers.write_years(days, f"{root}/silver", sort_by=("id", "date"))
    layers.write_years(gold.to_gold(days), f"{root}/gold", sort_by=("id", "date"))
    layers.write_dimension(adapters.stations(spark, sf), f"{root}/stations")
    return {n: layers.read_layer(spark, f"{root}/{n}") for n in ("bronze", "silver", "gold", "stations")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, operator):
    return len(re.findall(rf"(?:^|[\s:+\-*()0-9]){operator}\b", plan(df), re.M))


def test_silver_needs_one_shuffle(lake):
    built = silver.to_silver(lake["bronze"], lake["stations"])
    assert count(built, "Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan(built)
    assert "HashAggregate" in plan(built) and "SortAggregate" not in plan(built)
    ordered = silver.widen(lake["bronze"], "order_key", latest=True)
    assert count(ordered, "Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan(ordered)


def test_station_windows_share_one_shuffle_and_one_sort(lake):
    built = gold.with_growing_degrees(
        gold.with_series_features(lake["silver"], horizons=range(1, 16), min_days=30))
    assert count(built, "Exchange hashpartitioning") == 1
    assert count(built, "Window") == 2
    assert count(built, "Sort") == 1


def test_gold_shuffles(spark, lake):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        built = gold.to_gold(lake["silver"])
        assert count(built, "Exchange hashpartitioning") == 5
        text = plan(built)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SinglePartition" not in text and "Python" not in text and "CartesianProduct" not in text


def test_gold_moves_wide_rows_twice_where_the_station_list_is_small(lake):
    """Station counts, station windows, cell statistics and the join of both."""
    assert count(gold.to_gold(lake["silver"]), "Exchange hashpartitioning") <= 4


def test_year_filter_prunes_partitions_and_columns(lake):
    monthly = an.frost_rate_by(lake["silver"].filter(F.col("year") == 2000), "month")
    text = plan(monthly)
    assert "PartitionFilters: [isnotnull(year" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"month", "is_frost_day"}


def test_element_filter_reaches_the_scan(lake):
    text = plan(silver.widen(lake["bronze"].filter(F.col("element") == "TMIN")))
    assert "EqualTo(element,TMIN)" in text


def test_station_filter_passes_the_windows(lake):
    one = gold.with_series_features(lake["silver"]).filter(F.col("id") == "S000001")
    assert "EqualTo(id,S000001)" in plan(one)


def test_halo_counts_station_years_from_ids_alone(lake):
    text = plan(needed_years(station_years(lake["silver"]), 1998, 1998))
    assert "ReadSchema: struct<id:string>" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_rebuilt_years_need_few_shuffles(lake):
    built = rebuild_gold_years(lake["silver"], 1998, 1998)
    assert count(built, "Exchange hashpartitioning") <= 8


def test_sample_export_does_not_pull_the_query_into_one_task(spark, lake, tmp_path):
    layers.export_sample(lake["gold"], str(tmp_path / "s"), 0.2, ("id", "date"), 1)
    written = layers.read_layer(spark, str(tmp_path / "s"))
    assert len(written.inputFiles()) == 1 and 0 < written.count() < lake["gold"].count() / 3


def test_recent_days_use_a_subquery_not_a_join(lake):
    text = plan(an.recent_daily_rain(lake["silver"]))
    assert "ubquery" in text and "Join" not in text


def test_no_join_in_sweep_on_raw_rows(lake):
    scored = ml.labelled(lake["gold"]).withColumn("p1", 1 / (1 + F.exp("tmin_c")))
    text = plan(ev.threshold_sweep(scored))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def test_no_query_uses_python_rows_or_cross_joins(spark, sf):
    from rimeframe.catalog import QUERIES

    for name in ("g_gold_features", "a18_cells_above_regional_rate", "e7_threshold_sweep",
                 "a20_box_climatology", "t2_rebuilt_years", "a14_recent_rain_by_station"):
        text = plan(QUERIES[name](spark, sf))
        assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text, name
