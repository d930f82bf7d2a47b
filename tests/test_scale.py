"""Steps that must not grow faster than the tables: shared inputs, landed files and medians."""

import random
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from rimeframe import storage
from rimeframe.catalog import QUERIES, adapters, source_queries
from rimeframe.operators import medians as md


def items(spark, folder, suppliers=12, days=400):
    """Tables of a few suppliers, enough for readings of two years."""
    rng = random.Random(5)
    rows = [
        (k, float(rng.randint(1, 50)), rng.choice([0.01, 0.05]), rng.choice([0.02, 0.08]),
         date(1999, 1, 1) + timedelta(days=d))
        for k in range(suppliers) for d in range(days) if rng.random() < 0.6
    ]
    spark.createDataFrame(
        rows, "l_suppkey bigint, l_quantity double, l_discount double, l_tax double, l_shipdate date"
    ).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(
        [(k, f"s{k}", k % 5, -1.0 if k % 6 == 5 else 1.0) for k in range(suppliers)],
        "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    ).write.parquet(f"{folder}/supplier.parquet")
    return folder


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return items(spark, str(tmp_path_factory.mktemp("items")))


def plan(df):
    return df._jdf.queryExecution().toString()


def test_years_are_cut_into_slices(spark, folder):
    raw = adapters.raw_readings(spark, folder)

    def sizes(df):
        rows = df.select("id", "date_raw", F.spark_partition_id().alias("p")).collect()
        assert len(rows) == raw.count()
        by_part = {}
        for r in rows:
            by_part.setdefault(r.p, []).append(r.date_raw[:4])
        return by_part

    whole = sizes(source_queries.by_year(raw, folder, 8))
    cut = sizes(source_queries.by_year(raw, folder, 8, per_slice=500))
    assert max(map(len, cut.values())) < max(map(len, whole.values())) / 3
    assert all(len(set(years)) == 1 for years in cut.values())


def test_undated_lines_are_landed_too(spark, folder):
    raw = adapters.raw_readings(spark, folder).limit(5).withColumn("date_raw", F.lit(None).cast("string"))
    for per_slice in (500, 10**9):
        assert source_queries.by_year(raw, folder, 4, per_slice).count() == 5


def test_readings_run_in_compiled_code(spark, folder):
    readings = adapters.readings(spark, folder)
    assert "lambdafunction" not in plan(readings)
    assert readings.filter("element is null").count() == 0


def test_days_of_neighbours_are_derived_once(spark, folder):
    assert "l_suppkey" not in plan(QUERIES["j4_nearest_day_means"](spark, folder))


def test_medians_need_no_sketch(spark, monkeypatch):
    monkeypatch.setattr(F, "percentile_approx", None)
    inf = float("inf")
    columns = {
        "ends": [-inf, -inf, 5e-324, inf, inf], "zeros": [-0.0, 0.0, -0.0, None, 1.0],
        "low": [-1.5, -2.5, -1e300, None, None], "whole": [3.0, 1.0, 2.0, 4.0, None],
    }
    table = spark.createDataFrame(
        list(zip(*columns.values(), strict=True)), ", ".join(f"{c} DOUBLE" for c in columns))
    table = table.withColumn("whole", F.col("whole").cast("bigint")).repartition(3)
    found = {r.feature: (r.n, r.median) for r in md.exact_medians(table, columns).collect()}
    assert found == {"ends": (5, 5e-324), "zeros": (4, 0.0), "low": (3, -2.5), "whole": (4, 2.0)}
    assert str(found["zeros"][1]) == "0.0"


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in disk.getAllFiles().mkString("\n").splitlines() if "/shuffle_" in name}


def test_staged_tables_leave_no_shuffle_files(spark):
    groups = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before, setting = shuffle_files(spark), spark.conf.get(storage.CLEANUP)
    with storage.staging(spark) as put:
        with ThreadPoolExecutor(3) as threads:
            write = inheritable_thread_target(spark)(lambda name: storage.stage(groups, name))
            staged = [put(groups, "a"), *threads.map(write, ["b", "c", "d"])]
        ends = time.monotonic() + 10
        while shuffle_files(spark) - before and time.monotonic() < ends:
            time.sleep(0.1)
        assert not shuffle_files(spark) - before
        assert spark.conf.get(storage.CLEANUP) == setting
        assert [t.count() for t in staged] == [7] * 4
    assert groups.agg(F.sum("count")).first()[0] == 1000
