"""Headline timings at one scale, as one JSON line.

The layers are built the way a user builds them: raw CSV to bronze, silver and gold tables on
disk, then questions and models over those tables.

environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from rimeframe.catalog import adapters as data  # noqa: E402
from rimeframe.operators import analysis as an  # noqa: E402
from rimeframe.operators import bronze as br  # noqa: E402
from rimeframe.operators import evaluation as ev  # noqa: E402
from rimeframe.operators import gold as gd  # noqa: E402
from rimeframe.operators import modelling as ml  # noqa: E402
from rimeframe.operators import ranking as rk  # noqa: E402
from rimeframe.operators import silver as sv  # noqa: E402
from rimeframe.plans.training import train_frost_model  # noqa: E402
from rimeframe.session import builder  # noqa: E402
from rimeframe.sources import layers, readings  # noqa: E402
from rimeframe.storage import fresh_path  # noqa: E402
from rimeframe.streaming.slices import rebuild_gold_years  # noqa: E402


def run(df) -> None:
    """Compute every row and column, without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("bench", {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        })
        .master(f"local[{cpus}]")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = fresh_path(spark, "bench")
    raw, stations = f"{lake}/raw", f"{lake}/stations"
    data.raw_readings(spark, folder).repartition(int(cpus)).write.csv(raw)
    layers.write_dimension(data.stations(spark, folder), stations)
    station_table = layers.read_layer(spark, stations)
    table = lambda name: layers.read_layer(spark, f"{lake}/{name}")

    def held_out():
        return ml.labelled(table("gold")).filter(F.col("year") == data.TEST_YEAR)

    def train(algorithm):
        paths = f"{lake}/{algorithm}_model", f"{lake}/{algorithm}_metrics"
        train_frost_model(
            spark, table("gold"), *paths, data.TEST_YEAR, algorithm, sample_fraction=0.1)

    steps = {
        "build_bronze": lambda: layers.write_years(
            br.to_bronze(readings.read_readings(spark, raw)), f"{lake}/bronze"),
        "build_silver": lambda: layers.write_years(
            sv.to_silver(table("bronze"), station_table), f"{lake}/silver", sort_by=("id", "date")),
        "build_gold": lambda: layers.write_years(
            gd.to_gold(table("silver")), f"{lake}/gold", sort_by=("id", "date")),
        "rebuild_gold_year": lambda: run(
            rebuild_gold_years(table("silver"), data.TEST_YEAR, data.TEST_YEAR)),
        "gold_report": lambda: run(layers.layer_report(table("gold"))),
        "frost_by_month": lambda: run(an.frost_rate_by(table("silver"), "month")),
        "frost_by_day_of_year": lambda: run(an.frost_rate_by(table("silver"), "day_of_year")),
        "frost_grid": lambda: run(an.frost_grid(table("silver"))),
        "frost_by_elevation": lambda: run(an.frost_by_elevation(table("silver"))),
        "recent_rain": lambda: run(an.recent_rain_by_station(table("silver"))),
        "frost_by_rain_class": lambda: run(an.frost_by_rain_class(table("gold"))),
        "storage_priority": lambda: run(an.storage_priority(table("gold"))),
        "rule_metrics": lambda: run(ev.classification_metrics(ev.with_rule(held_out()))),
        "rule_by_threshold": lambda: run(ev.rule_by_threshold(held_out())),
        "persistence_auc": lambda: run(rk.persistence_auc(held_out())),
        "word_count": lambda: run(an.word_counts(data.table(spark, folder, "documents"))),
        "train_lr": lambda: train("lr"),
        "train_gbt": lambda: train("gbt"),
    }
    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
