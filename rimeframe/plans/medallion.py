"""Raw files to bronze, silver and gold tables on disk."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from rimeframe import fixed_values as fv
from rimeframe.operators import bronze, gold, silver
from rimeframe.sources import fixed_width, layers, readings
from rimeframe.streaming.ingest import OWNED
from rimeframe.streaming.slices import rebuild_gold_years


def build_dimensions(spark: SparkSession, files: dict[str, str], target: str) -> dict[str, int]:
    """Parse the metadata files (stations, countries, states, inventory) into ``target``.

    ``files`` maps those names to paths.  Code and station tables become one file each; the
    inventory is written as it is, since it grows with stations times elements.
    """
    parsers = {
        "stations": fixed_width.read_stations,
        "countries": fixed_width.read_countries,
        "states": fixed_width.read_states,
        "inventory": fixed_width.read_inventory,
    }
    counts = {}
    for name, path in files.items():
        parsed = parsers[name](spark, path)
        if name == "inventory":
            parsed.write.mode("overwrite").parquet(f"{target}/{name}")
        else:
            layers.write_dimension(parsed, f"{target}/{name}")
        counts[name] = layers.read_layer(spark, f"{target}/{name}").count()
    return counts


def build_bronze(
    spark: SparkSession,
    folder: str,
    target: str,
    first_year: int,
    last_year: int,
    elements: Iterable[str] | None = None,
    station_ids: DataFrame | None = None,
) -> int:
    """Ingest the year files of a range in one job.

    Years come from the readings' dates, so a file may hold days of a neighbouring year.  Every
    file owns its ``year=…/source=…`` partitions and replaces only those.
    """
    paths = readings.resolve_year_files(spark, folder, first_year, last_year)
    raw = readings.with_origin(readings.read_readings(spark, paths))
    layers.write_years(bronze.to_bronze(raw, elements, station_ids), target, by=OWNED)
    return _rows(spark, target, first_year, last_year)


def build_silver(
    spark: SparkSession,
    bronze_path: str,
    stations_path: str,
    target: str,
    first_year: int | None = None,
    last_year: int | None = None,
    order_by: str | None = None,
    latest: bool = False,
) -> int:
    """Silver for all years or a range.  Station-days never cross a year, so no halo is needed."""
    source = bronze.only_years(layers.read_layer(spark, bronze_path), first_year, last_year)
    stations = layers.read_layer(spark, stations_path)
    days = silver.to_silver(source, stations, order_by, latest)
    layers.write_years(days, target, sort_by=("id", "date"))
    return _rows(spark, target, first_year, last_year)


def build_gold(
    spark: SparkSession,
    silver_path: str,
    target: str,
    first_year: int | None = None,
    last_year: int | None = None,
    climate_path: str | None = None,
    min_days: int = fv.MIN_STATION_DAYS,
) -> int:
    """Gold for all years, or for a range with the rows around it that its windows need."""
    days = layers.read_layer(spark, silver_path)
    index = readings.read_climate_index(spark, climate_path) if climate_path else None
    if first_year is None and last_year is None:
        built = gold.to_gold(days, index, min_days)
    else:
        low = -9999 if first_year is None else first_year
        high = 9999 if last_year is None else last_year
        built = rebuild_gold_years(days, low, high, index, min_days)
    layers.write_years(built, target, sort_by=("id", "date"))
    return _rows(spark, target, first_year, last_year)


def _rows(spark: SparkSession, target: str, first: int | None, last: int | None) -> int:
    """Rows now stored for the years, counted from file footers."""
    return bronze.only_years(layers.read_layer(spark, target), first, last).count()
