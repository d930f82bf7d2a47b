"""Fixed-width metadata files, described by a layout instead of code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv

Layout = Iterable[tuple[str, int, int, str]]


def parse_fixed_width(lines: DataFrame, layout: Layout, line: str = "value") -> DataFrame:
    """Cut, trim and type every field; blank or malformed fields become NULL.

    A field is its name, first and last character (from 1) and type.
    """
    fields = []
    for name, first, last, kind in layout:
        text = F.trim(F.substring(line, first, last - first + 1))
        fields.append(F.nullif(text, F.lit("")).try_cast(kind).alias(name))
    return lines.select(*fields)


def read_fixed_width(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    return parse_fixed_width(spark.read.text(path), layout)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Stations, with the country taken from the first two characters of the id."""
    stations = read_fixed_width(spark, path, fv.STATION_LAYOUT)
    return stations.withColumn("country_code", F.substring("id", 1, 2))


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    return read_fixed_width(spark, path, fv.COUNTRY_LAYOUT)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return read_fixed_width(spark, path, fv.STATE_LAYOUT)


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return read_fixed_width(spark, path, fv.INVENTORY_LAYOUT)
