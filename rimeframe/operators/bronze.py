"""Typing and filtering raw readings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.functions.space import in_box


def type_dates(raw: DataFrame) -> DataFrame:
    """Real dates with year and month; text that is no date gives NULL, never an error."""
    date = F.try_to_date("date_raw", fv.RAW_DATE_FORMAT)
    return raw.withColumns(
        {"date": date, "year": F.year(date), "month": F.month(date)}
    ).drop("date_raw")


def drop_undated(readings: DataFrame) -> DataFrame:
    return readings.filter(F.col("date").isNotNull())


def passed_quality(readings: DataFrame) -> DataFrame:
    """Readings without a quality flag (NULL or empty)."""
    return readings.filter(F.coalesce("q_flag", F.lit("")) == "")


def only_elements(readings: DataFrame, elements: Iterable[str] = tuple(fv.ELEMENTS)) -> DataFrame:
    return readings.filter(F.col("element").isin(*elements))


def only_years(df: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows of a year range; either bound may be open."""
    if first is not None:
        df = df.filter(F.col("year") >= first)
    if last is not None:
        df = df.filter(F.col("year") <= last)
    return df


def stations_in_box(stations: DataFrame, box: dict) -> DataFrame:
    """Ids of the stations inside a box (and country, when the box names one)."""
    inside = in_box(F.col("latitude"), F.col("longitude"), box, F.col("country_code"))
    return stations.filter(inside).select("id")


def only_stations(readings: DataFrame, station_ids: DataFrame) -> DataFrame:
    """Keep the readings of listed stations.

    A semi-join cannot multiply rows, even if the list repeats an id.  There is no broadcast
    hint: Spark broadcasts the list when its size is below the threshold and otherwise shuffles
    with skew splitting.
    """
    return readings.join(station_ids.select("id"), "id", "left_semi")


def to_bronze(
    raw: DataFrame,
    elements: Iterable[str] | None = None,
    station_ids: DataFrame | None = None,
) -> DataFrame:
    """Raw readings to the bronze layer: typed, quality-checked and optionally restricted."""
    bronze = passed_quality(drop_undated(type_dates(raw)))
    if elements:
        bronze = only_elements(bronze, elements)
    if station_ids is not None:
        bronze = only_stations(bronze, station_ids)
    return bronze
