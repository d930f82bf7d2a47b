"""Long readings to one clean row per station-day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, IntegralType

from rimeframe import fixed_values as fv
from rimeframe.functions import climate
from rimeframe.operators.bronze import only_elements
from rimeframe.sources.readings import LOAD_ORDER

SILVER_COLUMNS = (
    "id", "date", "year", "month", "day_of_year",
    "tmax_c", "tmin_c", "tavg_c", "temp_range_c",
    "prcp_mm", "snow_mm", "snwd_mm",
    "is_frost_day", "is_heat_stress_day",
    "name", "latitude", "longitude", "elevation_m", "state", "country_code",
)


def widen(
    readings: DataFrame, order_by: str | None = None, latest: bool = False
) -> DataFrame:
    """One row per station-day with one column per element.

    When a station reports an element twice on a day the choice is deterministic: the first
    (or ``latest``) non-null value by ``order_by``.  Without it the latest by ``load_order`` is
    taken where ingest has left that column, so corrections count, and the smallest value
    elsewhere.  Equal orders are parted by the value, the larger being the later one, so the choice
    never depends on the order of rows.  With a whole-number order column the aggregate stays
    hash-based.

    Filtered aggregates over (id, date) need one shuffle and combine on the map side, while a
    pivot would first group by element as well and shuffle twice.  After this step (id, date)
    is unique: no station has more rows than there are days on record, which is what bounds
    the per-station windows of the gold layer.
    """

    if order_by is None and LOAD_ORDER in readings.columns:
        order_by, latest = LOAD_ORDER, True

    def chosen(element: str) -> Column:
        value = F.when(F.col("element") == element, F.col("value"))
        if order_by is None:
            return F.min(value)
        order = F.when(value.isNotNull(), _total_order(readings, order_by))
        return F.max_by(value, order) if latest else F.min_by(value, order)

    return (
        readings.groupBy("id", "date")
        .agg(*[chosen(element).alias(element) for element in fv.ELEMENTS])
        .withColumns({"year": F.year("date"), "month": F.month("date")})
    )


def _total_order(readings: DataFrame, order_by: str) -> Column:
    """The order column, then the value; as one whole number where both are."""
    value = F.col("value")
    kinds = [readings.schema[name].dataType for name in (order_by, "value")]
    if isinstance(kinds[0], IntegralType) and isinstance(kinds[1], IntegerType):
        return F.col(order_by).cast("decimal(19,0)") * F.lit(1 << 32) + (value.cast("bigint") + F.lit(1 << 31))
    return F.struct(F.col(order_by), value)


def to_si(wide: DataFrame) -> DataFrame:
    """Element columns in raw units to named columns in degrees Celsius and millimetres."""
    others = [c for c in wide.columns if c not in fv.ELEMENTS]
    scaled = [
        (F.col(element) * F.lit(scale)).alias(column)
        for element, (column, scale) in fv.ELEMENTS.items()
    ]
    return wide.select(*others, *scaled)


def clip_to_physics(wide: DataFrame) -> DataFrame:
    """NULL for temperatures outside the envelope and for negative rain or snow."""
    return wide.withColumns(
        {
            **{c: climate.plausible_temperature(F.col(c)) for c in ("tmin_c", "tmax_c")},
            **{c: climate.non_negative(F.col(c)) for c in ("prcp_mm", "snow_mm", "snwd_mm")},
        }
    )


def drop_contradictions(wide: DataFrame, also_maximum: bool = True) -> DataFrame:
    """NULL both temperatures when the minimum exceeds the maximum: neither can be trusted.

    ``also_maximum=False`` clears the minimum only, for comparison with data cleaned that way.
    """
    suspect = climate.contradicts(F.col("tmin_c"), F.col("tmax_c"))
    doubtful = ("tmin_c", "tmax_c") if also_maximum else ("tmin_c",)
    return wide.withColumns({c: F.when(~suspect, F.col(c)) for c in doubtful})


def derive(wide: DataFrame) -> DataFrame:
    """Calendar position, daily mean and range, frost and heat flags."""
    tmin, tmax = F.col("tmin_c"), F.col("tmax_c")
    return wide.withColumns(
        {
            "day_of_year": F.dayofyear("date"),
            "tavg_c": climate.midpoint(tmin, tmax),
            "temp_range_c": tmax - tmin,
            "is_frost_day": climate.is_frost(tmin),
            "is_heat_stress_day": climate.is_heat_stress(tmax),
        }
    )


def describe_stations(wide: DataFrame, stations: DataFrame) -> DataFrame:
    """Left join of station metadata, without a hint (see ``only_stations``).

    ``stations`` has one row per id.
    """
    if "elevation_m" not in stations.columns:
        stations = stations.withColumnRenamed("elevation", "elevation_m")
    details = ("name", "latitude", "longitude", "elevation_m", "state", "country_code")
    return wide.join(stations.select("id", *details), "id", "left")


def to_silver(
    readings: DataFrame,
    stations: DataFrame,
    order_by: str | None = None,
    latest: bool = False,
    also_maximum: bool = True,
) -> DataFrame:
    """Bronze readings and station metadata to the silver layer."""
    wide = to_si(widen(only_elements(readings), order_by, latest))
    clean = drop_contradictions(clip_to_physics(wide), also_maximum)
    return describe_stations(derive(clean), stations).select(*SILVER_COLUMNS)
