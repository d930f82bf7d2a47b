"""The business questions, by name, over a silver and a gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rimeframe import fixed_values as fv
from rimeframe.operators import analysis as an
from rimeframe.sources.layers import layer_report


def reports(silver: DataFrame, gold: DataFrame) -> dict[str, DataFrame]:
    """Lazy result tables: nothing runs until one of them is used."""
    return {
        "silver volumes": layer_report(silver),
        "gold volumes": layer_report(gold),
        "missing data": an.null_fractions(
            silver,
            ("tmax_c", "tmin_c", "prcp_mm", "snow_mm", "snwd_mm", "tavg_c", "elevation_m"),
        ),
        "frost by month": an.frost_rate_by(silver, "month"),
        "frost by day of year": an.frost_rate_by(silver, "day_of_year"),
        "frost by elevation": an.frost_by_elevation(silver),
        "frost grid": an.frost_grid(silver),
        "region seasons": an.climatology_by_box(silver, fv.REGION_BOXES),
        "recent rain by station": an.recent_rain_by_station(silver),
        "recent daily rain": an.recent_daily_rain(silver),
        "frost by rain class": an.frost_by_rain_class(gold),
        "storage priority": an.storage_priority(gold),
        "cells above the regional rate": an.cells_above_regional_rate(gold),
    }
