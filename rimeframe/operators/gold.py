"""Station-day features and forward labels.

All per-station windows order by (year, date).  That is the same order as by date alone, but it
lets the year-to-date sums (station, year; date) reuse the sort of the other windows, so the
whole set costs one exchange and one sort.  Their groups are bounded: silver has one row per
station and day, so even a station that reports every day for a century has about 36,500 rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.functions import climate, space



def station_series() -> WindowSpec:
    return Window.partitionBy("id").orderBy("year", "date")


def trailing(length: int, frame: str = "rows") -> WindowSpec:
    """The current row and the ``length - 1`` before it, counted in rows or in calendar days."""
    if frame == "rows":
        return station_series().rowsBetween(1 - length, Window.currentRow)
    if frame == "days":
        by_day = Window.partitionBy("id").orderBy(F.unix_date("date"))
        return by_day.rangeBetween(1 - length, Window.currentRow)
    raise ValueError(f"unknown frame: {frame}")


def lags() -> dict[str, Column]:
    """Values 1 and 7 rows back."""
    return {
        f"{column}_lag_{step}": F.lag(column, step).over(station_series())
        for column in fv.LAGGED_COLUMNS
        for step in fv.LAG_STEPS
    }


def rolling(frame: str = "rows") -> dict[str, Column]:
    """Trailing statistics.  Short histories aggregate what is there instead of giving NULL."""
    return {
        name: _trailing_statistic(how, column, length, frame)
        for name, (how, column, length) in fv.ROLLING.items()
    }


def _trailing_statistic(how: str, column: str, length: int, frame: str) -> Column:
    values = F.col(column).cast("int") if column == "is_frost_day" else F.col(column)
    summaries = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum}
    return summaries[how](values).over(trailing(length, frame))


def next_day_labels() -> dict[str, Column]:
    series = station_series()
    return {
        "next_day_is_frost": F.lead("is_frost_day").over(series),
        "next_day_tmin_c": F.lead("tmin_c").over(series),
        "next_day_tmax_c": F.lead("tmax_c").over(series),
    }


def horizon_labels(horizons: Iterable[int] = fv.HORIZONS) -> dict[str, Column]:
    """Frost k readings ahead, for any number of horizons in one window."""
    series = station_series()
    return {f"y_h{k}": F.lead("is_frost_day", k).over(series).cast("double") for k in horizons}


def station_days() -> Column:
    """Rows of the station, over the same ordered window so that it costs no extra sort."""
    whole = station_series().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.count(F.lit(1)).over(whole)


def with_series_features(
    df: DataFrame, frame: str = "rows", horizons: Iterable[int] = (), min_days: int = 0
) -> DataFrame:
    """Lags, rolling statistics and labels in one projection: one exchange, one sort, one window.

    ``min_days`` also counts the rows of each station in that window and drops short histories
    afterwards.  Whole stations go, so the other windows are the same as if they had gone before.
    """
    features = {**lags(), **rolling(frame), **next_day_labels(), **horizon_labels(horizons)}
    if min_days <= 0:
        return df.withColumns(features)
    counted = df.withColumns({**features, "station_days": station_days()})
    return counted.filter(F.col("station_days") >= min_days).drop("station_days")


def with_growing_degrees(
    df: DataFrame, bases: dict[str, float] | None = None, missing_as_zero: bool = False
) -> DataFrame:
    """Daily and year-to-date growing degree days for each crop."""
    bases = bases or fv.GDD_BASE_C
    so_far = (
        Window.partitionBy("id", "year")
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    daily = {
        f"gdd_{crop}_day": climate.growing_degrees(F.col("tavg_c"), base, missing_as_zero)
        for crop, base in bases.items()
    }
    to_date = {f"gdd_{crop}_ytd": F.sum(f"gdd_{crop}_day").over(so_far) for crop in bases}
    return df.withColumns(daily).withColumns(to_date)


def station_history(silver: DataFrame) -> DataFrame:
    """Rows per station (pre-aggregated before the shuffle)."""
    return silver.groupBy("id").agg(F.count(F.lit(1)).alias("station_days"))


def with_enough_history(
    df: DataFrame, min_days: int = fv.MIN_STATION_DAYS, history: DataFrame | None = None
) -> DataFrame:
    """Stations with at least ``min_days`` rows; 0 keeps everything.

    ``history`` supplies counts taken elsewhere (a slice must be judged by its full history).
    Without it the rows are counted in a window that shares the exchange and sort of the
    series features.
    """
    if min_days <= 0:
        return df
    if history is not None:
        known = history.filter(F.col("station_days") >= min_days)
        return df.join(known.select("id"), "id", "left_semi")
    return (
        df.withColumn("station_days", station_days())
        .filter(F.col("station_days") >= min_days)
        .drop("station_days")
    )


def region_day_stats(df: DataFrame, cell_deg: float = fv.REGION_CELL_DEG) -> DataFrame:
    """Mean, minimum and number of known minima per grid cell and day."""
    return (
        df.filter(F.col("tmin_c").isNotNull())
        .groupBy(
            space.cell(F.col("latitude"), cell_deg).alias("cell_lat"),
            space.cell(F.col("longitude"), cell_deg).alias("cell_lon"),
            "date",
        )
        .agg(
            F.avg("tmin_c").alias("region_tmin_mean"),
            F.min("tmin_c").alias("region_tmin_min"),
            F.count(F.lit(1)).alias("region_n_stations"),
        )
    )


def with_region(
    df: DataFrame,
    cell_deg: float = fv.REGION_CELL_DEG,
    region: DataFrame | None = None,
    leave_one_out: bool = False,
) -> DataFrame:
    """Cell-day statistics joined back to every station-day, and the offset from the cell mean.

    The statistics are pre-aggregated, so the join side has one row per cell and day and AQE can
    split a crowded cell.  Rows without coordinates match nothing and are kept.  The mean
    includes the station itself; ``leave_one_out`` removes it.  ``region`` may supply statistics
    computed from an equal but narrower plan.
    """
    region = region_day_stats(df, cell_deg) if region is None else region
    joined = df.withColumns(
        {
            "cell_lat": space.cell(F.col("latitude"), cell_deg),
            "cell_lon": space.cell(F.col("longitude"), cell_deg),
        }
    ).join(region, ["cell_lat", "cell_lon", "date"], "left")
    if leave_one_out:
        mean, n, own = F.col("region_tmin_mean"), F.col("region_n_stations"), F.col("tmin_c")
        others = F.when(n > 1, (mean * n - own) / (n - 1))
        joined = joined.withColumn("region_tmin_mean", F.when(own.isNull(), mean).otherwise(others))
    return joined.withColumn(
        "tmin_minus_region", F.col("tmin_c") - F.col("region_tmin_mean")
    ).drop("cell_lat", "cell_lon")


def with_climate(df: DataFrame, index: DataFrame) -> DataFrame:
    """Monthly anomaly and its phase, by (year, month); months without a value give NULL.

    The broadcast is bounded by the calendar: grouping leaves one row per valid month, which is
    twelve per year whatever the size of ``index``.  A month listed twice keeps the larger value,
    so the join never multiplies rows.
    """
    monthly = (
        index.filter(F.col("month").between(1, 12) & F.col("year").between(1, 9999))
        .groupBy("year", "month")
        .agg(F.max("oni_anom").alias("oni_anom"))
        .withColumn("enso_phase", climate.enso_phase(F.col("oni_anom")))
    )
    return df.join(F.broadcast(monthly), ["year", "month"], "left")


def to_gold(
    silver: DataFrame,
    climate_index: DataFrame | None = None,
    min_days: int = fv.MIN_STATION_DAYS,
    history: DataFrame | None = None,
    frame: str = "rows",
    cell_deg: float = fv.REGION_CELL_DEG,
    missing_as_zero: bool = False,
) -> DataFrame:
    """Silver to the gold layer: 20 silver columns and 26 features and labels.

    Labels are taken before the regional join, so the station-ordered windows share one
    exchange and only the join moves the wide rows a second time.  The regional statistics judge
    histories by a list of stations, one row each, instead of sorting all station-days again.
    """
    listed = station_history(silver) if history is None and min_days > 0 else history
    known = with_enough_history(silver, min_days, listed)
    if history is None:
        series = with_series_features(silver, frame, min_days=min_days)
    else:
        series = with_series_features(known, frame)
    featured = with_growing_degrees(series, None, missing_as_zero)
    gold = with_region(featured, cell_deg, region_day_stats(known, cell_deg))
    if climate_index is not None:
        gold = with_climate(gold, climate_index)
    return gold.select(*gold_columns(silver.columns, climate_index is not None))


def gold_columns(silver_columns: list[str], with_index: bool) -> list[str]:
    """Silver columns first, then features in a fixed order, labels last."""
    gdd = [f"gdd_{crop}_{part}" for crop in fv.GDD_BASE_C for part in ("day", "ytd")]
    region = ["region_tmin_mean", "region_tmin_min", "region_n_stations", "tmin_minus_region"]
    index = ["oni_anom", "enso_phase"] if with_index else []
    labels = list(next_day_labels())
    return [*silver_columns, *lags(), *fv.ROLLING, *gdd, *region, *index, *labels]
