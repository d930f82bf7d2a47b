"""Aggregates behind the seasonal, spatial and rainfall questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.functions import climate, space


def rate(flag: str | Column) -> Column:
    """Share of true among the known values of a flag."""
    column = F.col(flag) if isinstance(flag, str) else flag
    return F.avg(column.cast("double"))


def rows() -> Column:
    return F.count(F.lit(1))


def known_frost(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_frost_day").isNotNull())


# --- quality ------------------------------------------------------------------------------

def element_counts(bronze: DataFrame) -> DataFrame:
    """Readings per element, most frequent first."""
    return bronze.groupBy("element").agg(rows().alias("n")).orderBy(F.desc("n"), "element")


def null_fractions(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row per column with its share of NULLs, from a single pass over the data."""
    shares = df.agg(*[rate(F.col(c).isNull()).alias(c) for c in columns])
    return shares.unpivot([], list(columns), "column_name", "null_fraction").orderBy(
        F.desc("null_fraction"), "column_name"
    )


def summary(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """count, mean, stddev, min and max as typed numbers, one row per column, in one pass."""
    parts = {"n": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max}
    wide = df.agg(
        *[
            F.struct(*[how(c).cast("double").alias(part) for part, how in parts.items()]).alias(c)
            for c in columns
        ]
    )
    long = wide.unpivot([], list(columns), "column_name", "stats")
    return long.select("column_name", F.col("stats.n").cast("bigint").alias("n"),
                       *[F.col(f"stats.{part}").alias(part) for part in list(parts)[1:]])



# --- seasonality and terrain --------------------------------------------------------------

def frost_rate_by(silver: DataFrame, key: str) -> DataFrame:
    """Frost share per calendar position (month, day of year) over known days."""
    return known_frost(silver).groupBy(key).agg(rate("is_frost_day").alias("frost_rate")).orderBy(key)


def frost_by_elevation(
    silver: DataFrame,
    more_than: int = 5000,
    limits: tuple[int, int] | None = fv.ELEVATION_BAND_LIMITS_M,
) -> DataFrame:
    """Frost share per elevation band with enough observations; ``limits=None`` keeps all bands."""
    band = F.col("elev_band")
    wanted = F.lit(True) if limits is None else band.between(*limits)
    return (
        known_frost(silver)
        .filter(F.col("elevation_m").isNotNull())
        .groupBy(space.elevation_band(F.col("elevation_m")).alias("elev_band"))
        .agg(rate("is_frost_day").alias("frost_rate"), rows().alias("n"))
        .filter(wanted & (F.col("n") > more_than))
        .orderBy("elev_band")
    )


def frost_grid(silver: DataFrame, degrees: int = 1, more_than: int = 200) -> DataFrame:
    """Frost share per grid cell with enough observations.

    Rows without a position form one group of their own (NULL, NULL).
    """
    return (
        known_frost(silver)
        .groupBy(
            space.cell(F.col("latitude"), degrees).alias("glat"),
            space.cell(F.col("longitude"), degrees).alias("glon"),
        )
        .agg(rate("is_frost_day").alias("frost_rate"), rows().alias("n"))
        .filter(F.col("n") > more_than)
    )


def grid_matrix(grid: DataFrame, lon_from: int, lon_to: int, degrees: int = 1) -> DataFrame:
    """Latitude rows by longitude columns, in percent, for a declared longitude range.

    ``cells_outside`` counts the cells of a row that no column shows: longitudes beyond the range,
    unknown ones, and all of them where the range does not begin on the grid.  The input is the
    aggregated grid, at most one row per cell of the globe.
    """
    edges = range(lon_from, lon_to + 1, degrees)
    shown = F.coalesce(F.col("glon").isin(*edges), F.lit(False))
    percent = F.lit(100.0) * F.col("frost_rate")
    return (
        grid.filter(F.col("glat").isNotNull())
        .groupBy("glat")
        .agg(
            *[
                F.max(F.when(F.col("glon") == edge, percent)).alias(column_for(edge))
                for edge in edges
            ],
            F.count_if(~shown).alias("cells_outside"),
        )
        .orderBy("glat")
    )


def column_for(edge: int) -> str:
    return f"lon_{'m' if edge < 0 else 'p'}{abs(edge)}"


def station_means(silver: DataFrame) -> DataFrame:
    """Mean minimum per station, with its position."""
    return (
        silver.filter(F.col("tmin_c").isNotNull() & F.col("latitude").isNotNull())
        .groupBy("id", "latitude", "longitude")
        .agg(F.avg("tmin_c").alias("mean_tmin"))
    )


def climatology_by_box(silver: DataFrame, boxes: dict[str, dict]) -> DataFrame:
    """Monthly frost share of several region boxes, scaled to the peak month of each.

    Boxes are expressions on the row, so no join is needed and boxes may overlap.  The peak is
    taken over the twelve aggregated rows of a box.
    """
    named = space.boxes_containing(F.col("latitude"), F.col("longitude"), boxes, F.col("country_code"))
    monthly = (
        known_frost(silver)
        .withColumn("series", F.explode(named))
        .groupBy("series", "month")
        .agg(rate("is_frost_day").alias("frost_rate"))
    )
    return relative_to_peak(monthly, "series", "frost_rate")


def relative_to_peak(df: DataFrame, series: str, value: str) -> DataFrame:
    """Percent of the largest value of each (small, aggregated) series."""
    peak = F.max(value).over(Window.partitionBy(series))
    return df.withColumn("pct_of_peak", F.lit(100.0) * F.try_divide(F.col(value), peak))


# --- rain ---------------------------------------------------------------------------------

def recent(silver: DataFrame, days: int = fv.RECENT_DAYS) -> DataFrame:
    """Rows of the last ``days`` days, counted back from the latest date in the data.

    The latest date is a scalar subquery: no join, no driver round trip.  The condition on
    ``year`` repeats it for partition pruning.
    """
    start = F.date_sub(silver.agg(F.max("date")).scalar(), days)
    return silver.filter((F.col("year") >= F.year(start)) & (F.col("date") >= start))


def recent_rain_by_station(silver: DataFrame, days: int = fv.RECENT_DAYS) -> DataFrame:
    """Total rain and wet days per station with a known position."""
    return (
        recent(silver, days)
        .filter(F.col("prcp_mm").isNotNull() & F.col("latitude").isNotNull())
        .groupBy("id")
        .agg(
            F.max("latitude").alias("lat"),
            F.max("longitude").alias("lon"),
            F.sum("prcp_mm").alias("total_prcp"),
            F.count_if(F.col("prcp_mm") > 0).alias("wet_days"),
        )
    )


def recent_daily_rain(silver: DataFrame, days: int = fv.RECENT_DAYS) -> DataFrame:
    return (
        recent(silver, days)
        .filter(F.col("prcp_mm").isNotNull())
        .groupBy("date")
        .agg(F.avg("prcp_mm").alias("mean_prcp"))
        .orderBy("date")
    )


def frost_by_rain_class(gold: DataFrame) -> DataFrame:
    """Next-day frost share per class of the rain of the last seven readings.

    Sums are rounded first, so that a class limit never depends on the order of addition.
    """
    rain = F.round("prcp_mm_roll7_sum", 6)
    return (
        gold.filter(F.col("next_day_is_frost").isNotNull() & rain.isNotNull())
        .groupBy(
            climate.rain_class_rank(rain).alias("class_rank"),
            climate.rain_class(rain).alias("rain_class"),
        )
        .agg(rate("next_day_is_frost").alias("frost_rate"), rows().alias("n"))
        .orderBy("class_rank")
    )


# --- storage priority ---------------------------------------------------------------------

def pre_harvest(df: DataFrame) -> DataFrame:
    return known_frost(df).filter(F.col("month").isin(*fv.PRE_HARVEST_MONTHS))


def pre_harvest_sums(gold: DataFrame, degrees: int = 1) -> DataFrame:
    """Counts per cell, before any coverage limit (rows without a position form one group)."""
    return (
        pre_harvest(gold)
        .groupBy(
            space.cell(F.col("latitude"), degrees).alias("clat"),
            space.cell(F.col("longitude"), degrees).alias("clon"),
        )
        .agg(
            F.count_if("is_frost_day").alias("n_frost"),
            F.countDistinct("id").alias("n_stations"),
            rows().alias("n_obs"),
        )
        .withColumn("frost_rate", F.col("n_frost") / F.col("n_obs"))
    )


def pre_harvest_cells(gold: DataFrame, degrees: int = 1, at_least: int = 500) -> DataFrame:
    """Risk, exposure and priority per cell with reliable coverage."""
    return (
        pre_harvest_sums(gold, degrees)
        .filter(F.col("n_obs") >= at_least)
        .withColumns(
            {
                "clat_c": space.cell_centre(F.col("clat"), degrees),
                "clon_c": space.cell_centre(F.col("clon"), degrees),
                "priority": F.col("frost_rate") * F.col("n_stations"),
            }
        )
    )


def storage_priority(gold: DataFrame, k: int = 10, at_least: int = 500) -> DataFrame:
    """The k cells where risk times exposure is highest; ties go to the southern, western cell."""
    return pre_harvest_cells(gold, at_least=at_least).orderBy(
        F.desc("priority"), "clat", "clon"
    ).limit(k)


def cells_above_regional_rate(gold: DataFrame, at_least: int = 500) -> DataFrame:
    """The regional rate and the share of well-covered cells above it (one row).

    Both come from the same aggregated cells, so gold is read once; the window spans cells, of
    which the globe has at most 64,800 at one degree.
    """
    everywhere = Window.partitionBy()
    regional = F.sum("n_frost").over(everywhere) / F.sum("n_obs").over(everywhere)
    return (
        pre_harvest_sums(gold)
        .withColumn("regional_rate", regional)
        .agg(
            F.max("regional_rate").alias("regional_rate"),
            F.avg(
                F.when(
                    F.col("n_obs") >= at_least,
                    (F.col("frost_rate") > F.col("regional_rate")).cast("double"),
                )
            ).alias("share_above"),
            F.count_if(F.col("n_obs") >= at_least).alias("n_cells"),
        )
    )


# --- inspection ---------------------------------------------------------------------------

def busiest_station(df: DataFrame) -> DataFrame:
    """The station with most rows (smallest id on a tie)."""
    return (
        df.groupBy("id").agg(rows().alias("n")).orderBy(F.desc("n"), "id").limit(1)
    )


def station_rows(
    df: DataFrame, station: str | DataFrame, order: tuple[str, ...], columns: tuple[str, ...], k: int
) -> DataFrame:
    """The first k rows of one station.

    ``station`` is an id, or a one-row table with an ``id`` that becomes a scalar subquery.  The
    condition on id also passes below windows over id, down to the scan.
    """
    wanted = station if isinstance(station, str) else station.select("id").scalar()
    return df.filter(F.col("id") == wanted).orderBy(*order).limit(k).select(*columns)


def base_rate(gold: DataFrame) -> DataFrame:
    return gold.agg(rate("next_day_is_frost").alias("base_rate"),
                    F.count("next_day_is_frost").alias("n_labelled"))


# --- text and sales examples --------------------------------------------------------------

def word_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """Words of whole texts, most frequent first; counts combine before the shuffle."""
    words = texts.select(F.explode(F.split(column, r"[ \t\r\n]+")).alias("word"))
    return (
        words.filter(F.col("word") != "")
        .groupBy("word")
        .agg(rows().alias("n"))
        .orderBy(F.desc("n"), "word")
    )
