"""Rebuilding some years of gold without rebuilding all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.operators import gold as g
from rimeframe.operators.bronze import only_years
from rimeframe.storage import stage

ROWS_BEFORE = max(length for _, _, length in fv.ROLLING.values()) - 1
ROWS_AFTER = 1


def station_years(silver: DataFrame) -> DataFrame:
    """Rows per station and year.  Only the id is read; the year is a partition value."""
    return silver.groupBy("id", "year").agg(F.count(F.lit(1)).alias("n_days"))


def needed_years(
    counts: DataFrame,
    first: int,
    last: int,
    before: int = ROWS_BEFORE,
    after: int = ROWS_AFTER,
    min_days: int = 0,
) -> DataFrame:
    """The (id, year) pairs from which the years ``first..last`` can be built.

    Lags and frames count rows, so no fixed number of days around the slice is enough.  Of each
    station with rows in the slice these are its years in the slice, the latest earlier years that
    hold ``before`` rows together, and the next later ones that hold ``after``.  A station with a
    long gap reaches back far without making others do so.  ``min_days`` judges whole histories.
    """
    year, days = F.col("year"), F.col("n_days")
    station = Window.partitionBy("id").orderBy("year")
    whole = station.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nearer = station.rowsBetween(1, Window.unboundedFollowing)
    passed = station.rowsBetween(Window.unboundedPreceding, -1)
    inside = year.between(first, last)

    def days_where(condition, window):
        return F.coalesce(F.sum(F.when(condition, days)).over(window), F.lit(0))

    judged = counts.withColumns({
        "present": days_where(inside, whole),
        "history": F.sum(days).over(whole),
        "behind": days_where(year < first, nearer),
        "ahead": days_where(year > last, passed),
    })
    wanted = (
        inside
        | ((year < first) & (F.col("behind") < before))
        | ((year > last) & (F.col("ahead") < after))
    )
    enough = (F.col("present") > 0) & (F.col("history") >= min_days)
    return judged.filter(enough & wanted).select("id", "year")


def with_halo(
    silver: DataFrame,
    first: int,
    last: int,
    before: int = ROWS_BEFORE,
    after: int = ROWS_AFTER,
    min_days: int = 0,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The years ``first..last`` and the years around them that their windows reach into.

    ``counts`` may supply the result of ``station_years`` kept next to silver.  The pairs wanted
    are written once, so that the plans that read the halo don't count again.
    """
    known = station_years(silver) if counts is None else counts
    needed = stage(needed_years(known, first, last, before, after, min_days), "needed-years")
    return silver.join(needed, ["id", "year"], "left_semi").select(*silver.columns)


def rebuild_gold_years(
    silver: DataFrame,
    first: int,
    last: int,
    climate_index: DataFrame | None = None,
    min_days: int = fv.MIN_STATION_DAYS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Gold rows of the years ``first..last``, equal to those of a full build.

    Minimum history is judged on the whole table, not on the slice.
    """
    halo = with_halo(silver, first, last, min_days=min_days, counts=counts)
    return only_years(g.to_gold(halo, climate_index, min_days=0), first, last)
