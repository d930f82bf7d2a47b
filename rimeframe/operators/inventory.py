"""Readings and the station inventory: which element a station was listed for, and when.

The inventory has intervals of years for each station and element; open ends are NULL.  They may overlap, so
they are first cut into pieces without overlap, each owned by the interval that began last (ties: that ends
last, an open end being latest; then the larger remaining columns).  Then a reading has one interval at most
and the join can't multiply rows.

A piece is put into every block of ``WIDTH`` years that it touches, and a reading into the block of its year:
the join is an equality of station, element and block with the years compared inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["id", "element"]
WIDTH = 16
#: Open ends, beyond all years of readings.
FIRST, LAST = -9999, 9999


def _bounded(inventory: DataFrame) -> DataFrame:
    """Ends filled in; intervals that end before they begin hold no year and go."""
    rows = inventory.filter(F.col("id").isNotNull() & F.col("element").isNotNull()).withColumns({
        "begins": F.greatest(F.coalesce("first_year", F.lit(FIRST)), F.lit(FIRST)),
        "ends": F.least(F.coalesce("last_year", F.lit(LAST)), F.lit(LAST)),
    })
    return rows.filter("begins <= ends")


def disjoint_intervals(inventory: DataFrame) -> DataFrame:
    """id, element, from_year, to_year (inclusive), and the owner's first_year and last_year.

    Pieces run between neighbouring ends of a station's intervals, of which there are at most two a year.
    """
    rows = _bounded(inventory).select(*KEY, "begins", "ends").distinct()
    edges = rows.select(*KEY, F.explode(F.array("begins", F.col("ends") + 1)).alias("from_year")).distinct()
    along = Window.partitionBy(KEY).orderBy("from_year")
    pieces = edges.withColumn("to_year", F.lead("from_year").over(along) - 1).filter("to_year is not null")
    inside = rows.withColumnRenamed("id", "own_id").withColumnRenamed("element", "own_element")
    held = pieces.join(
        inside,
        (F.col("id") == F.col("own_id")) & (F.col("element") == F.col("own_element"))
        & (F.col("begins") <= F.col("from_year")) & (F.col("ends") >= F.col("to_year")))
    owner = F.max(F.struct("begins", "ends")).alias("owner")
    owned = held.groupBy(*KEY, "from_year", "to_year").agg(owner)

    def shown(name: str, open_end: int) -> Column:
        return F.when(F.col(f"owner.{name}") != open_end, F.col(f"owner.{name}"))

    return owned.select(
        *KEY, "from_year", "to_year", shown("begins", FIRST).alias("first_year"),
        shown("ends", LAST).alias("last_year"))


def with_listing(readings: DataFrame, inventory: DataFrame, width: int = WIDTH) -> DataFrame:
    """Every reading with ``is_listed`` and the listed_from and listed_to of its interval (NULL: open end).

    Readings without id, element or year are not listed.  Blocks of the open ends are bounded by the
    calendar; a hot station is split by adaptive execution, as it only meets its own few pieces.
    """
    block = lambda year: F.floor(year / width).cast("int")
    years = readings.agg(F.min("year").alias("low"), F.max("year").alias("high")).first()
    if years["low"] is None:
        low = high = 0
    else:
        low, high = years["low"], years["high"]
    pieces = disjoint_intervals(inventory).filter((F.col("to_year") >= low) & (F.col("from_year") <= high))
    touched = F.sequence(block(F.greatest("from_year", F.lit(low))), block(F.least("to_year", F.lit(high))))
    spread = pieces.select(
        F.col("id").alias("listed_id"), F.col("element").alias("listed_element"),
        F.explode(touched).alias("listed_block"), "from_year", "to_year",
        F.col("first_year").alias("listed_from"), F.col("last_year").alias("listed_to"))
    match = (
        (F.col("id") == F.col("listed_id")) & (F.col("element") == F.col("listed_element"))
        & (block(F.col("year")) == F.col("listed_block"))
        & F.col("year").between(F.col("from_year"), F.col("to_year"))
    )
    joined = readings.join(spread, match, "left")
    return joined.withColumn("is_listed", F.col("listed_id").isNotNull()).select(
        *readings.columns, "is_listed", "listed_from", "listed_to")


def unlisted_readings(readings: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per element the readings, and those that the inventory does not list."""
    return with_listing(readings, inventory).groupBy("element").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_listed")).alias("n_unlisted"))


def silent_listings(readings: DataFrame, inventory: DataFrame) -> DataFrame:
    """Listed station-elements without any reading inside their pieces."""
    heard = with_listing(readings.select("id", "element", "year"), inventory).filter("is_listed").select(KEY).distinct()
    return _bounded(inventory).select(KEY).distinct().join(heard, KEY, "left_anti")
