"""Gold kept up to date with silver: only what depends on changed readings is built again.

The gold layer is a versioned one (``sources.versions``).  Beside its partitions each version keeps what
it was built from: a digest for each station, year and cell of silver, and one for the files of each
silver year, so that years whose files are as they were are not even read.

From the changed station-years follow the affected ones, by the reach of every feature:

* lags, trailing frames and the history of a station: its later rows, as long as fewer rows than the
  longest frame looks back lie between; the year-to-date sums stay inside the year;
* labels: the row before;
* the minimum history: all of a station that has passed the limit, either way;
* statistics of cells: where dates, minima, positions or known stations changed, all stations of the cell in
  that year;
* the climate index: all stations in its changed years.

Affected station-years are built again from the years of their stations that their windows reach into, and
from the minima of their cells.  Other rows of a touched year are copied as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.functions import space
from rimeframe.operators import gold as g
from rimeframe.sources import versions
from rimeframe.sources.layers import write_years
from rimeframe.storage import staging
from rimeframe.streaming.slices import ROWS_AFTER, ROWS_BEFORE

BY = ("year",)
DIGESTS, LISTING, CLIMATE = "digests", "listing", "climate"
DIGEST_KEY = ["id", "year", "cell_lat", "cell_lon"]


def _digest(columns: list[str]) -> Column:
    """Order-free digest of a group's rows; hashes pass over nulls, so these are hashed as flags."""
    parts = [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    return F.struct(
        F.bit_xor(F.xxhash64(*parts)).alias("bits"), F.sum(F.hash(*parts).cast("bigint")).alias("total"))


def station_year_digests(silver: DataFrame) -> DataFrame:
    """n_days and digests of each station, year and cell: of all columns, and of what cell statistics use."""
    placed = silver.withColumns({
        "cell_lat": space.cell(F.col("latitude"), fv.REGION_CELL_DEG),
        "cell_lon": space.cell(F.col("longitude"), fv.REGION_CELL_DEG),
    })
    return placed.groupBy(DIGEST_KEY).agg(
        F.count(F.lit(1)).alias("n_days"),
        _digest(sorted(silver.columns)).alias("digest"),
        _digest(["date", "tmin_c"]).alias("minima"),
    )


def year_listing(spark: SparkSession, silver_path: str) -> DataFrame:
    """year and a digest of names, times and sizes of its files; contents are not read."""
    year = F.regexp_extract("path", r"/year=(-?\d+)/", 1)
    name = F.regexp_extract("path", r"(/year=-?\d+/.*)$", 1)  # a layer may be moved as a whole
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(silver_path)
        .filter(year != "")
        .groupBy(year.cast("int").alias("year"))
        .agg(F.bit_xor(F.xxhash64(name, "modificationTime", "length")).alias("files"),
             F.sum("length").alias("bytes"))
    )


def climate_digests(index: DataFrame) -> DataFrame:
    return index.groupBy("year").agg(
        F.bit_xor(F.xxhash64("month", "oni_anom", F.col("oni_anom").isNull())).alias("index"),
        F.count(F.lit(1)).alias("months"))


def within_reach(years: DataFrame, flag: str, earlier: int, later: int) -> DataFrame:
    """The flagged years, and years of the same station with few rows between them and a flagged one.

    Of the years before a flagged one those are taken with fewer than ``earlier`` rows in between, of the
    years behind it those with fewer than ``later``.  ``years`` has one row for each id and year, with n_days.
    """
    station = Window.partitionBy("id").orderBy("year")
    past = station.rowsBetween(Window.unboundedPreceding, -1)
    coming = station.rowsBetween(1, Window.unboundedFollowing)
    to_end = F.sum("n_days").over(station.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = years.withColumn("to_end", to_end).withColumn("to_start", F.col("to_end") - F.col("n_days"))
    since = F.col("to_start") - F.max(F.when(F.col(flag), F.col("to_end"))).over(past)
    until = F.min(F.when(F.col(flag), F.col("to_start"))).over(coming) - F.col("to_end")
    reached = counted.withColumns({"since": since, "until": until}).filter(
        F.col(flag) | (F.col("since") < later) | (F.col("until") < earlier))
    return reached.select("id", "year")


def affected_station_years(
    old: DataFrame, new: DataFrame, min_days: int, climate_years: DataFrame | None = None
) -> DataFrame:
    """(id, year) of the gold rows that may differ between two states of silver, by their digests."""

    def of(side: DataFrame, is_new: bool) -> DataFrame:
        return side.select(*DIGEST_KEY, "n_days", "digest", "minima", F.lit(is_new).alias("is_new"))

    def value(name: str, is_new: bool) -> Column:
        return F.max(F.when(F.col("is_new") == is_new, F.col(name)))

    def differs(name: str) -> Column:
        return ~value(name, True).eqNullSafe(value(name, False))

    state = of(old, False).unionByName(of(new, True)).groupBy(DIGEST_KEY).agg(
        F.coalesce(value("n_days", True), F.lit(0)).alias("n_days"),
        F.coalesce(value("n_days", False), F.lit(0)).alias("n_before"),
        differs("digest").alias("changed"),
        differs("minima").alias("other_minima"),
    )
    known = [F.sum(x) >= max(min_days, 1) for x in ("n_days", "n_before")]
    stations = state.groupBy("id").agg(
        F.bool_or("changed").alias("any"), known[0].alias("known"), known[1].alias("was_known"))
    turned = F.col("known") != F.col("was_known")
    stations = stations.filter("any").select(
        "id", turned.alias("turned"), (F.col("known") | F.col("was_known")).alias("counts"))
    touched = state.join(stations, "id")
    years = touched.groupBy("id", "year").agg(
        F.sum("n_days").alias("n_days"), F.bool_or("changed").alias("changed"), F.bool_or("turned").alias("turned"))
    series = within_reach(years, "changed", ROWS_AFTER, ROWS_BEFORE)
    turned_years = years.filter("turned").select("id", "year")
    cells = touched.filter("turned or (other_minima and counts)").select(*DIGEST_KEY[1:]).distinct()
    in_cells = new.join(cells, DIGEST_KEY[1:], "left_semi").select("id", "year")
    found = series.unionByName(turned_years).unionByName(in_cells)
    if climate_years is not None:
        found = found.unionByName(new.join(climate_years, "year", "left_semi").select("id", "year"))
    return found.distinct()


def known_stations(digests: DataFrame, min_days: int) -> DataFrame:
    totals = digests.groupBy("id").agg(F.sum("n_days").alias("days"))
    return totals.filter(F.col("days") >= min_days).select("id")


def _years_of(rows: DataFrame) -> list[int]:
    """The years in a table of station-years: as many as the calendar has at most."""
    return sorted(row["year"] for row in rows.select("year").distinct().collect())


def rebuilt(
    silver: DataFrame, digests: DataFrame, targets: DataFrame, min_days: int, index: DataFrame | None, stage
) -> DataFrame:
    """Gold rows of the target station-years, read from the years and cells that they depend on."""
    days = digests.groupBy("id", "year").agg(F.sum("n_days").alias("n_days"))
    marked = days.join(targets.select("id").distinct(), "id", "left_semi").join(
        targets.withColumn("wanted", F.lit(True)), ["id", "year"], "left")
    marked = marked.withColumn("wanted", F.col("wanted").isNotNull())
    needed = stage(within_reach(marked, "wanted", ROWS_BEFORE, ROWS_AFTER), "needed")
    halo = silver.filter(F.col("year").isin(_years_of(needed))).join(needed, ["id", "year"], "left_semi")
    featured = g.with_growing_degrees(g.with_series_features(halo.select(*silver.columns)))
    cells = digests.join(targets, ["id", "year"], "left_semi").select(*DIGEST_KEY[1:]).distinct()
    minima = (
        silver.filter(F.col("year").isin(_years_of(targets)))
        .select("id", "date", "year", "latitude", "longitude", "tmin_c")
        .withColumns({
            "cell_lat": space.cell(F.col("latitude"), fv.REGION_CELL_DEG),
            "cell_lon": space.cell(F.col("longitude"), fv.REGION_CELL_DEG),
        })
        .join(cells, DIGEST_KEY[1:], "left_semi")
        .join(known_stations(digests, min_days), "id", "left_semi")
    )
    wanted = featured.join(targets, ["id", "year"], "left_semi")
    built = g.with_region(wanted, region=g.region_day_stats(minima))
    if index is not None:
        built = g.with_climate(built, index)
    return built.select(*g.gold_columns(silver.columns, index is not None))


def _current_digests(silver: DataFrame, listing: DataFrame, path: str, before: int) -> DataFrame:
    """Digests of all station-years; those of years with the same files as before are taken over."""
    spark = silver.sparkSession
    if not before:
        return station_year_digests(silver)
    changed = listing.join(versions.table(spark, path, LISTING, before), ["year", "files", "bytes"], "left_anti")
    same = listing.join(changed, "year", "left_anti")
    kept = versions.table(spark, path, DIGESTS, before).join(same, "year", "left_semi")
    read = silver.filter(F.col("year").isin(_years_of(changed)))
    return kept.unionByName(station_year_digests(read))


@dataclass
class Refresh:
    """The version that gold is at, and what was built for it (everything the first time)."""

    version: int
    years: list[int]
    station_years: int


def refresh_gold(
    spark: SparkSession,
    silver_path: str,
    target: str,
    climate_index: DataFrame | None = None,
    min_days: int = fv.MIN_STATION_DAYS,
) -> Refresh:
    """Bring the gold layer up to date with silver in one commit.

    Rows equal those of a full build.  Other settings than before make a full build.
    """
    before, load = versions.latest(spark, target), versions.fresh_load()
    silver = spark.read.parquet(silver_path)
    settings = spark.createDataFrame(
        [(min_days, climate_index is not None)], "min_days int, with_climate boolean")
    if before and settings.exceptAll(versions.table(spark, target, "settings", before)).count():
        return _commit_full(spark, silver_path, target, before, climate_index, min_days, settings)
    if not before:
        return _commit_full(spark, silver_path, target, 0, climate_index, min_days, settings)
    with staging(spark) as stage:
        listing = stage(year_listing(spark, silver_path), "listing")
        digests = stage(_current_digests(silver, listing, target, before), "digests")
        climate = stage(_climate(spark, climate_index), "climate")
        other = climate.join(versions.table(spark, target, CLIMATE, before), climate.columns, "left_anti")
        gone = versions.table(spark, target, CLIMATE, before).join(climate, climate.columns, "left_anti")
        old = versions.table(spark, target, DIGESTS, before)
        years = other.select("year").unionByName(gone.select("year")).distinct()
        affected = stage(affected_station_years(old, digests, min_days, years), "affected")
        touched = _years_of(affected)
        partitions = versions.table(spark, target, versions.PARTITIONS, before)
        tables = {DIGESTS: digests, LISTING: listing, CLIMATE: climate, "settings": settings,
                  versions.EMPTY: versions.table(spark, target, versions.EMPTY, before)}
        if touched:
            present = digests.select("id", "year").distinct()
            targets = affected.join(present, ["id", "year"], "left_semi").join(
                known_stations(digests, min_days), "id", "left_semi")
            targets = stage(targets, "targets")
            new = rebuilt(silver, digests, targets, min_days, climate_index, stage)
            old_rows = versions.read_live(spark, target, BY, before).filter(F.col("year").isin(touched))
            rows = old_rows.join(affected, ["id", "year"], "left_anti").unionByName(new)
            write_years(rows.withColumn(versions.LOAD, F.lit(load)), versions.data_path(target),
                        by=(*BY, versions.LOAD), sort_by=("id", "date"), in_place=True)
            mine = versions.filled(spark, target, BY, spark.createDataFrame([(load,)], f"{versions.LOAD} string"))
            partitions = partitions.filter(~F.col("year").isin(touched)).unionByName(mine)
        number = versions.commit(spark, target, before, {**tables, versions.PARTITIONS: partitions})
        return Refresh(number, touched, affected.count())


def _climate(spark: SparkSession, index: DataFrame | None) -> DataFrame:
    if index is None:
        return spark.createDataFrame([], "year int, index bigint, months bigint")
    return climate_digests(index)


def _commit_full(
    spark: SparkSession, silver_path: str, target: str, before: int, index: DataFrame | None, min_days: int,
    settings: DataFrame,
) -> Refresh:
    load = versions.fresh_load()
    silver = spark.read.parquet(silver_path)
    with staging(spark) as stage:
        listing = stage(year_listing(spark, silver_path), "listing")
        digests = stage(station_year_digests(silver), "digests")
        rows = g.to_gold(silver, index, min_days).withColumn(versions.LOAD, F.lit(load))
        write_years(
            rows, versions.data_path(target), by=(*BY, versions.LOAD), sort_by=("id", "date"), in_place=True)
        mine = versions.filled(spark, target, BY, spark.createDataFrame([(load,)], f"{versions.LOAD} string"))
        number = versions.commit(spark, target, before, {
            DIGESTS: digests, LISTING: listing, CLIMATE: _climate(spark, index), "settings": settings,
            versions.EMPTY: rows.limit(0), versions.PARTITIONS: mine})
        return Refresh(number, _years_of(digests), digests.select("id", "year").distinct().count())


def read_gold(spark: SparkSession, target: str) -> DataFrame:
    """The gold rows of the last version."""
    return versions.read_live(spark, target, BY)
