"""Ingest of landed files into a layer that knows which file filled which partitions.

The file stream of ``ingest`` reads a path once.  Here the committed list of sources stands for its
checkpoint: a file is read when it is new or its time or size has changed, and the partitions it filled
before are given up in the same commit, also those of years that it no longer has.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimeframe.operators.bronze import to_bronze
from rimeframe.sources import versions
from rimeframe.sources.layers import write_years
from rimeframe.sources.readings import read_readings, source_name, with_origin
from rimeframe.storage import staging

OWNER = ("year", "source")
SOURCES = "sources"


def _load() -> Column:
    return versions.load_name(*[
        F.col(f"_metadata.{x}") for x in ("file_path", "file_modification_time", "file_size")])


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """source, load and path of the files below a folder; contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*")
        .option("recursiveFileLookup", True).load(landing)
    )
    return listed.select(source_name().alias("source"), _load().alias(versions.LOAD), "path")


def ingest_changed(
    spark: SparkSession,
    landing: str,
    target: str,
    elements: Iterable[str] | None = None,
    station_ids: DataFrame | None = None,
    drop_missing: bool = False,
) -> int:
    """Bring ``target`` up to date with a landing folder in one commit; the version it is at then.

    Files that are as they were are not read.  Those that are gone keep their rows, since landing
    folders get cleaned, unless ``drop_missing``.  After a crash before the commit the next call writes
    the same loads again.
    """
    before = versions.latest(spark, target)
    with staging(spark) as stage:
        files = stage(landed_files(spark, landing), "landed")
        if before:
            known = versions.table(spark, target, SOURCES, before)
            filled = versions.table(spark, target, versions.PARTITIONS, before)
            changed = files.join(known, ["source", versions.LOAD], "left_anti")
            kept = known.join(changed, "source", "left_anti")
            kept = kept.join(files, "source", "left_semi") if drop_missing else kept
            gone = drop_missing and kept.count() + changed.count() < known.count()
        else:
            changed, kept, gone = files, None, False
        paths = [row["path"] for row in changed.select("path").collect()]
        if not paths and not gone:
            return before
        if paths:
            raw = with_origin(read_readings(spark, paths), {versions.LOAD: _load()})
            rows = to_bronze(raw, elements, station_ids)
            write_years(rows, versions.data_path(target), by=(*OWNER, versions.LOAD))
            empty = rows.limit(0)
        else:
            empty = versions.table(spark, target, versions.EMPTY, before)
        partitions = versions.filled(spark, target, OWNER, changed)
        if kept is not None:
            partitions = filled.join(kept, ["source", versions.LOAD], "left_semi").unionByName(partitions)
            changed = kept.unionByName(changed)
        return versions.commit(spark, target, before, {
            SOURCES: changed, versions.PARTITIONS: partitions, versions.EMPTY: empty})


def read_owned(spark: SparkSession, target: str) -> DataFrame:
    """The readings of the last version."""
    return versions.read_live(spark, target, OWNER)
