"""Incremental ingest of landed year files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from rimeframe.operators.bronze import to_bronze
from rimeframe.sources.layers import partition_rows, write_years
from rimeframe.sources.readings import LOAD_ORDER, stream_readings

__all__ = ["LOAD_ORDER", "ingest_landed", "loaded_rows"]

OWNED = ("year", "source")


def ingest_landed(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    elements: Iterable[str] | None = None,
    station_ids: DataFrame | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Ingest every file that is not in the checkpoint yet, then stop.

    Each file, known by its whole path, owns the partitions ``year=…/source=…``.  Replaying a
    batch, or reading the same file again under a new checkpoint, replaces exactly those
    partitions, so nothing is ever doubled, no file replaces another's rows, and no batch has to
    read what earlier ones wrote.  A correction arrives as a new file; the silver layer prefers
    it by ``load_order``.  A batch takes as many files as there are cores unless told otherwise.
    """
    files = files_per_batch or spark.sparkContext.defaultParallelism
    readings = to_bronze(stream_readings(spark, landing, files), elements, station_ids)

    def load(batch: DataFrame, _: int) -> None:
        write_years(batch, bronze, by=OWNED)

    query = (
        readings.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def loaded_rows(spark: SparkSession, bronze: str) -> DataFrame:
    """Rows per year and source file, from the file footers: nothing is parsed a second time."""
    return partition_rows(spark, bronze, OWNED)

