"""Parquet layers: partitioned writes, small tables, exports and read-back reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimeframe.functions.sampling import hash_sampled


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_years(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("year",),
    sort_by: Sequence[str] = (),
    in_place: bool = False,
) -> None:
    """Replace exactly the partitions present in ``df``.

    The rebalance hint lets AQE cut a year that holds most of the rows into several writers and
    merge small years, where a plain repartition by year would give one task per year.
    ``sort_by`` clusters each file, which makes row-group statistics useful for station lookups.

    ``in_place`` leaves out that shuffle of whole rows, for rows that an earlier one has dealt by station or
    cell: every task then writes a file for each year that it has.
    """
    rows = df if in_place else df.hint("rebalance", *by)
    if sort_by:
        rows = rows.sortWithinPartitions(*by, *sort_by)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def partition_rows(spark: SparkSession, path: str, by: Sequence[str] = ("year",)) -> DataFrame:
    """Rows per partition of a written layer; only file footers are read."""
    return read_layer(spark, path).groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def append_years(df: DataFrame, path: str, by: Sequence[str] = ("year",)) -> None:
    """Plain append.  Not idempotent: a rerun doubles its rows, so ingest uses write_years."""
    df.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)


def write_dimension(df: DataFrame, path: str) -> None:
    """One file for a small code or station table.

    The rows pass through one writer task, so this is for dimensions only.
    """
    df.repartition(1).write.mode("overwrite").parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A metrics table (a few rows) as JSON lines."""
    metrics.repartition(1).write.mode("overwrite").json(path)


def export_sample(
    df: DataFrame, path: str, fraction: float, keys: Sequence[str], seed: int = 0,
    portable: bool = False,
    files: int = 1,
    rows_per_file: int = 5_000_000,
) -> None:
    """A keyed sample written as few Parquet files for single-machine use.

    Rows are chosen where they are, in parallel; only the sample moves to its ``files`` writers,
    and a writer begins another file after ``rows_per_file`` rows.
    """
    chosen = hash_sampled([F.col(key) for key in keys], fraction, seed, portable)
    (
        df.filter(chosen)
        .repartition(files)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def layer_report(df: DataFrame) -> DataFrame:
    """Volumes of a silver or gold layer in one pass.

    Label columns are added when the layer has labels.  Rates are NULL on an empty layer.
    """
    rows = F.count(F.lit(1))
    frost = F.count_if(F.col("is_frost_day"))
    heat = F.count_if(F.col("is_heat_stress_day"))
    measures = [
        rows.alias("n_rows"),
        F.countDistinct("id").alias("n_stations"),
        frost.alias("n_frost"),
        heat.alias("n_heat"),
        (F.lit(100.0) * F.try_divide(frost, rows)).alias("frost_pct"),
        (F.lit(100.0) * F.try_divide(heat, rows)).alias("heat_pct"),
    ]
    if "next_day_is_frost" in df.columns:
        label = F.col("next_day_is_frost")
        measures += [
            F.count(label).alias("n_labelled"),
            F.avg(label.cast("double")).alias("positive_rate"),
        ]
    return df.agg(*measures)
