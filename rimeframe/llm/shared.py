"""Small helpers: files in the shared folder, held-out rows, connected components."""

from __future__ import annotations

from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimeframe.storage import fresh_path, stage

__all__ = [
    "components", "fold", "folder_uri", "open_for_reading", "open_for_writing", "packed_stage",
    "stage",
]


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(F.col(key).cast("string")) % folds


def folder_uri(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, as a URI that tasks can open without Spark."""
    path = spark._jvm.org.apache.hadoop.fs.Path(fresh_path(spark, name))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    uri = system.makeQualified(path).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") else uri


def packed_stage(df: DataFrame, name: str) -> DataFrame:
    """As ``stage``, for columns that only entropy coding makes smaller."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def open_for_writing(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_output_stream(path, compression=None) as out:
        yield out


@contextmanager
def open_for_reading(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as file:
        yield file


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (long u, v).

    Alternating large-star and small-star steps; every round is a written table, so a lost
    executor costs one round at most.  A node of high degree is a hot join key, which adaptive
    execution splits; minima are combined before the shuffle.
    """
    stars = stage(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "stars",
    )
    before = None
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_least, "u")
            .filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small_least.select("u", F.col("m").alias("v")))
        )
        stars = stage(small.filter("u <> v").distinct(), "stars")
        state = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
