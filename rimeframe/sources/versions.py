"""Layers whose partitions have owners: committed versions say which loads of them count.

Rows lie below ``<path>/data`` in partitions that end in ``load=…``.  A load is written once, by one
delivery of one owner, and is not changed by later ones.  A version, a folder of small tables below
``<path>/_versions``, names the partitions that count.  It is written aside and renamed into place, so
readers see all of a change or nothing of it, partitions that an owner no longer fills vanish with the
commit, and of two writers that began from one version the second fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOAD = "load"
PARTITIONS = "partitions"
#: No rows, with the columns of the version, which other loads may not have.
EMPTY = "empty"


def data_path(path: str) -> str:
    return f"{path}/data"


def fresh_load() -> str:
    return f"l{uuid.uuid4().hex}"


def load_name(*content: Column) -> Column:
    """A load named by what it was read from, so that a replay writes the same partitions again."""
    return F.concat(F.lit("l"), F.lower(F.hex(F.xxhash64(*content))))


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = _files(spark, path)
    return system.exists(folder)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    folder, system = _files(spark, f"{path}/_versions")
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def latest(spark: SparkSession, path: str) -> int:
    """The number of the last committed version; 0 before the first."""
    return max(_numbers(spark, path), default=0)


def table(spark: SparkSession, path: str, name: str, number: int | None = None) -> DataFrame:
    """A table of a committed version, the last one unless told otherwise."""
    number = latest(spark, path) if number is None else number
    if not number:
        raise FileNotFoundError(f"nothing is committed below {path}")
    return spark.read.parquet(f"{path}/_versions/{number:012d}/{name}")


def commit(spark: SparkSession, path: str, based_on: int, tables: dict[str, DataFrame]) -> int:
    """Make the tables the version after ``based_on``; fails if another writer was faster."""
    aside, final = f"{path}/_versions/.{uuid.uuid4().hex}", f"{path}/_versions/{based_on + 1:012d}"
    for name, rows in tables.items():
        rows.write.parquet(f"{aside}/{name}")
    hadoop = spark._jvm.org.apache.hadoop
    source, target = (hadoop.fs.Path(x) for x in (aside, final))
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = hadoop.fs.FileContext.getFileContext(
        source.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    if exists(spark, final):
        _delete(spark, aside)
        raise RuntimeError(f"version {based_on + 1} of {path} was committed by another writer")
    context.rename(source, target, options)
    return based_on + 1


def _delete(spark: SparkSession, path: str) -> None:
    folder, system = _files(spark, path)
    system.delete(folder, True)


def read_live(spark: SparkSession, path: str, by: Sequence[str], number: int | None = None) -> DataFrame:
    """The rows that a version counts, without the column ``load``.

    The list of partitions has no hint: below the broadcast threshold Spark also prunes folders with it.
    """
    live = table(spark, path, PARTITIONS, number).select(*by, LOAD)
    empty = table(spark, path, EMPTY, number)
    if _stored(spark, path) is None:
        return empty.drop(LOAD)
    rows = spark.read.schema(empty.schema).parquet(data_path(path)).select(*empty.columns)
    return rows.join(live, [*by, LOAD], "left_semi").drop(LOAD)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    if not exists(spark, data_path(path)):
        return None
    try:
        return spark.read.parquet(data_path(path))
    except AnalysisException as nothing:
        if nothing.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def filled(spark: SparkSession, path: str, by: Sequence[str], loads: DataFrame) -> DataFrame:
    """(by, load, n_rows): the partitions that some loads filled, from file footers."""
    schema = ", ".join(f"{x} {'int' if x == 'year' else 'string'}" for x in by)
    rows = _stored(spark, path)
    if rows is None:
        return spark.createDataFrame([], f"{schema}, {LOAD} string, n_rows bigint")
    rows = rows.join(loads.select(LOAD).distinct(), LOAD, "left_semi")
    return rows.groupBy(*by, LOAD).agg(F.count(F.lit(1)).alias("n_rows"))


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove all but the last ``keep`` versions, and the folders of loads that none of those counts.

    Only for times without a writer or a reader of older versions.  Returns the number of folders.
    """
    numbers = _numbers(spark, path)
    kept = numbers[-keep:]
    for number in set(numbers) - set(kept):
        _delete(spark, f"{path}/_versions/{number:012d}")
    if not exists(spark, data_path(path)):
        return 0
    live = [table(spark, path, PARTITIONS, n).select(LOAD) for n in kept]
    stored = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(data_path(path))
        .select(F.regexp_extract("path", r"^(.*/load=[^/]+)/[^/]*$", 1).alias("folder")).distinct()
        .withColumn(LOAD, F.regexp_extract("folder", r"load=([^/]+)$", 1))
    )
    for loads in live:
        stored = stored.join(loads.distinct(), LOAD, "left_anti")
    stale = [row["folder"] for row in stored.collect() if row["folder"]]
    for folder in stale:
        _delete(spark, folder)
    return len(stale)
