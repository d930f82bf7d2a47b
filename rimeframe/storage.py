"""The shared folder used for staged tables and stream checkpoints."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}

#: Spark removes the shuffle files of a query as soon as it ends, instead of when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITES = {"lock": threading.Lock(), "running": 0, "before": None}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may do without the setting; it gets one temporary folder per
    application.  On a cluster a machine-local folder would be invisible to other executors,
    so a missing setting is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="rimeframe-")
    return _LOCAL[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that end meanwhile leave no shuffle files; several threads may be inside at once."""
    with _WRITES["lock"]:
        if not _WRITES["running"]:
            _WRITES["before"] = spark.conf.get(CLEANUP)
            spark.conf.set(CLEANUP, "true")
        _WRITES["running"] += 1
    try:
        yield
    finally:
        with _WRITES["lock"]:
            _WRITES["running"] -= 1
            if not _WRITES["running"]:
                spark.conf.set(CLEANUP, _WRITES["before"])


def _written(df: DataFrame, path: str) -> DataFrame:
    """``df`` read back from ``path``.  What was shuffled for it is not needed again and goes at once, before
    the readers of the table fill the disks with rows of their own."""
    spark = df.sparkSession
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``stage`` for the length of a job: its tables are removed at the end, also after an error."""
    paths = []

    def put(df: DataFrame, name: str) -> DataFrame:
        paths.append(fresh_path(spark, name))
        return _written(df, paths[-1])

    try:
        yield put
    finally:
        for path in paths:
            discard(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Unlike a cache, a written table survives lost executors and cuts the lineage, and later
    readers still get column pruning and filter pushdown.
    """
    return _written(df, fresh_path(df.sparkSession, name))
