"""Raw daily readings: one headerless CSV (plain or gzip) per year."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv

CORRUPT = "corrupt_record"
LOAD_ORDER = "load_order"


def year_files(spark: SparkSession, folder: str, first_year: int, last_year: int) -> DataFrame:
    """One row per requested year: the path to read, or NULL when nothing has landed.

    A year lands as ``YYYY.csv`` or ``YYYY.csv.gz``, a single file or a folder of parts.  The
    plain form wins because only that one is splittable.  The listing goes through the file
    source without reading contents, so any Hadoop file system works.
    """
    landed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv*")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.regexp_extract("path", r"^(.*/\d{4}\.csv(\.gz)?)(/[^/]*)?$", 1).alias("path"))
        .filter(F.col("path") != "")
        .groupBy(F.regexp_extract("path", r"(\d{4})\.csv(\.gz)?$", 1).cast("int").alias("year"))
        .agg(F.min_by("path", F.length("path")).alias("path"))
    )
    wanted = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    return wanted.join(landed, "year", "left")


def resolve_year_files(
    spark: SparkSession, folder: str, first_year: int, last_year: int
) -> list[str]:
    """Paths for the requested years.  Missing years warn; no file at all is an error."""
    listing = year_files(spark, folder, first_year, last_year).orderBy("year").collect()
    missing = [row.year for row in listing if row.path is None]
    if missing:
        warnings.warn(f"no readings file for {missing}", stacklevel=2)
    found = [row.path for row in listing if row.path is not None]
    if not found:
        raise FileNotFoundError(f"no yearly readings file below {folder}")
    return found


def read_readings(
    spark: SparkSession, paths: str | list[str], keep_rejects: bool = False
) -> DataFrame:
    """Raw readings with the declared schema.

    Malformed fields become NULL instead of failing the job; ``keep_rejects`` adds the original
    text of such lines so that they can be counted or inspected.
    """
    schema = fv.RAW_READINGS_SCHEMA + (f", {CORRUPT} STRING" if keep_rejects else "")
    reader = spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE")
    if keep_rejects:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(paths)


def source_name() -> Column:
    """One file by its name and a hash of its whole path."""
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    return F.concat_ws("-", name, F.lower(F.hex(F.xxhash64(path))))


def with_origin(readings: DataFrame, also: dict[str, Column] | None = None) -> DataFrame:
    """Adds ``source``, which names one file by its whole path, and ``load_order``.

    ``load_order`` grows with the landing time; its low bits order files of one millisecond and
    the lines of one file by content.  Readings that tie are ordered by value in the silver layer.
    ``also`` adds other columns from the file's metadata.
    """
    path = F.col("_metadata.file_path")
    landed = F.unix_millis(F.col("_metadata.file_modification_time"))
    line = F.xxhash64("id", "date_raw", "element", "value", "q_flag", "obs_time")
    return readings.select(
        "*",
        source_name().alias("source"),
        (
            landed * F.lit(1 << 21)
            + F.pmod(F.xxhash64(path), F.lit(1 << 8)) * F.lit(1 << 13)
            + F.pmod(line, F.lit(1 << 13))
        ).alias(LOAD_ORDER),
        *[column.alias(name) for name, column in (also or {}).items()],
    )


def stream_readings(spark: SparkSession, folder: str, files_per_batch: int) -> DataFrame:
    """The same readings as a file stream, with the origin of each line."""
    return with_origin(
        spark.readStream.schema(fv.RAW_READINGS_SCHEMA)
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", "*.csv*")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def read_delimited(
    spark: SparkSession, path: str, schema: str | None = None, separator: str = ","
) -> DataFrame:
    """CSV with a header row; without a schema the types are inferred in an extra pass."""
    reader = spark.read.option("header", True).option("sep", separator)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_climate_index(spark: SparkSession, path: str) -> DataFrame | None:
    """Monthly anomaly table (year, month, oni_anom), or None when the file is absent."""
    try:
        return spark.read.schema("year INT, month INT, oni_anom DOUBLE").option(
            "header", True
        ).csv(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no climate index at {path}; going on without it", stacklevel=2)
        return None
