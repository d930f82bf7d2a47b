"""Station-day data derived from the sales tables.

A supplier is a station, a shipping day is an observation day, and quantities, taxes and
discounts play the part of the sensor readings.  Integer arithmetic only, so every engine
derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimeframe.operators import bronze, gold, silver

TEST_YEAR = 2001


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """One station per supplier; those with a negative balance have no known position."""
    key = F.col("s_suppkey")
    placed = F.col("s_acctbal") >= 0
    latitude = F.lit(37.0) + (key % 4) * F.lit(1.0) + (key % 7) * F.lit(0.1)
    longitude = F.lit(-104.0) + (F.floor(key / 4) % 6) * F.lit(1.0) + (key % 9) * F.lit(0.1)
    return table(spark, folder, "supplier").select(
        F.concat(F.lit("S"), F.lpad(key.cast("string"), 6, "0")).alias("id"),
        F.col("s_name").alias("name"),
        F.when(placed, latitude).alias("latitude"),
        F.when(placed, longitude).alias("longitude"),
        ((key * 37) % 1500).cast("double").alias("elevation_m"),
        F.col("s_nationkey").cast("string").alias("state"),
        F.lit("US").alias("country_code"),
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Long readings with gaps, flags, impossible values and contradictions."""
    hundredths = {c: F.sum(F.round(F.col(c) * 100).cast("bigint")) for c in ("l_tax", "l_discount")}
    day = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").alias("k"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.min("l_quantity").cast("int").alias("lo"),
            F.max("l_quantity").cast("int").alias("hi"),
            hundredths["l_tax"].cast("int").alias("tx"),
            hundredths["l_discount"].cast("int").alias("dc"),
            F.count(F.lit(1)).cast("int").alias("n"),
        )
        .withColumns(
            {
                "season": F.lit(40) * (F.lit(6) - F.abs(F.month("date") - 7)),
                "h": F.col("k") * 31 + F.year("date") * 372 + F.month("date") * 31
                + F.dayofmonth("date"),
            }
        )
    )
    h, season = F.col("h"), F.col("season")

    def reading(element: str, value, flag=None):
        return F.struct(
            F.lit(element).alias("element"),
            value.cast("int").alias("value"),
            (F.lit(None) if flag is None else flag).cast("string").alias("q_flag"),
        )

    tmax = F.when(h % 211 == 0, 9999).otherwise(F.col("hi") * 10 + season - 250)
    tmin = F.when(h % 101 == 0, F.col("hi") * 10 + season).otherwise(
        F.col("lo") * 10 + season - 350
    )
    rain = F.when(h % 401 == 0, -5).when(h % 5 < 2, 0).otherwise(F.col("tx") * 10)
    taken = F.array(
        reading("TMAX", tmax, F.lit("")),
        reading("TMIN", tmin, F.when(h % 97 == 0, "X").otherwise("")),
        F.when(h % 7 != 0, reading("PRCP", rain)),
        F.when(season < 80, reading("SNOW", F.col("dc"))),
        F.when(season < 80, reading("SNWD", F.col("n"))),
    )
    # Readings not taken come out as nulls; a filter is compiled, compacting each array is not.
    return day.select(
        F.concat(F.lit("S"), F.lpad(F.col("k").cast("string"), 6, "0")).alias("id"),
        "date",
        h.cast("bigint").alias("order_key"),
        F.inline(taken),
    ).filter(F.col("element").isNotNull())


def user_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings from events: several per (user, day, element), so the choice matters."""
    kind = F.col("event_type")
    element = (
        F.when(kind == "click", "TMAX")
        .when(kind == "view", "TMIN")
        .when(kind == "purchase", "PRCP")
        .when(kind == "signup", "SNOW")
        .otherwise("SNWD")
    )
    value = F.when(
        kind.isin("click", "view"), F.floor(F.col("value") * 4).cast("int") - 100
    ).otherwise(F.floor(F.col("value") * 10).cast("int"))
    return table(spark, folder, "events").select(
        F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("id"),
        F.col("ts").cast("date").alias("date"),
        element.alias("element"),
        value.alias("value"),
        F.when(F.col("event_id") % 50 == 0, "X").otherwise("").alias("q_flag"),
        F.col("event_id").alias("order_key"),
    )


def raw_readings(spark: SparkSession, folder: str) -> DataFrame:
    """The readings as untyped text, in the column order of the raw files."""
    none = F.lit(None).cast("string")
    return readings(spark, folder).select(
        "id",
        F.date_format("date", "yyyyMMdd").alias("date_raw"),
        "element",
        F.col("value").cast("string").alias("value"),
        none.alias("m_flag"),
        F.nullif("q_flag", F.lit("")).alias("q_flag"),
        F.lit("W").alias("s_flag"),
        none.alias("obs_time"),
    )


def bronze_readings(spark: SparkSession, folder: str) -> DataFrame:
    kept = bronze.passed_quality(readings(spark, folder))
    return kept.withColumns({"year": F.year("date"), "month": F.month("date")})


def silver_days(spark: SparkSession, folder: str) -> DataFrame:
    return silver.to_silver(bronze_readings(spark, folder), stations(spark, folder))


def gold_days(spark: SparkSession, folder: str) -> DataFrame:
    return gold.to_gold(silver_days(spark, folder))


def climate_index(spark: SparkSession, folder: str) -> DataFrame:
    """A monthly anomaly from the number of orders."""
    date = F.col("o_orderdate").cast("date")
    return (
        table(spark, folder, "orders")
        .groupBy(F.year(date).alias("year"), F.month(date).alias("month"))
        .agg(((F.count(F.lit(1)) % 41 - 20) / F.lit(10.0)).alias("oni_anom"))
    )
