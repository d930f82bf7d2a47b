"""Session settings this library is written for; the cluster keeps master and memory."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.showConsoleProgress": "false",
}


def builder(app_name: str, extra: dict[str, str] | None = None) -> SparkSession.Builder:
    """A session builder with the settings above; ``extra`` adds or replaces some."""
    session = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        session = session.config(key, value)
    return session
