"""Where queries and their SQL texts are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Dates as text, flags as integers and doubles rounded to six places."""
    forms = {
        "date": lambda c: c.cast("string"),
        "boolean": lambda c: c.cast("int"),
        "double": lambda c: F.round(c, 6),
    }
    return df.select(
        *[forms.get(kind, lambda c: c)(F.col(name)).alias(name) for name, kind in df.dtypes]
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are checked."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = lambda spark, folder: comparable(function(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
