"""Distinct counts and quantiles from small sketches that are kept per partition and merged.

A layer's sketches are one row for each partition.  Any set of partitions is answered by merging their
rows, and a partition that changes is sketched again on its own; nothing else is scanned.

Distinct counts (HyperLogLog, 2 ** ``LG_K`` registers) have a standard error below 1 %.  Quantiles (KLL of
size ``K``) are values whose rank is off by less than ``RANK_ERROR`` with a confidence of 99 %.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimeframe.sources.layers import read_layer, write_years

LG_K = 14
K = 800
RANK_ERROR = 0.01
MEASURES = ("tmin_c", "tmax_c", "prcp_mm")
BY = ("year",)


def sketched(days: DataFrame, by: Sequence[str] = BY, measures: Iterable[str] = MEASURES) -> DataFrame:
    """One row a group: n, a sketch of its stations, and a sketch of each measure (NaN and NULL left out)."""

    def quantiles(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.kll_sketch_agg_double(F.when(~F.isnan(value), value), K).alias(f"{name}_sketch")

    return days.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("id", LG_K).alias("stations_sketch"),
        *[quantiles(m) for m in measures])


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of larger groups, from those of their parts."""
    measures = [c for c in sketches.columns if c.endswith("_sketch") and c != "stations_sketch"]
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.hll_union_agg("stations_sketch").alias("stations_sketch"),
        *[F.kll_merge_agg_double(m, K).alias(m) for m in measures])


def estimates(sketches: DataFrame, shares: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """n, n_stations and, per measure, n known values and an array of quantiles (NULL without any)."""
    fixed = [c for c in sketches.columns if not c.endswith("_sketch") and c != "n"]
    out = [*fixed, "n", F.coalesce(F.hll_sketch_estimate("stations_sketch"), F.lit(0)).alias("n_stations")]
    for column in sketches.columns:
        if column.endswith("_sketch") and column != "stations_sketch":
            known = F.coalesce(F.kll_sketch_get_n_double(column), F.lit(0))
            at = F.array(*[F.lit(float(x)) for x in shares])
            name = column.removesuffix("_sketch")
            out += [
                known.alias(f"{name}_n"),
                F.when(known > 0, F.kll_sketch_get_quantile_double(column, at)).alias(f"{name}_quantiles"),
            ]
    return sketches.select(*out)


def write_sketches(days: DataFrame, path: str, by: Sequence[str] = BY) -> None:
    """Replace the sketches of the groups in ``days``; those of other groups stay as they are."""
    write_years(sketched(days, by), path, by=by)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return read_layer(spark, path)
