"""Exact medians of many columns in a few cheap passes, without sorting any of them.

The median is the smallest value that half of the known values do not exceed.  Doubles, read as whole numbers
of 64 bits in the same order, are counted in equal ranges; those in the range that the median lies in are
counted in finer ranges, until only one value is left.  So four passes do for any values; a task keeps as many
counts a column as there are ranges however often a value repeats, and no more than those move.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of the first pass.
ACCURACY = 1 << 16
#: Ranges of each later pass.
BOUNDS = 1 << 16
TOP = 1 << 63


def _known(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _range_counts(df: DataFrame, brackets: dict[str, tuple[int, int, int]]) -> DataFrame:
    """feature, place and times: the values of each column inside its bracket, by the range they lie in.

    A bracket is its first number, its last one and the width of its ranges.  ``least`` and ``most`` are the
    places inside a range of the smallest and largest value there.
    """
    columns = list(brackets)
    most = max((last - first) // width + 1 for first, last, width in brackets.values())

    def count(batches):
        import numpy as np
        import pyarrow as pa

        counts = np.zeros((len(columns), most), dtype=np.int64)
        low, high = np.full(counts.shape, 1 << 62, dtype=np.int64), np.zeros_like(counts)
        top = np.uint64(TOP)
        for batch in batches:
            for i, name in enumerate(columns):
                first, last, width = brackets[name]
                values = batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64)
                raw = (values[~np.isnan(values)] + 0.0).view(np.uint64)  # negative zero is zero
                offset = np.where(raw & top, ~raw, raw | top) - np.uint64(first)
                places, within = np.divmod(offset[offset <= np.uint64(last - first)], np.uint64(width))
                places, within = places.astype(np.int64), within.astype(np.int64)
                np.add.at(counts[i], places, 1)
                np.minimum.at(low[i], places, within)
                np.maximum.at(high[i], places, within)
        features, places = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([columns[i] for i in features], pa.string()), pa.array(places.astype(np.int32)),
             *[pa.array(x[features, places]) for x in (counts, low, high)]],
            ["feature", "place", "times", "least", "most"])

    counted = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).mapInArrow(
        count, "feature string, place int, times bigint, least bigint, most bigint")
    return counted.groupBy("feature", "place").agg(
        F.sum("times").alias("times"), F.min("least").alias("least"), F.max("most").alias("most"))


def _value(number: int) -> float:
    """The double with this number in the order of all doubles."""
    raw = number ^ TOP if number & TOP else ~number & (2 * TOP - 1)
    return struct.unpack("<d", struct.pack("<Q", raw))[0]


def exact_medians(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """feature, n (known values) and median; NULL for a column without known values (NaN is unknown).

    ``df`` is read up to four times, so pass a staged table.
    """
    columns = list(columns)
    upward = Window.partitionBy("feature").orderBy("place")
    every = -(-2 * TOP // ACCURACY)
    brackets = dict.fromkeys(columns, (0, 2 * TOP - 1, every))
    n, ranks, medians = {}, {}, {}
    while brackets:
        # At most as many rows a column as ranges.
        counted = _range_counts(df, brackets).withColumns({
            "upto": F.sum("times").over(upward), "n": F.sum("times").over(Window.partitionBy("feature"))})
        rank = F.floor((F.col("n") + 1) / 2)
        for name in brackets:
            if name in ranks:
                rank = F.when(F.col("feature") == name, ranks[name]).otherwise(rank)
        holds = (F.col("upto") >= rank) & (F.col("upto") - F.col("times") < rank)
        closer = {}
        for row in counted.filter(holds).collect():
            name, (first, last, width) = row["feature"], brackets[row["feature"]]
            n.setdefault(name, row["n"])
            ranks[name] = ranks.get(name, (row["n"] + 1) // 2) - (row["upto"] - row["times"])
            first += row["place"] * width
            first, last = first + row["least"], first + row["most"]
            if first == last:
                medians[name] = _value(first)
            else:
                closer[name] = (first, last, -(-(last - first + 1) // BOUNDS))
        brackets = closer
    return df.sparkSession.createDataFrame(
        [(c, n.get(c, 0), medians.get(c)) for c in columns], "feature string, n bigint, median double")


def filled_with_medians(df: DataFrame, medians: DataFrame, suffix: str = "__imp") -> DataFrame:
    """Adds each feature with its unknown values replaced by the median, from one row per feature."""
    values = {row["feature"]: row["median"] for row in medians.collect()}
    return df.withColumns({
        f"{name}{suffix}": F.coalesce(_known(name), F.lit(value).cast("double")) for name, value in values.items()
    })
