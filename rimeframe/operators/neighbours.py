"""The k nearest stations of every station, exactly, and means of what they report.

Positions are points of the unit sphere, cut into cubes whose edges halve from level to level.  So the
date line and the poles need no care, and the straight distance orders stations like the great circle.

The search of a position begins at the finest level at which its own cell has more than ``k`` stations.
Then the ``k`` nearest others are no farther than the farthest corner of that cell, at most ``sqrt(3)``
edges away, so two rings of cells around it hold them all.  Only cell counts are looked at so far.  The
farthest corners of cells with more than ``k`` stations together give a closer bound, cells beyond the
bound go, and crowded cells are replaced by the cells inside them, until what is left is small.  Stations
are compared within the cells that remain, none of which can lie beyond the k-th distance unseen.

Stations on one spot are one position with at most ``k + 1`` stations to offer, those of smallest ids, so
no pile of stations is compared with itself.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rimeframe.functions import space
from rimeframe.storage import stage

#: Levels of cells, of edges 2 ** -level: from a radius of the Earth to 24 metres.
LEVELS = tuple(range(0, 20, 2))
STEP = LEVELS[1] - LEVELS[0]
#: Bits of a place along one axis; three of them make the number of a cell.
BITS = 21
#: Stations of a cell beyond which the cells inside it are looked at.
CROWDED = 64
#: Distances are compared to a millimetre; this is more, on the unit sphere.
SLACK = 1e-9
AXES = ("x", "y", "z")
SPOT = ["latitude", "longitude"]


def placed_stations(stations: DataFrame) -> DataFrame:
    """id, latitude and longitude of the stations with a valid position; of a repeated id the smallest."""
    valid = F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    spot = F.min(F.struct("latitude", "longitude")).alias("spot")
    rows = stations.filter(F.col("id").isNotNull() & valid & ~F.isnan("latitude") & ~F.isnan("longitude"))
    return rows.groupBy("id").agg(spot).select("id", "spot.*")


def _edge(level: Column) -> Column:
    return F.pow(F.lit(2.0), -level)


def _place(coordinate: Column, level: Column) -> Column:
    """Number of the cell along one axis."""
    return F.floor((coordinate + 1) * F.pow(F.lit(2.0), level)).cast("bigint")


def _packed(places: list[Column]) -> Column:
    return reduce(lambda code, place: F.shiftleft(code, BITS).bitwiseOR(place), places)


def _unpacked(cell: Column) -> list[Column]:
    return [
        F.shiftright(cell, BITS * (2 - i)).bitwiseAND(F.lit((1 << BITS) - 1)) for i in range(3)
    ]


def _with_levels(points: DataFrame) -> DataFrame:
    """A row for each level, with the cell there."""
    levels = F.explode(F.array(*map(F.lit, LEVELS))).alias("level")
    return points.select("*", levels).withColumn(
        "cell", _packed([_place(F.col(a), F.col("level")) for a in AXES]))


def cell_counts(positions: DataFrame) -> DataFrame:
    """level, cell, the cell of the next coarser level around it, and the stations in it."""
    counts = _with_levels(positions).groupBy("level", "cell").agg(F.sum("n").alias("n"))
    around = _packed([F.shiftright(p, STEP) for p in _unpacked(F.col("cell"))])
    return counts.withColumn("around", around)


def _with_distances(rows: DataFrame) -> DataFrame:
    """``least`` and ``most``: straight distances from x, y, z to the nearest and farthest point of the cell."""
    edge = _edge(F.col("level"))
    least, most = [], []
    for axis, place in zip(AXES, _unpacked(F.col("cell")), strict=True):
        low = place * edge - 1
        below, above = low - F.col(axis), F.col(axis) - low - edge
        least.append(F.pow(F.greatest(below, above, F.lit(0.0)), 2))
        most.append(F.pow(F.greatest(F.abs(below), F.abs(above)), 2))
    total = lambda parts: F.sqrt(parts[0] + parts[1] + parts[2])
    return rows.withColumns({"least": total(least), "most": total(most)})


def _first_cells(positions: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """The cells within two rings around each position, at the finest level with more than k stations."""
    enough = cells.filter(F.col("n") > k).select("level", "cell")
    finest = (
        _with_levels(positions).join(enough, ["level", "cell"], "left_semi")
        .groupBy(SPOT).agg(F.max("level").alias("level"))
    )
    start = positions.join(finest, SPOT, "left").withColumn("level", F.coalesce("level", F.lit(LEVELS[0])))
    rings = F.explode(F.array(*[
        F.struct(*[F.lit(step).alias(a) for a, step in zip(AXES, steps, strict=True)])
        for steps in product(range(-2, 3), repeat=3)
    ])).alias("ring")
    around = start.select(*SPOT, *AXES, "level", rings).withColumns(
        {f"p{a}": _place(F.col(a), F.col("level")) + F.col(f"ring.{a}") for a in AXES})
    edge = _edge(F.col("level"))
    inside, nearest, farthest = [], [], []
    for axis in AXES:
        low = F.col(f"p{axis}") * edge - 1
        inside.append(F.col(f"p{axis}").between(F.lit(0), F.lit(2) / edge))
        nearest.append(F.pow(F.greatest(low, -low - edge, F.lit(0.0)), 2))
        farthest.append(F.pow(F.greatest(F.abs(low), F.abs(low + edge)), 2))
    # A cell off the sphere has no stations.
    on_sphere = (sum(nearest[1:], nearest[0]) <= 1 + SLACK) & (sum(farthest[1:], farthest[0]) >= 1 - SLACK)
    named = around.filter(inside[0] & inside[1] & inside[2] & on_sphere).select(
        *SPOT, *AXES, "level", _packed([F.col(f"p{a}") for a in AXES]).alias("cell"))
    return _with_distances(named.join(cells.select("level", "cell", "n"), ["level", "cell"]))


def _within_bound(frontier: DataFrame, k: int) -> DataFrame:
    """Cells that may hold one of the k nearest others: the nearest cells with more than k stations bound them.

    A position has few cells at a time, so its window is small.
    """
    nearer = Window.partitionBy(SPOT).orderBy("most", "level", "cell")
    whole = Window.partitionBy(SPOT)
    summed = frontier.withColumn("so_far", F.sum("n").over(nearer))
    enough = F.when(F.col("so_far") > k, F.col("most"))
    bound = F.coalesce(F.min(enough).over(whole), F.lit(4.0))
    return summed.withColumn("bound", bound).filter(F.col("least") <= F.col("bound") + SLACK).drop(
        "so_far", "bound")


def candidate_cells(positions: DataFrame, cells: DataFrame, k: int, crowded: int) -> DataFrame:
    """For each position the cells, of several levels, that hold its k nearest others and little more."""
    frontier = stage(_within_bound(_first_cells(positions, cells, k), k), "cells")
    while True:
        large = (F.col("n") > crowded) & (F.col("level") < LEVELS[-1])
        if frontier.filter(large).isEmpty():
            return frontier
        inner = frontier.filter(large).select(
            *SPOT, *AXES, (F.col("level") + STEP).alias("level"), F.col("cell").alias("around"))
        inner = _with_distances(inner.join(cells, ["level", "around"]).drop("around"))
        both = frontier.filter(~large).unionByName(inner)
        frontier = stage(_within_bound(both, k), "cells")


def nearest_stations(stations: DataFrame, k: int, crowded: int = CROWDED) -> DataFrame:
    """id, neighbour, rank (from 1) and km: the k nearest other stations of each station with a position.

    Distances are rounded to a millimetre, and equal ones ordered by id.  Stations without a valid
    position are not neighbours and have none; with k or fewer placed stations the lists are shorter.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    placed = stage(placed_stations(stations), "placed")
    at_spot = Window.partitionBy(SPOT).orderBy("id")
    offered = (
        placed.withColumn("place", F.row_number().over(at_spot)).filter(F.col("place") <= k + 1)
        .withColumns(space.unit_vector(F.col("latitude"), F.col("longitude")))
    )
    offered = stage(offered.select("id", *SPOT, *AXES), "offered")
    positions = stage(offered.groupBy(*SPOT, *AXES).agg(F.count(F.lit(1)).alias("n")), "positions")
    cells = stage(cell_counts(positions), "cell-counts")
    near = candidate_cells(positions, cells, k, crowded).select(*SPOT, "level", "cell")
    inside = _with_levels(offered).select(
        "level", "cell", F.col("id").alias("neighbour"), F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"))
    km = space.great_circle_km(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon"))
    compared = near.join(inside, ["level", "cell"]).select(*SPOT, "neighbour", F.round(km, 6).alias("km"))
    best = Window.partitionBy(SPOT).orderBy("km", "neighbour")
    lists = (
        compared.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k + 1)
        .groupBy(SPOT).agg(F.sort_array(F.collect_list(F.struct("km", "neighbour"))).alias("near"))
    )
    others = F.filter("near", lambda x: x["neighbour"] != F.col("id"))
    own = placed.join(lists, SPOT).select("id", F.posexplode(F.slice(others, 1, k)).alias("rank", "other"))
    return own.select("id", "other.neighbour", (F.col("rank") + 1).alias("rank"), "other.km")


def neighbour_day_means(
    days: DataFrame, nearest: DataFrame, value: str = "tmin_c", power: float = 2.0, least_km: float = 1.0
) -> DataFrame:
    """id, date, near_mean, near_n and near_km: what the neighbours report, weighted by inverse distance.

    Weights are ``km ** -power``, nearer ones than ``least_km`` counting as that near.  Neighbours without
    a value on the day are left out; ``near_km`` is the distance of the nearest one that has one.
    """
    weight = F.pow(F.greatest(F.col("km"), F.lit(least_km)), F.lit(-power))
    pairs = nearest.select(F.col("id").alias("of"), F.col("neighbour").alias("id"), "km", weight.alias("w"))
    reported = days.filter(F.col(value).isNotNull()).select("id", "date", F.col(value).alias("v"))
    return (
        reported.join(pairs, "id")
        .groupBy(F.col("of").alias("id"), "date")
        .agg(
            (F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("near_mean"),
            F.count(F.lit(1)).alias("near_n"),
            F.min("km").alias("near_km"),
        )
    )


def with_neighbours(
    days: DataFrame, stations: DataFrame, k: int = 5, value: str = "tmin_c", nearest: DataFrame | None = None
) -> DataFrame:
    """Every station-day with the mean of its k nearest stations and its own offset from it.

    ``nearest`` may supply lists found before.  Only narrow rows move to the neighbours; days without any
    reporting neighbour are kept with nulls and near_n 0.
    """
    lists = stage(nearest_stations(stations, k), "nearest") if nearest is None else nearest
    means = neighbour_day_means(days, lists, value)
    return days.join(means, ["id", "date"], "left").withColumns({
        "near_n": F.coalesce("near_n", F.lit(0).cast("bigint")),
        f"{value}_minus_near": F.col(value) - F.col("near_mean"),
    })
