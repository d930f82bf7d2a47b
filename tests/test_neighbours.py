import math
import random

import pytest
from helpers import daily, rows_of, silver_table

from rimeframe.functions.space import EARTH_RADIUS_KM
from rimeframe.operators import neighbours as nb


def km(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return round(2 * EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h))), 6)


def brute(stations, k):
    out = set()
    for i, a in stations.items():
        near = sorted((km(a, b), j) for j, b in stations.items() if j != i)[:k]
        out |= {(i, rank, j) for rank, (_, j) in enumerate(near, 1)}
    return out


def found(spark, rows, k, crowded=nb.CROWDED):
    table = spark.createDataFrame(rows, "id STRING, latitude DOUBLE, longitude DOUBLE").repartition(3)
    rows = nb.nearest_stations(table.selectExpr("*", "1 as n", "2 as cell"), k, crowded).collect()
    assert len(rows) == len({(r.id, r["rank"]) for r in rows})
    return {(r.id, r["rank"], r.neighbour) for r in rows}


def globe(seed=4):
    """Stations at both poles, along the date line, in a dense town, on one spot, and far apart."""
    rng = random.Random(seed)
    spots = [(90.0, 10.0), (90.0, -170.0), (-90.0, 0.0), (89.9, 170.0), (-89.99, -20.0)]
    spots += [(rng.uniform(-60, 60), rng.choice([-1, 1]) * (180 - rng.random() / 10)) for _ in range(25)]
    spots += [(12.0, 180.0), (12.0, -180.0), (-12.0, -179.999999)]
    spots += [(48.0 + rng.random() / 100, 11.0 + rng.random() / 100) for _ in range(120)]
    spots += [(10.0, 20.0)] * 30
    spots += [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(40)]
    spots += [(round(rng.uniform(40, 45)), round(rng.uniform(-100, -95))) for _ in range(40)]
    return {f"S{i:03d}": (float(a), float(b)) for i, (a, b) in enumerate(rng.sample(spots, len(spots)))}


@pytest.mark.parametrize("k, crowded", [(1, 64), (5, 64), (5, 1), (300, 2)])
def test_nearest_stations_equal_brute_force(spark, k, crowded):
    stations = globe()
    rows = [(i, *spot) for i, spot in stations.items()]
    assert found(spark, rows, k, crowded) == brute(stations, k)


def test_defined_cases(spark):
    assert found(spark, [], 3) == set()
    rows = [("A", None, 1.0), ("B", 91.0, 0.0), ("C", float("nan"), 0.0), (None, 1.0, 1.0), ("D", 1.0, 1.0)]
    assert found(spark, rows, 3) == set()
    rows += [("E", 1.0, 1.0), ("E", 2.0, 1.0)]
    assert found(spark, rows, 3) == {("D", 1, "E"), ("E", 1, "D")}
    with pytest.raises(ValueError):
        found(spark, rows, 0)


def test_day_means(spark):
    from datetime import date

    rows = daily("A", date(2020, 1, 1), [1.0, None, 3.0], lat=0.0, lon=0.0)
    rows += daily("B", date(2020, 1, 1), [5.0, 6.0], lat=0.0, lon=0.0)
    rows += daily("C", date(2020, 1, 2), [9.0], lat=1.0, lon=0.0)
    rows += daily("D", date(2020, 1, 2), [9.0])
    days = silver_table(spark, rows)
    stations = days.select("id", "latitude", "longitude").distinct()
    out = {
        (r.id, r.date.day): (r.near_mean, r.near_n, r.near_km, r.tmin_c_minus_near)
        for r in nb.with_neighbours(days, stations, 2).collect()
    }
    far = km((0, 0), (1, 0))
    w = far**-2
    assert out[("A", 1)] == (5.0, 1, 0.0, -4.0)
    mean, n, near, offset = out[("A", 2)]
    assert (n, near, offset) == (2, 0.0, None) and mean == pytest.approx((6.0 + 9.0 * w) / (1 + w))
    assert out[("A", 3)] == (None, 0, None, None)
    assert out[("D", 2)] == (None, 0, None, None)
    assert out[("C", 2)][:3] == (pytest.approx(6.0), 1, far)
    assert rows_of(nb.with_neighbours(days, stations, 2).select(*days.columns)) == rows_of(days)
