import random
from datetime import date, timedelta

import pytest
from helpers import silver_row, silver_table

from rimeframe.operators import inventory as inv
from rimeframe.operators import sketches as sk


def listing(rows, id, element, year):
    """The interval that began last, then the one that ends last; open ends as far out as can be."""
    if None in (id, element, year):
        return None
    held = [
        (a if a is not None else inv.FIRST, b if b is not None else inv.LAST)
        for i, e, a, b in rows if (i, e) == (id, element)
    ]
    held = [(a, b) for a, b in held if a <= year <= b]
    if not held:
        return None
    a, b = max(held)
    return (None if a == inv.FIRST else a, None if b == inv.LAST else b)


@pytest.mark.parametrize("width", [1, 7, 16, 500])
def test_listing_equals_brute_force(spark, width):
    rng = random.Random(width)
    end = lambda: rng.choice([None, *range(1900, 2020, 3)])
    rows = [(rng.choice(["A", "B", None]), rng.choice(["TMIN", "TMAX"]), end(), end()) for _ in range(25)]
    rows += [("C", "TMIN", None, None), ("C", "TMIN", 1950, 1960), ("C", "TMIN", 1950, 1960), ("D", "TMIN", 2000, 1990)]
    inventory = spark.createDataFrame(rows, "id STRING, element STRING, first_year INT, last_year INT")
    read = [(rng.choice(["A", "B", "C", "D", "E", None]), rng.choice(["TMIN", "TMAX", None]),
             rng.choice([None, *range(1895, 2025)]), i) for i in range(400)]
    readings = spark.createDataFrame(read, "id STRING, element STRING, year INT, value INT").repartition(3)
    out = inv.with_listing(readings, inventory, width).collect()
    assert len(out) == len(read)
    for r in out:
        want = listing(rows, r.id, r.element, r.year)
        assert (r.is_listed, (r.listed_from, r.listed_to)) == (want is not None, want or (None, None))
    heard = {(i, e) for i, e, y, _ in read if listing(rows, i, e, y)}
    silent = {tuple(r) for r in inv.silent_listings(readings, inventory).collect()}
    held = {(i, e) for i, e, a, b in rows if i and (a or inv.FIRST) <= (b or inv.LAST)}
    assert silent == held - heard
    plan = inv.with_listing(readings, inventory)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert inv.with_listing(readings.limit(0), inventory).count() == 0
    assert inv.with_listing(readings, inventory.limit(0)).filter("is_listed").count() == 0


def series(spark, years, stations, seed=1):
    rng = random.Random(seed)
    rows = [
        silver_row(f"S{i:05d}", date(y, 1, 1) + timedelta(days=rng.randrange(360)), rng.gauss(i % 7, 5), None, None)
        for y in years for i in rng.sample(range(stations), stations // 2)
    ]
    return silver_table(spark, rows), rows


def test_merged_sketches_keep_their_bounds(spark, tmp_path):
    path = str(tmp_path / "sketches")
    days, rows = series(spark, (2000, 2001, 2002), 8000)
    sk.write_sketches(days, path)
    assert sk.read_sketches(spark, path).count() == 3
    found = sk.estimates(sk.merged(sk.read_sketches(spark, path)), (0.1, 0.5, 0.9)).first()
    values = sorted(r[6] for r in rows)
    stations = len({r[0] for r in rows})
    assert found.n == found.tmin_c_n == len(rows)
    assert abs(found.n_stations - stations) < 0.03 * stations
    for share, value in zip((0.1, 0.5, 0.9), found.tmin_c_quantiles, strict=True):
        rank = sum(v <= value for v in values) / len(values)
        assert abs(rank - share) < sk.RANK_ERROR
    assert found.tmax_c_n == 0 and found.tmax_c_quantiles is None
    again, newer = series(spark, (2001,), 400, seed=2)
    sk.write_sketches(again, path)
    kept = [r for r in rows if r[2] != 2001] + newer
    found = sk.estimates(sk.merged(sk.read_sketches(spark, path))).first()
    assert found.n == len(kept)
    assert abs(found.n_stations - len({r[0] for r in kept})) < 0.03 * len({r[0] for r in kept})
    one = sk.estimates(sk.merged(sk.read_sketches(spark, path).filter("year = 2001"))).first()
    assert one.n == len(newer)
    assert sk.merged(sk.sketched(days.limit(0))).first().n is None
