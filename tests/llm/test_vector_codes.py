"""op11 against plain integer clustering, and against its SQL."""

import math
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from rimeframe.llm import vector_codes as vc  # noqa: E402
from tools.check_queries import compare  # noqa: E402


def brute(rows, entries=vc.ENTRIES, rounds=vc.ROUNDS):
    """rows: (vec_id, label, vector), all of one length."""
    size = len(rows[0][2]) // vc.PARTS
    points = [[math.floor(vc.SCALE * x) for x in r[2]] for r in rows]
    cut = [[p[k * size : (k + 1) * size] for k in range(vc.PARTS)] for p in points]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][2]))[:entries]
    books = [[cut[i][k] for i in first] for k in range(vc.PARTS)]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for k in range(vc.PARTS):
            own = [nearest(c[k], books[k])[1] for c in cut]
            for e in range(len(books[k])):
                mine = [c[k] for c, o in zip(cut, own, strict=True) if o == e]
                if mine:
                    books[k][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = []
    for (vec_id, label, _), c in zip(rows, cut, strict=True):
        found = [nearest(c[k], books[k]) for k in range(vc.PARTS)]
        out.append((vec_id, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return out, books


def order(rows):
    return sorted(rows, key=repr)


def table(spark, rows):
    return spark.createDataFrame(
        [(i, v, label, "x", 1) for i, label, v in rows],
        "vec_id bigint, embedding array<float>, label int, ids string, n int").repartition(3)


def vectors(n, size, seed, spread):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        centre = rng.randrange(4)
        v = [float(np.float32(rng.gauss(centre - 1.5, spread))) for _ in range(size)]
        rows.append((i, rng.choice([None, 1, 2, 2, 2]), v))
    return rows


@pytest.mark.parametrize("n, size, spread, block, cells", [
    (300, 16, 0.2, 32, 1 << 21), (200, 64, 1.0, 4, 64 * 50), (40, 8, 0.001, 32, 1 << 21), (60, 1040, 1, 8, 1),
])
def test_codes_equal_brute_force(spark, monkeypatch, n, size, spread, block, cells):
    monkeypatch.setattr(vc, "BLOCK", block)
    monkeypatch.setattr(vc, "CHUNK_CELLS", cells)
    rows = vectors(n, size, n, spread)
    want, books = brute(rows)
    codes, own = vc.encode(table(spark, rows))
    assert own.tolist() == books
    assert order(tuple(r) for r in codes.collect()) == order(want)


def test_defined_cases(spark):
    """Unfit rows go; ties, copies, null ids and labels, and few vectors have results."""
    good = [(5, None, [0.5] * 8), (5, 1, [0.25] * 8), (None, None, [0.5] * 8), (9, 1, [-1.0] * 8),
            (7, 1, [0.5] * 8)]
    bad = [(1, 1, None), (2, 1, []), (3, 1, [1.0] * 7 + [None]), (4, 1, [math.nan] * 8),
           (6, 1, [math.inf] + [0.0] * 7), (0, 1, [1.0] * 7), (8, 1, [1.0] * 16)]
    want, books = brute(good)
    codes, own = vc.encode(table(spark, good + bad))
    assert own.tolist() == books and len(books[0]) == 5
    with_labels = vc.with_label_error(codes)
    assert order(tuple(r)[:4] for r in with_labels.collect()) == order(want)
    sums = {label: sum(r[3] for r in want if r[1] == label) for label in (None, 1)}
    assert all(r["label_error"] == sums[r["label"]] for r in with_labels.collect())
    for rows in ([], bad[:2]):
        codes, own = vc.encode(table(spark, rows))
        assert codes.collect() == [] and own.size == 0
        assert vc.with_label_error(codes).collect() == []


def test_too_large_components(spark):
    with pytest.raises(ValueError):
        vc.encode(table(spark, [(1, 1, [1e30] * 8)]))


def test_block_sums_and_shortlists():
    """Shortlists never drop a nearest entry, also with entries at equal distances."""
    rng = np.random.default_rng(3)
    points = rng.integers(-20, 20, (100, 2))
    blocks = vc.Blocks.of(points[vc.hilbert_order(points)])
    book = np.array([[0, 0], [0, 0], [15, 15], [-15, 10], [10, -15], [100, 100]])
    lists = blocks.shortlists(book)
    assert not lists[:, 5].any() and lists.sum() < lists.size
    entry, far = blocks.codes(book)
    flat = blocks.points.reshape(-1, 2)[:100]
    all_far = ((flat[:, None] - book) ** 2).sum(axis=2)
    assert (entry == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()
    totals = blocks.totals(book)
    assert totals[:, 2].tolist() == np.bincount(entry, minlength=6).tolist()
    assert totals[:, :2].sum(axis=0).tolist() == points.sum(axis=0).tolist()


def test_hilbert_neighbours():
    """On a full grid, neighbours on the curve are neighbours in space."""
    grid = np.array([(x, y, z) for x in range(4) for y in range(4) for z in range(4)])
    ordered = grid[vc.hilbert_order(grid)]
    assert (np.abs(np.diff(ordered, axis=0)).sum(axis=1) == 1).all()


def test_sql(spark, sf):
    from rimeframe.llm.queries import ORACLES, QUERIES

    name = "op11_vector_codes"
    assert compare(QUERIES[name](spark, sf), ORACLES[name], sf) == ""
