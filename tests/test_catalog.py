"""Every query against its SQL text on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rimeframe.catalog import ORACLES, QUERIES  # noqa: E402
from tools.check_queries import compare  # noqa: E402

EMPTY_AT_THIS_SCALE = {"f10_frost_by_elevation", "j6_station_sample", "p18_cell_priority"}


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert not [n for n in QUERIES if n.startswith("op") or "pipeline" in n]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    problem = compare(QUERIES[name](spark, sf), ORACLES[name], sf)
    assert not problem or (problem == "no rows" and name in EMPTY_AT_THIS_SCALE)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert len(df.columns) == 46 and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
