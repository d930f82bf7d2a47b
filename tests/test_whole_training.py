"""Model queries fit on every training row, whatever bound other queries have."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.catalog import QUERIES, adapters
from rimeframe.catalog import model_queries as mq
from rimeframe.operators import folds as fo
from rimeframe.operators import modelling as ml
from rimeframe.storage import stage

SMALL = {"gbt": {"maxIter": 1, "maxDepth": 2}, "rf": {"numTrees": 2, "maxDepth": 2}, "lr": {"maxIter": 2}}


@pytest.fixture(scope="module")
def gold(spark, sf):
    return stage(adapters.gold_days(spark, sf), "gold")


@pytest.fixture()
def fitted_rows(spark, sf, gold, monkeypatch):
    """The rows of each distinct fit of a query with small settings and a bound of 50 rows."""
    monkeypatch.setattr(mq, "TRAINING_ROWS", 50)
    monkeypatch.setattr(adapters, "gold_days", lambda spark, folder: gold)
    monkeypatch.setattr(fv, "MODEL_SETTINGS", SMALL)
    monkeypatch.setitem(fv.TUNING_GRIDS, "rf", {"maxDepth": [1, 2]})
    counts, plain = [], Pipeline._fit
    monkeypatch.setattr(Pipeline, "_fit", lambda self, rows: counts.append(rows.count()) or plain(self, rows))

    def run(name):
        assert QUERIES[name](spark, sf).count() > 0
        return counts

    return run


def before_test_year(rows):
    return rows.filter(F.col("year") < adapters.TEST_YEAR)


def known_labels(gold):
    view = before_test_year(ml.horizon_view(gold))
    return [view.filter(F.col(f"y_h{k}").isNotNull()).count() for k in fv.HORIZONS]


@pytest.mark.parametrize(
    "name", ["m13_model_comparison", "m14_ablation_without_rain", "m8_stage_composition", "m9_forest_grid"])
def test_classifiers(name, gold, fitted_rows):
    assert set(fitted_rows(name)) == {before_test_year(ml.training_view(gold)).count()}


def test_forest_of_temperatures(gold, fitted_rows):
    known = before_test_year(gold).filter(F.col("next_day_tmin_c").isNotNull())
    assert fitted_rows("m16_forest_temperature") == [known.count()]


def test_horizons(gold, fitted_rows):
    assert sorted(fitted_rows("m15_horizon_skill")) == sorted(known_labels(gold))


def test_shared_horizons(gold, fitted_rows):
    assert fitted_rows("m15_shared_horizons") == [sum(known_labels(gold))]


def test_large_tables_are_fitted_one_at_a_time(spark, monkeypatch):
    rows = spark.range(10)
    for bound, wanted in ((5, 1), (25, 2), (1000, 4)):
        monkeypatch.setattr(ml, "ROWS_AT_ONCE", bound)
        assert ml.fits_at_once(rows, 4) == wanted
    assert ml.fits_at_once(rows.limit(0), 4) == 4 and ml.fits_at_once(rows, 1) == 1


def test_combinations_on_large_tables_run_one_at_a_time(spark, gold, monkeypatch):
    at_once, plain = [], ml.side_by_side
    monkeypatch.setattr(ml, "side_by_side", lambda spark, jobs, n: at_once.append(n) or plain(spark, jobs, n))
    monkeypatch.setattr(ml, "ROWS_AT_ONCE", 1, raising=False)
    train, test = ml.split_by_year(ml.training_view(gold), adapters.TEST_YEAR)
    choices, pipeline = {"maxIter": [1, 2]}, ml.frost_pipeline("lr")
    grid = {str(i): x for i, x in enumerate(ml.parameter_grid("lr", pipeline.getStages()[-1], choices))}
    assert len(ml.grid_scores(train, test, pipeline, grid, 4)) == 2
    assert len(ml.tune(train, "lr", 2, 4, choices).avgMetrics) == 2
    assert fo.tune_forward(fo.dated_view(gold), "lr", 2, choices=choices, parallelism=4).scores.count() == 4
    assert at_once == [1] * 4
