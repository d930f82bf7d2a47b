import json

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.catalog import adapters
from rimeframe.operators import evaluation as ev
from rimeframe.operators import modelling as ml
from rimeframe.plans.training import train_frost_model
from rimeframe.storage import stage

SMALL = {"maxIter": 3, "maxDepth": 3}


@pytest.fixture(scope="module")
def gold(spark, sf):
    return stage(adapters.gold_days(spark, sf), "gold")


@pytest.fixture(scope="module")
def parts(gold):
    return ml.split_by_year(ml.training_view(gold), adapters.TEST_YEAR)


def test_features():
    assert len(fv.FEATURES) == 30 and len(set(fv.FEATURES)) == 30
    assert set(fv.RAIN_FEATURES) < set(fv.FEATURES)


def test_split_drops_later_years(spark):
    df = spark.createDataFrame([(y,) for y in (2022, 2023, 2024, 2025)], "year INT")
    train, test = ml.split_by_year(df, 2024)
    assert sorted(r.year for r in train.collect()) == [2022, 2023]
    assert [r.year for r in test.collect()] == [2024]


def test_unknown_names_are_errors():
    for make in (ml.frost_pipeline, ml.temperature_pipeline):
        with pytest.raises(ValueError):
            make("oracle")
    with pytest.raises(ValueError):
        ml.parameter_grid("oracle", None)


def test_grids(spark):
    sizes = {a: len(ml.parameter_grid(a, ml.classifier(a))) for a in ("gbt", "rf", "lr")}
    assert sizes == {"gbt": 4, "rf": 4, "lr": 6}


def test_settings_reach_the_classifier(spark):
    gbt = ml.classifier("gbt")
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize(), gbt.getSubsamplingRate(),
            gbt.getSeed()) == (40, 6, 0.1, 0.8, 42)
    rf = ml.classifier("rf", numTrees=5)
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getFeatureSubsetStrategy()) == (5, 10, "sqrt")
    assert ml.classifier("lr").getFeaturesCol() == "features_scaled"


def test_medians_come_from_the_training_part(spark, parts):
    train, test = parts
    model = ml.median_imputer(["tmin_c"], 0.0).fit(train)
    known = sorted(r[0] for r in train.select("tmin_c").collect() if r[0] is not None)
    assert model.surrogateDF.first()[0] == known[(len(known) - 1) // 2]
    filled = model.transform(test.filter(F.col("tmin_c").isNull()))
    assert {r[0] for r in filled.select("tmin_c__imp").collect()} <= {known[(len(known) - 1) // 2]}


def test_model_beats_chance_and_survives_saving(spark, parts, tmp_path):
    train, test = parts
    model = ml.frost_pipeline("gbt", **SMALL).fit(train)
    scored = model.transform(test)
    metrics = ev.evaluate(scored)
    assert 0.6 < metrics["roc_auc"] <= 1 and 0 < metrics["accuracy"] <= 1
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(test)
    assert scored.select("prediction").collect() == again.select("prediction").collect()
    top = ml.top_features(spark, model, 5).collect()
    assert len(top) == 5 and top[0].importance >= top[1].importance
    points = ev.curve_points(ev.frost_probability(scored))
    area = sum(r.tp for r in points.collect())
    assert area > 0


def test_no_importances_for_the_linear_model(spark, parts):
    model = ml.frost_pipeline("lr", maxIter=3).fit(parts[0])
    assert ml.top_features(spark, model).count() == 0


def test_comparison_ablation_and_horizons(spark, gold, parts):
    settings = {"gbt": SMALL, "rf": {"numTrees": 3, "maxDepth": 3}, "lr": {"maxIter": 3}}
    table = ml.metrics_table(spark, ml.compare(*parts, settings=settings, parallelism=3)).collect()
    assert [r.model for r in table] == ["rule", "lr", "rf", "gbt"]
    assert table[0].roc_auc is None and table[0].accuracy > 0
    ablated = ml.ablation(*parts, **SMALL)
    assert set(ablated) == {"all", "reduced"}
    view = stage(ml.horizon_view(gold, (1, 3)), "horizons")
    skill = ml.horizon_skill(view, adapters.TEST_YEAR, (1, 3), parallelism=2, **SMALL).collect()
    assert [r.horizon_days for r in skill] == [1, 3]


def test_tuning_with_year_folds(spark, parts):
    folded = ml.year_folds(parts[0])
    choices = {"maxIter": [2, 4]}
    tuned = ml.tune(folded, "lr", choices=choices, fold_column="fold", parallelism=2)
    scores = ml.tuning_scores(spark, tuned).collect()
    assert len(scores) == 2 and sum(r.is_best for r in scores) == 1


def test_preparation_is_fitted_once_a_fold(spark, parts, monkeypatch):
    fits = []
    plain = ml.MedianImputer._fit
    monkeypatch.setattr(ml.MedianImputer, "_fit", lambda self, rows: fits.append(1) or plain(self, rows))
    choices = {"regParam": [0.0, 0.1], "maxIter": [2]}
    tuned = ml.tune(parts[0], "lr", choices=choices, parallelism=2)
    assert len(fits) == fv.TUNING_FOLDS + 1  # and once for the best model
    pipeline = ml.frost_pipeline("lr")
    validator = CrossValidator(
        estimator=pipeline, estimatorParamMaps=ml.parameter_grid("lr", pipeline.getStages()[-1], choices),
        evaluator=BinaryClassificationEvaluator(labelCol=fv.LABEL), numFolds=fv.TUNING_FOLDS, seed=fv.SEED)
    wanted = validator.fit(parts[0])
    assert tuned.avgMetrics == pytest.approx(wanted.avgMetrics, abs=1e-9)
    assert tuned.stdMetrics == pytest.approx(wanted.stdMetrics, abs=1e-9)
    fits.clear()
    last = pipeline.getStages()[-1]
    grid = {str(v): {last.regParam: v, last.maxIter: 2} for v in (0.0, 0.1)}
    found = ml.grid_scores(*parts, pipeline, grid, parallelism=2)
    assert len(fits) == 1
    for name, params in grid.items():
        assert found[name] == pytest.approx(ml.fit_and_judge(*parts, pipeline.copy(params)), abs=1e-9)


def test_folds_without_rows_are_errors(spark, parts):
    for fold in (F.lit(0), F.lit(3), F.lit(None).cast("int")):
        with pytest.raises(ValueError):
            ml.tune(parts[0].withColumn("fold", fold), "lr", fold_column="fold", maxIter=1)


def test_feature_without_known_values(spark):
    rows = spark.createDataFrame([(1.0, None), (3.0, float("nan")), (None, None)], "a DOUBLE, b DOUBLE")
    model = ml.median_imputer(["a", "b"]).fit(rows)
    assert {(r.a__imp, r.b__imp) for r in model.transform(rows).collect()} == {(1.0, 0.0), (3.0, 0.0)}


def test_training_job_writes_model_and_metrics(spark, gold, tmp_path):
    summary = train_frost_model(
        spark, gold, str(tmp_path / "model"), str(tmp_path / "metrics"), adapters.TEST_YEAR,
        sample_fraction=0.5, tuned=True, choices={"maxDepth": [2, 3]}, maxIter=2, folds=2,
    ).first()
    assert summary.n_test > 0 and summary.tuning.param_grid_size == 2
    assert sum(summary.confusion) == summary.n_test
    written = [json.loads(line) for f in (tmp_path / "metrics").glob("*.json")
               for line in f.read_text().splitlines()]
    assert written[0]["algorithm"] == "gbt" and len(written[0]["top_features"]) == 12
    assert PipelineModel.load(str(tmp_path / "model")).stages


def test_regressors_and_encoder(spark, gold):
    days = gold.filter(F.col("next_day_tmin_c").isNotNull())
    train, test = ml.split_by_year(days, adapters.TEST_YEAR)
    for kind, small in (("linear", {}), ("forest", {"numTrees": 3, "maxDepth": 3})):
        scored = ml.temperature_pipeline(kind, **small).fit(train).transform(test)
        assert ev.regression_metrics(scored, "next_day_tmin_c", "prediction").first().r2 > 0
    seen = spark.createDataFrame([("a",), ("a",), ("b",)], "state STRING")
    fitted = ml.encoder(["state"]).fit(seen)
    got = fitted.transform(spark.createDataFrame([("b",), ("new",)], "state STRING")).collect()
    assert [r.state_index for r in got] == [1.0, 2.0]
