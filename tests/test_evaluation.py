import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rimeframe.functions.sampling import hash_sampled
from rimeframe.operators import analysis as an
from rimeframe.operators import evaluation as ev
from rimeframe.operators import ranking as rk


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "label DOUBLE, prediction DOUBLE")


def test_confusion_and_frost_class(spark):
    df = scored(spark, [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0), (1.0, 1.0)])
    assert tuple(ev.confusion(df).first()) == (1, 1, 1, 2)
    m = ev.frost_class_metrics(df).first()
    assert (m.precision, m.recall, m.f1) == pytest.approx((2 / 3, 2 / 3, 2 / 3))


def test_nothing_predicted_and_nothing_there(spark):
    never = ev.frost_class_metrics(scored(spark, [(1.0, 0.0), (0.0, 0.0)])).first()
    assert (never.precision, never.recall, never.f1) == (0.0, 0.0, 0.0)
    empty = ev.classification_metrics(scored(spark, [(1.0, 0.0)]).limit(0)).first()
    assert (empty.accuracy, empty.f1) == (0.0, 0.0)


def test_one_pass_metrics_equal_the_evaluator(spark):
    rng = random.Random(5)
    df = scored(spark, [(float(rng.random() < 0.4), float(rng.random() < 0.6)) for _ in range(500)])
    ours = ev.classification_metrics(df).first()
    theirs = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for name, metric in (("accuracy", "accuracy"), ("f1", "f1"),
                         ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall")):
        assert ours[name] == pytest.approx(theirs.evaluate(df, {theirs.metricName: metric}))


def test_rule_with_unknown_minimum(spark):
    df = spark.createDataFrame([(2.0,), (2.1,), (None,)], "tmin_c DOUBLE")
    assert [r.prediction for r in ev.with_rule(df).collect()] == [1.0, 0.0, 0.0]


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0)], "s DOUBLE, label DOUBLE")
    assert rk.score_auc(df, F.col("s")).first().auc == 0.75


def test_auc_against_all_pairs(spark, monkeypatch):
    rng = random.Random(7)
    pairs = [(round(rng.gauss(0, 4), 1), float(rng.random() < 0.3)) for _ in range(300)]
    df = spark.createDataFrame(pairs + [(None, 1.0)], "s DOUBLE, label DOUBLE")
    assert rk.score_auc(df, F.col("s")).first().auc == pytest.approx(brute_auc(pairs))
    tiny = [(i * 1e-4, int(i % 3 == 0 or i > 25)) for i in range(31)]
    small = spark.createDataFrame([(s, float(y)) for s, y in tiny], "s double, label double")
    for rows in (3, 1000):
        monkeypatch.setattr(rk, "ROWS_PER_RANGE", rows)
        exact = rk.score_auc(small, F.col("s")).first().auc
        assert exact == pytest.approx(brute_auc(tiny))
    one_class = df.filter("label = 1")
    assert rk.score_auc(one_class, F.col("s")).first().auc is None


def test_sweep_and_curve_against_brute_force(spark):
    rng = random.Random(9)
    pairs = [(rng.choice([rng.random(), 0.5, 0.1, 1.0]), float(rng.random() < 0.5)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "p1 DOUBLE, label DOUBLE")
    for row in ev.threshold_sweep(df).collect():
        assert row.tp == sum(p >= row.threshold and y == 1 for p, y in pairs)
        assert row.fp == sum(p >= row.threshold and y == 0 for p, y in pairs)
        assert row.fn == sum(p < row.threshold and y == 1 for p, y in pairs)
    assert ev.threshold_sweep(df).count() == 33
    best = ev.best_threshold(ev.threshold_sweep(df)).first()
    assert best.f1 == max(r.f1 for r in ev.threshold_sweep(df).collect())
    points = ev.curve_points(df, bins=50).orderBy(F.desc("bin")).collect()
    assert (points[-1].tpr, points[-1].fpr) == (1.0, 1.0)
    for row in points:
        assert row.tp == sum(min(int(p * 50), 49) >= row.bin and y == 1 for p, y in pairs)


def test_areas_equal_the_evaluator_from_one_sort_of_the_scores(spark):
    """Both areas come from the same sorted counts, and only numbers are kept, no vectors."""
    rng = random.Random(11)
    raw = [(round(rng.gauss(0, 1), 1), float(rng.random() < 0.4)) for _ in range(300)]
    rows = [(y, float(s > 0), Vectors.dense(-s, s)) for s, y in raw]
    df = spark.createDataFrame(rows, ["label", "prediction", "rawPrediction"])
    theirs = BinaryClassificationEvaluator(labelCol="label")
    numbers = df.withColumn("raw", vector_to_array("rawPrediction")[1]).drop("rawPrediction")
    context = spark.sparkContext

    def jobs_of(name, work):
        context.setJobGroup(name, name)
        try:
            return work(), len(context.statusTracker().getJobIdsForGroup(name))
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)

    wanted, two = jobs_of("two evaluators", lambda: {
        "roc_auc": theirs.evaluate(df), "pr_auc": theirs.evaluate(df, {theirs.metricName: "areaUnderPR"})})
    got, one = jobs_of("one sort", lambda: ev.ranking_metrics(numbers, "raw"))
    assert got == pytest.approx(wanted)
    assert 0 < one < two
    assert {k: v for k, v in ev.evaluate(df).items() if k in wanted} == pytest.approx(wanted)


def test_regression_metrics_equal_the_evaluator(spark):
    rng = random.Random(3)
    rows = [(rng.gauss(0, 5), rng.gauss(0, 5)) for _ in range(200)]
    df = spark.createDataFrame(rows, "y DOUBLE, p DOUBLE")
    ours = ev.regression_metrics(df, "y", "p").first()
    theirs = RegressionEvaluator(labelCol="y", predictionCol="p")
    for name in ("rmse", "mse", "mae", "r2"):
        assert ours[name] == pytest.approx(theirs.evaluate(df, {theirs.metricName: name}))


def test_class_balance_of_an_empty_part(spark):
    df = spark.createDataFrame([(2000, 1.0), (2000, 0.0)], "year INT, label DOUBLE")
    got = [tuple(r) for r in ev.class_balance(df, 2001).collect()]
    assert got == [("train", 2, 1, 0.5)]


def test_hash_sample_is_stable_and_close_to_its_fraction(spark):
    df = spark.range(20000)
    chosen = df.filter(hash_sampled([F.col("id")], 0.1, seed=1))
    again = df.repartition(7).filter(hash_sampled([F.col("id")], 0.1, seed=1))
    assert chosen.exceptAll(again).count() == 0
    assert 0.08 < chosen.count() / 20000 < 0.12
    other = df.filter(hash_sampled([F.col("id")], 0.1, seed=2))
    assert 0 < chosen.intersect(other).count() < chosen.count()
    portable = df.filter(hash_sampled([F.col("id")], 0.1, portable=True)).count()
    assert 0.08 < portable / 20000 < 0.12


def test_word_counts_use_whole_texts(spark):
    texts = spark.createDataFrame([("the cat\nsat on  the mat",), ("the end " * 5000,)], "text STRING")
    got = {r.word: r.n for r in an.word_counts(texts).collect()}
    assert got == {"the": 5002, "cat": 1, "sat": 1, "on": 1, "mat": 1, "end": 5000}
