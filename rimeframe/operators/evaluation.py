"""Scoring predictions on the full data.

Counts are taken in one distributed pass; everything cumulative then runs on the aggregated
bins, whose number is fixed by the caller and never grows with the data.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.functions import climate, space
from rimeframe.functions.thresholds import score_bin, thresholds_reached


def _ratio(numerator: Column, denominator: Column) -> Column:
    """0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(F.lit(2.0) * precision * recall, precision + recall)


def frost_probability(scored: DataFrame) -> DataFrame:
    """Adds ``p1``, the probability of the frost class."""
    return scored.withColumn("p1", vector_to_array("probability")[1])


def with_rule(df: DataFrame, threshold_c: float = fv.FROST_RULE_C) -> DataFrame:
    """Predictions of the rule "today's minimum is at most the threshold"."""
    return df.withColumn("prediction", climate.frost_rule(F.col("tmin_c"), threshold_c))


def confusion(scored: DataFrame, *by: str) -> DataFrame:
    """tn, fp, fn and tp in one row (or one row per group)."""
    label, prediction = F.col(fv.LABEL), F.col("prediction")
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return scored.groupBy(*by).agg(
        *[
            F.count_if((label == actual) & (prediction == predicted)).alias(name)
            for name, (actual, predicted) in cells.items()
        ]
    )


def frost_class_metrics(scored: DataFrame, *by: str) -> DataFrame:
    """Precision, recall and F1 of the frost class."""
    return confusion(scored, *by).transform(with_frost_class)


def with_frost_class(counts: DataFrame) -> DataFrame:
    """Adds precision, recall and F1 of the frost class to tp, fp and fn."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn)}
    ).withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def classification_metrics(scored: DataFrame, *by: str) -> DataFrame:
    """Accuracy and support-weighted F1, precision and recall, from one confusion pass."""
    counts = confusion(scored, *by)
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    frost_p, frost_r = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    clear_p, clear_r = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    frost_weight, clear_weight = _ratio(tp + fn, total), _ratio(tn + fp, total)

    def weighted(frost: Column, clear: Column) -> Column:
        return frost * frost_weight + clear * clear_weight

    return counts.select(
        *by,
        _ratio(tn + tp, total).alias("accuracy"),
        weighted(_f1(frost_p, frost_r), _f1(clear_p, clear_r)).alias("f1"),
        weighted(frost_p, clear_p).alias("weighted_precision"),
        weighted(frost_r, clear_r).alias("weighted_recall"),
    )


def rule_by_threshold(df: DataFrame, thresholds: tuple = fv.FROST_RULE_STEPS_C) -> DataFrame:
    """The rule at several thresholds, all counted in a single pass."""
    actual = F.col(fv.LABEL) == 1
    counts = []
    for k in thresholds:
        called = climate.frost_rule(F.col("tmin_c"), float(k)) == 1
        counts += [
            F.struct(
                F.lit(k).alias("threshold_c"),
                F.count_if(called & actual).alias("tp"),
                F.count_if(called & ~actual).alias("fp"),
                F.count_if(~called & actual).alias("fn"),
            ).alias(f"at_{k}")
        ]
    one_row = df.agg(*counts)
    by_threshold = one_row.select(F.inline(F.array(*[f"at_{k}" for k in thresholds])))
    return with_frost_class(by_threshold)


def _cumulative(binned: DataFrame, order: Column) -> DataFrame:
    """Running true and false positives from the highest bin down, with the totals.

    ``binned`` has one row per bin, so the single-partition window is bounded by the bin count.
    """
    down = Window.orderBy(order)
    running = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return binned.select(
        "*",
        F.sum("pos").over(running).alias("tp"),
        F.sum("neg").over(running).alias("fp"),
        F.sum("pos").over(whole).alias("all_pos"),
        F.sum("neg").over(whole).alias("all_neg"),
    )


def label_counts() -> list[Column]:
    """Rows of either label, as pos and neg."""
    return [
        F.count_if(F.col(fv.LABEL) == 1).alias("pos"),
        F.count_if(F.col(fv.LABEL) == 0).alias("neg"),
    ]


def curve_points(scored: DataFrame, score: str = "p1", bins: int = 1000) -> DataFrame:
    """ROC and precision-recall points, one per non-empty score bin, highest scores first."""
    binned = (
        scored.filter(F.col(score).isNotNull())
        .groupBy(score_bin(F.col(score), bins).alias("bin"))
        .agg(*label_counts())
    )
    running = _cumulative(binned, F.desc("bin"))
    return running.select(
        "bin",
        "tp",
        "fp",
        _ratio(F.col("fp"), F.col("all_neg")).alias("fpr"),
        _ratio(F.col("tp"), F.col("all_pos")).alias("tpr"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def threshold_sweep(
    scored: DataFrame, score: str = "p1", thresholds: tuple = fv.PROBABILITY_STEPS
) -> DataFrame:
    """Precision, recall and F1 at every probability threshold.

    Rows are grouped by the number of thresholds their score reaches; a reverse running sum over
    those few groups gives each threshold's counts, so no row is ever repeated per threshold.
    """
    reached = (
        scored.filter(F.col(score).isNotNull())
        .groupBy(thresholds_reached(F.col(score), thresholds).alias("reached"))
        .agg(*label_counts())
    )
    slots = scored.sparkSession.range(len(thresholds) + 1).select(F.col("id").cast("int").alias("reached"))
    full = slots.join(reached, "reached", "left").na.fill(0, ["pos", "neg"])
    counted = _cumulative(full, F.desc("reached")).filter(F.col("reached") > 0)
    at = F.element_at(F.array(*[F.lit(t) for t in thresholds]), F.col("reached"))
    points = counted.select(
        at.alias("threshold"), "tp", "fp", (F.col("all_pos") - F.col("tp")).alias("fn")
    )
    return with_frost_class(points)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The lowest threshold with the highest F1."""
    return sweep.orderBy(F.desc("f1"), "threshold").limit(1)


def mid_latitude(df: DataFrame, band: tuple[float, float] = fv.MID_LATITUDE_BAND) -> DataFrame:
    return df.filter(space.in_latitude_band(F.col("latitude"), band))


def class_balance(df: DataFrame, test_year: int) -> DataFrame:
    """Rows and positive share of the training and the test part."""
    part = (
        F.when(F.col("year") < test_year, "train").when(F.col("year") == test_year, "test")
    ).alias("split")
    return (
        df.groupBy(part)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(fv.LABEL) == 1).alias("n_pos"),
            F.avg(fv.LABEL).alias("positive_rate"),
        )
        .filter(F.col("split").isNotNull())
    )


def regression_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """rmse, mse, mae and r2 in one pass; pairs with a missing side are left out."""
    y, p = F.col(label), F.col(prediction)
    error = y - p
    one = scored.filter(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("spread"),
    )
    return one.select(
        "n",
        F.sqrt("mse").alias("rmse"),
        "mse",
        "mae",
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"),
    )


def ranking_metrics(scored: DataFrame, score: str = "rawPrediction") -> dict[str, float]:
    """ROC-AUC and PR-AUC of a fitted classifier, both from scores that Spark ML counts and sorts once."""
    evaluator = BinaryClassificationEvaluator(labelCol=fv.LABEL, rawPredictionCol=score)
    evaluator._transfer_params_to_java()
    metrics = evaluator._java_obj.getMetrics(scored._jdf)
    try:
        return {"roc_auc": metrics.areaUnderROC(), "pr_auc": metrics.areaUnderPR()}
    finally:
        metrics.unpersist()


def evaluate(scored: DataFrame) -> dict[str, float]:
    """All six classifier metrics.

    Several jobs read the predictions, so three numbers a row are kept while they run: keeping the vector of
    raw predictions instead takes longer than scoring does.
    """
    raw = vector_to_array("rawPrediction")[1].alias("raw")
    columns = scored.select(fv.LABEL, "prediction", raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {**ranking_metrics(columns, "raw"), **classification_metrics(columns).first().asDict()}
    finally:
        columns.unpersist()
