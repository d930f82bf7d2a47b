"""Feature pipelines, tuning and comparison of frost classifiers with Spark ML."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial
from statistics import fmean, pstdev

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.functions.sampling import hash_sampled
from rimeframe.operators import evaluation as ev
from rimeframe.operators import gold as g
from rimeframe.operators import ranking as rk
from rimeframe.storage import stage

#: Training rows that fits running side by side may keep together.  Spark ML keeps its own copy of the rows of
#: each fit (a forest of 80 trees about 500 bytes a row), which goes to disk when it outgrows the memory.
ROWS_AT_ONCE = 8_000_000

CLASSIFIERS = {
    "gbt": GBTClassifier,
    "rf": RandomForestClassifier,
    "lr": LogisticRegression,
}


def labelled(gold: DataFrame) -> DataFrame:
    """Rows whose next day is known, with a numeric label."""
    return gold.filter(F.col("next_day_is_frost").isNotNull()).withColumn(
        fv.LABEL, F.col("next_day_is_frost").cast("double")
    )


def training_view(gold: DataFrame, features: Iterable[str] = fv.FEATURES) -> DataFrame:
    """Year, label and features of the labelled rows; the scan reads only these columns."""
    return labelled(gold).select("year", fv.LABEL, *features)


def split_by_year(view: DataFrame, test_year: int) -> tuple[DataFrame, DataFrame]:
    """Earlier years for training, one year for testing; later years are left out."""
    return view.filter(F.col("year") < test_year), view.filter(F.col("year") == test_year)


def bounded(train: DataFrame, most: int) -> DataFrame:
    """About ``most`` training rows, chosen by a hash of their content; all of them if fewer."""
    count = train.count()
    if count <= most:
        return train
    return train.filter(hash_sampled([F.col(c) for c in train.columns], most / count, fv.SEED))


def imputed(features: Iterable[str]) -> list[str]:
    return [f"{name}__imp" for name in features]


class MedianImputer(Imputer):
    """Spark's imputer; a feature without any known value is filled with 0 instead of failing the fit."""

    def _fit(self, dataset: DataFrame):
        try:
            return super()._fit(dataset)
        except Py4JJavaError:
            columns = self.getInputCols()
            known = dataset.agg(*[F.count(F.nanvl(F.col(c).cast("double"), F.lit(None))) for c in columns]).first()
            unknown = [c for c, n in zip(columns, known, strict=True) if not n]
            if not unknown:
                raise
            return super()._fit(dataset.withColumns({c: F.lit(0.0) for c in unknown}))


def median_imputer(features: Iterable[str], relative_error: float = 0.001) -> Imputer:
    return MedianImputer(
        strategy="median",
        inputCols=list(features),
        outputCols=imputed(features),
        relativeError=relative_error,
    )


def assembler(columns: Iterable[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep")


def scaler() -> StandardScaler:
    return StandardScaler(
        inputCol="features", outputCol="features_scaled", withMean=False, withStd=True
    )


def classifier(algorithm: str, **overrides):
    """A configured, unfitted classifier; unknown names are an error."""
    if algorithm not in CLASSIFIERS:
        raise ValueError(f"unknown algorithm: {algorithm}; choose from {sorted(CLASSIFIERS)}")
    column = "features_scaled" if algorithm == "lr" else "features"
    settings = {**fv.MODEL_SETTINGS[algorithm], **overrides}
    return CLASSIFIERS[algorithm](labelCol=fv.LABEL, featuresCol=column, **settings)


def frost_pipeline(
    algorithm: str, features: Iterable[str] = fv.FEATURES, **overrides
) -> Pipeline:
    """Impute, assemble, scale (linear model only) and classify."""
    features = list(features)
    last = classifier(algorithm, **overrides)
    stages = [median_imputer(features), assembler(imputed(features))]
    if algorithm == "lr":
        stages.append(scaler())
    return Pipeline(stages=[*stages, last])


def parameter_grid(algorithm: str, estimator, choices: dict | None = None) -> list[dict]:
    """All combinations of the tuning choices of an algorithm."""
    if algorithm not in CLASSIFIERS:
        raise ValueError(f"unknown algorithm: {algorithm}; choose from {sorted(CLASSIFIERS)}")
    grid = ParamGridBuilder()
    for name, values in (choices or fv.TUNING_GRIDS[algorithm]).items():
        grid = grid.addGrid(estimator.getParam(name), values)
    return grid.build()


def without_classifier(pipeline: Pipeline) -> Pipeline:
    """The stages that prepare rows; they do not depend on the classifier's parameters."""
    return Pipeline(stages=pipeline.getStages()[:-1])


@contextmanager
def prepared_parts(pipeline: Pipeline, train: DataFrame, judged: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Label and vectors of both parts, prepared by one fit on the training part and kept while they are used.

    Every fit reads its rows twice before its own blocks are kept, so without this each combination of a grid
    would impute, assemble and scale all rows again.
    """
    column = pipeline.getStages()[-1].getFeaturesCol()
    model = without_classifier(pipeline).fit(train)
    parts = [model.transform(x).select(fv.LABEL, column).persist(StorageLevel.MEMORY_AND_DISK) for x in (train, judged)]
    try:
        yield parts[0], parts[1]
    finally:
        for part in parts:
            part.unpersist()


def grid_scores(
    train: DataFrame, test: DataFrame, pipeline: Pipeline, grid: dict[str, dict], parallelism: int = 1
) -> dict[str, dict[str, float]]:
    """All metrics of every named combination of the classifier's parameters, from rows prepared once."""
    last = pipeline.getStages()[-1]
    with prepared_parts(pipeline, train, test) as parts:
        jobs = {
            name: partial(fit_and_judge, *parts, Pipeline(stages=[last.copy(params)]))
            for name, params in grid.items()
        }
        return side_by_side(train.sparkSession, jobs, fits_at_once(parts[0], parallelism))


def fold_conditions(folds: int, fold_column: str | None, draw: Column) -> list[Column]:
    """Which rows each fold judges: equal shares of a draw in [0, 1), or those with the fold's number."""
    if fold_column:
        return [F.col(fold_column) == i for i in range(folds)]
    share = 1.0 / folds
    return [(draw >= i * share) & (draw < (i + 1) * share) for i in range(folds)]


def _checked_folds(train: DataFrame, judged: list[Column], fold_column: str | None) -> None:
    """An error for a fold without rows on either side, or a number that is no fold's."""
    counts = train.agg(F.count(F.lit(1)), *[F.count_if(x) for x in judged]).first()
    rows, sizes = counts[0], counts[1:]
    if fold_column and sum(sizes) != rows:
        raise ValueError(f"{fold_column} must be a number from 0 to {len(sizes) - 1}")
    for fold, size in enumerate(sizes):
        if size in (0, rows):
            raise ValueError(f"fold {fold} has {size} of {rows} rows to judge")


def tune(
    train: DataFrame,
    algorithm: str,
    folds: int = fv.TUNING_FOLDS,
    parallelism: int = 1,
    choices: dict | None = None,
    fold_column: str | None = None,
    **overrides,
) -> CrossValidatorModel:
    """Cross-validation by ROC-AUC, with medians and scales fitted once a fold, on its training part.

    Folds are random, which leaks mildly in time and is acceptable for choosing parameters only.
    ``fold_column`` (see ``year_folds``) keeps whole years together instead.
    """
    pipeline = frost_pipeline(algorithm, **overrides)
    last = pipeline.getStages()[-1]
    grid = parameter_grid(algorithm, last, choices)
    evaluator = BinaryClassificationEvaluator(
        labelCol=fv.LABEL, rawPredictionCol="rawPrediction", metricName="areaUnderROC"
    )
    drawn = train if fold_column else train.withColumn("fold_draw", F.rand(fv.SEED))
    judged_by = fold_conditions(folds, fold_column, F.col("fold_draw"))
    _checked_folds(drawn, judged_by, fold_column)

    def score(fitted_on: DataFrame, judged: DataFrame, number: int) -> float:
        return evaluator.evaluate(last.copy(grid[number]).fit(fitted_on).transform(judged))

    scores = []
    for judges in judged_by:
        with prepared_parts(pipeline, drawn.filter(~judges), drawn.filter(judges)) as parts:
            jobs = {i: partial(score, *parts, i) for i in range(len(grid))}
            at_once = fits_at_once(parts[0], parallelism)
            scores.append(list(side_by_side(train.sparkSession, jobs, at_once).values()))
    by_combination = list(zip(*scores, strict=True))
    means = [fmean(x) for x in by_combination]
    best = max(range(len(means)), key=means.__getitem__)
    found = CrossValidatorModel(
        pipeline.copy(grid[best]).fit(train), means, stdMetrics=[pstdev(x) for x in by_combination])
    settings = {"estimator": pipeline, "estimatorParamMaps": grid, "evaluator": evaluator, "numFolds": folds,
                "seed": fv.SEED, **({"foldCol": fold_column} if fold_column else {})}
    for name, value in settings.items():
        found.set(found.getParam(name), value)
    return found


def year_folds(view: DataFrame, folds: int = fv.TUNING_FOLDS) -> DataFrame:
    """Adds ``fold``: whole years dealt out in turn."""
    return view.withColumn("fold", F.pmod(F.col("year"), F.lit(folds)).cast("int"))


def tuning_scores(spark: SparkSession, tuned: CrossValidatorModel) -> DataFrame:
    """One row per combination with its mean score, the best marked."""
    scores = tuned.avgMetrics
    best = max(range(len(scores)), key=scores.__getitem__)
    rows = [
        (i, ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda x: x[0].name)),
         float(score), i == best)
        for i, (params, score) in enumerate(zip(tuned.getEstimatorParamMaps(), scores))
    ]
    return spark.createDataFrame(rows, "combination INT, params STRING, score DOUBLE, is_best BOOLEAN")


def top_features(
    spark: SparkSession, model: PipelineModel, k: int = 12, features: Iterable[str] = fv.FEATURES
) -> DataFrame:
    """The k most important features; empty for models without importances."""
    last = model.stages[-1]
    ranked = []
    if hasattr(last, "featureImportances"):
        pairs = zip(features, map(float, last.featureImportances.toArray()))
        ranked = sorted(pairs, key=lambda pair: -pair[1])[:k]
    return spark.createDataFrame(ranked, "feature STRING, importance DOUBLE")


def metrics_table(spark: SparkSession, results: dict[str, dict[str, float]]) -> DataFrame:
    """One row per model; metrics a model does not have are NULL."""
    names = ["roc_auc", "pr_auc", "accuracy", "f1", "weighted_precision", "weighted_recall"]
    rows = [(model, *[metrics.get(n) for n in names]) for model, metrics in results.items()]
    return spark.createDataFrame(rows, "model STRING, " + ", ".join(f"{n} DOUBLE" for n in names))


def side_by_side(spark: SparkSession, jobs: dict, parallelism: int) -> dict:
    """Run independent fits from several driver threads, keeping the order of their names.

    Every fit is a distributed job; starting a few at once keeps a large cluster busy.
    """
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as threads:
        running = {
            name: threads.submit(inheritable_thread_target(spark)(job))
            for name, job in jobs.items()
        }
        return {name: future.result() for name, future in running.items()}


def fits_at_once(train: DataFrame, parallelism: int) -> int:
    """How many fits on ``train`` may run side by side: on large tables one fit alone keeps a cluster busy."""
    if parallelism <= 1:
        return 1
    return max(1, min(parallelism, ROWS_AT_ONCE // max(1, train.count())))


def fit_and_judge(train: DataFrame, test: DataFrame, pipeline: Pipeline) -> dict[str, float]:
    return ev.evaluate(pipeline.fit(train).transform(test))


def compare(
    train: DataFrame, test: DataFrame, algorithms: Iterable[str] = ("lr", "rf", "gbt"),
    settings: dict[str, dict] | None = None, parallelism: int = 1,
) -> dict[str, dict[str, float]]:
    """The frost rule and every algorithm, judged on the same held-out rows."""
    rule = ev.classification_metrics(ev.with_rule(test)).first().asDict()
    jobs = {
        algorithm: partial(
            fit_and_judge, train, test,
            frost_pipeline(algorithm, **(settings or {}).get(algorithm, {})),
        )
        for algorithm in algorithms
    }
    return {"rule": rule, **side_by_side(train.sparkSession, jobs, fits_at_once(train, parallelism))}


def ablation(
    train: DataFrame, test: DataFrame, algorithm: str = "gbt",
    dropped: Iterable[str] = fv.RAIN_FEATURES, parallelism: int = 1, **overrides,
) -> dict[str, dict[str, float]]:
    """The same model with all features and without a group of them."""
    without = set(dropped)
    choices = {"all": fv.FEATURES, "reduced": [f for f in fv.FEATURES if f not in without]}
    jobs = {
        name: partial(fit_and_judge, train, test, frost_pipeline(algorithm, features, **overrides))
        for name, features in choices.items()
    }
    return side_by_side(train.sparkSession, jobs, fits_at_once(train, parallelism))


def horizon_view(gold: DataFrame, horizons: Iterable[int] = fv.HORIZONS) -> DataFrame:
    """Features and one label per horizon, from a single window."""
    labels = g.horizon_labels(horizons)
    return gold.withColumns(labels).select("year", *fv.FEATURES, *labels)


def horizon_skill(
    view: DataFrame,
    test_year: int,
    horizons: Iterable[int] = fv.HORIZONS,
    algorithm: str = "gbt",
    parallelism: int = 1,
    **overrides,
) -> DataFrame:
    """One model per horizon; accuracy, ROC-AUC and F1 by days ahead.

    ``view`` is read several times per horizon, so pass a staged table rather than a long plan.
    """

    def judged(k: int) -> dict[str, float]:
        at_k = view.filter(F.col(f"y_h{k}").isNotNull()).select(
            "year", F.col(f"y_h{k}").alias(fv.LABEL), *fv.FEATURES
        )
        return fit_and_judge(*split_by_year(at_k, test_year), frost_pipeline(algorithm, **overrides))

    jobs = {k: partial(judged, k) for k in horizons}
    at_once = fits_at_once(split_by_year(view, test_year)[0], parallelism)
    scores = side_by_side(view.sparkSession, jobs, at_once)
    rows = [(k, s["accuracy"], s["roc_auc"], s["f1"]) for k, s in scores.items()]
    return view.sparkSession.createDataFrame(
        rows, "horizon_days INT, accuracy DOUBLE, roc_auc DOUBLE, f1 DOUBLE"
    )


def stacked_horizons(view: DataFrame, horizons: Iterable[int] = fv.HORIZONS) -> DataFrame:
    """The view in long form: a row for each known label, with its horizon."""
    horizons = list(horizons)
    labels = F.array(*[F.struct(F.lit(k).alias("horizon_days"), F.col(f"y_h{k}").alias(fv.LABEL)) for k in horizons])
    others = [c for c in view.columns if c not in {f"y_h{k}" for k in horizons}]
    return view.select(*others, F.inline(labels)).filter(F.col(fv.LABEL).isNotNull())


def shared_horizon_skill(
    train: DataFrame, test: DataFrame, horizons: Iterable[int] = fv.HORIZONS, algorithm: str = "gbt", **overrides
) -> DataFrame:
    """One model for all horizons, with the horizon as a feature: one fit and one scoring instead of one each.

    All horizons are judged from one scored table: confusion, accuracy and ranking areas at the model's own
    threshold, and for each horizon the probability threshold of highest F1 with that F1.
    """
    features = [*fv.FEATURES, "horizon_days"]
    model = frost_pipeline(algorithm, features, **overrides).fit(stacked_horizons(train, horizons))
    scored = ev.frost_probability(model.transform(stacked_horizons(test, horizons)))
    rows = stage(scored.select("horizon_days", fv.LABEL, "prediction", "p1"), "scored")
    judged = rk.strata_metrics(rows, F.col("p1"), [["horizon_days"]])
    best = rk.best_thresholds(rows, ["horizon_days"]).select(
        "horizon_days", F.col("threshold").alias("best_threshold"), F.col("f1").alias("best_f1"))
    return judged.select("horizon_days", "n", "accuracy", "f1", "roc_auc", "pr_auc").join(best, "horizon_days")


# --- regression and categorical encoding --------------------------------------------------

def temperature_pipeline(
    kind: str, target: str = "next_day_tmin_c", features: Iterable[str] = fv.FEATURES, **overrides
) -> Pipeline:
    """Tomorrow's minimum as a regression target, with a linear model or a forest."""
    features = list(features)
    regressors = {
        "linear": (
            LinearRegression,
            {"maxIter": 50, "regParam": 0.02, "elasticNetParam": 0.2, "solver": "normal"},
        ),
        "forest": (RandomForestRegressor, {"numTrees": 80, "maxDepth": 10, "seed": fv.SEED}),
    }
    if kind not in regressors:
        raise ValueError(f"unknown regressor: {kind}; choose from {sorted(regressors)}")
    make, settings = regressors[kind]
    regressor = make(labelCol=target, featuresCol="features", **{**settings, **overrides})
    return Pipeline(stages=[median_imputer(features), assembler(imputed(features)), regressor])


def encoder(columns: Iterable[str]) -> Pipeline:
    """Index text categories by frequency and one-hot encode them; unseen values get a bucket."""
    columns = list(columns)
    indexed = [f"{c}_index" for c in columns]
    indexer = StringIndexer(inputCols=columns, outputCols=indexed, handleInvalid="keep")
    hot = OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_onehot" for c in columns])
    return Pipeline(stages=[indexer, hot])
