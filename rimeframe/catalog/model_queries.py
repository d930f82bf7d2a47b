"""Feature views and fitted models.

Training data is staged once in the shared folder: fits read it many times, and a written
table survives lost executors.  All queries use the full model settings, and every held-out row is scored.
``m9_boosted_grid``, ``m12_feature_importances`` and ``e8_fitted_model_by_band`` learn from about
``TRAINING_ROWS`` labelled rows (a bound on the fit, by a hash of the row), all others from every row.
"""

from __future__ import annotations

from functools import partial

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.catalog import adapters as data
from rimeframe.catalog.registry import query
from rimeframe.catalog.sql import columns, oracle, r6
from rimeframe.functions.sampling import hash_point
from rimeframe.operators import evaluation as ev
from rimeframe.operators import folds as fo
from rimeframe.operators import medians as md
from rimeframe.operators import modelling as ml
from rimeframe.operators import ranking as rk
from rimeframe.storage import fresh_path, stage

TRAINING_ROWS = 20_000
THREADS = 4

WHOLE = ("day_of_year", "month", "frost_days_roll30")
FEATURE_LIST = " ".join(f if f in WHOLE else f + "~" for f in fv.FEATURES)


def view(spark, folder):
    return ml.training_view(data.gold_days(spark, folder))


def staged_parts(spark, folder):
    return ml.split_by_year(stage(view(spark, folder), "training"), data.TEST_YEAR)


def bounded_parts(spark, folder):
    train, test = staged_parts(spark, folder)
    return stage(ml.bounded(train, TRAINING_ROWS), "bounded"), test


def predictions(model, test):
    return ev.frost_probability(model.transform(test)).select("year", fv.LABEL, "prediction", "p1")


# --- views and preparation ----------------------------------------------------------------

@query("m1_training_view", oracle(
    f"select year, {columns('label~ ' + FEATURE_LIST)} from labelled", "labelled"))
def m1(spark, folder):
    return view(spark, folder)


_NULLS = " union all ".join(
    f"select '{f}' as feature, count(*) as n, count(*) filter (where {f} is null) as n_missing, "
    "cast(0 as bigint) as n_left from labelled where year < 2001" for f in fv.FEATURES
)


@query("m2_median_imputer", oracle(_NULLS, "labelled"))
def m2(spark, folder):
    """Missing values per feature before and after imputation with medians of the train part."""
    train, _ = staged_parts(spark, folder)
    filled = ml.median_imputer(fv.FEATURES).fit(train).transform(train)

    def missing(name):
        return F.count_if(F.col(name).isNull() | F.isnan(F.col(name).cast("double")))

    counted = filled.agg(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.count(F.lit(1)).alias("n"),
                missing(f).alias("n_missing"),
                missing(f"{f}__imp").alias("n_left"),
            ).alias(f)
            for f in fv.FEATURES
        ]
    )
    return counted.select(F.inline(F.array(*fv.FEATURES)))


_MEDIANS = " union all ".join(
    f"select '{f}' as feature, count({f}) as n, {r6(f'quantile_disc({f}, 0.5)::double', 'median')} "
    "from labelled where year < 2001" for f in fv.FEATURES
)


@query("m2_exact_medians", oracle(_MEDIANS, "labelled"))
def m2_exact(spark, folder):
    """The medians themselves, exactly, of all features of the train part."""
    train, _ = staged_parts(spark, folder)
    return md.exact_medians(train, fv.FEATURES)


@query("m3_vector_assembly", oracle(
    "select year, count(*) as n, cast(30 * count(*) as bigint) as n_entries, "
    "cast(sum(" + " + ".join(f"cast({f} is null as int)" for f in fv.FEATURES)
    + ") as bigint) as n_invalid from labelled group by year", "labelled"))
def m3(spark, folder):
    """Assembled vectors keep rows with missing entries (as NaN)."""
    vectors = ml.assembler(fv.FEATURES).transform(view(spark, folder))
    entries = vectors.select("year", vector_to_array("features").alias("entries"))
    return entries.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.size("entries")).cast("bigint").alias("n_entries"),
        F.sum(F.size(F.filter("entries", F.isnan))).cast("bigint").alias("n_invalid"),
    )


_SCALED = ("day_of_year", "month", "gdd_corn_day")


@query("m4_standard_scaler", oracle(
    f"select {columns('id date')}, " + ", ".join(
        r6(f"{f} / stddev_samp({f}) over ()", f"{f}_scaled") for f in _SCALED
    ) + " from gold where gdd_corn_day is not null", "gold"))
def m4(spark, folder):
    """Division by the standard deviation, without centring."""
    days = data.gold_days(spark, folder).filter(F.col("gdd_corn_day").isNotNull())
    vectors = stage(days.select("id", "date", *_SCALED), "scaling")
    vectors = ml.assembler(_SCALED).transform(vectors)
    scaled = ml.scaler().fit(vectors).transform(vectors)
    entries = vector_to_array("features_scaled")
    return scaled.select(
        "id", "date", *[entries[i].alias(f"{f}_scaled") for i, f in enumerate(_SCALED)]
    )


@query("m17_categorical_encoding", oracle(
    "select state, count(*) as n, cast(row_number() over (order by count(*) desc, state) - 1 "
    "as double) as state_index from silver group by state", "silver"))
def m17(spark, folder):
    """States indexed by frequency; the hot position of the encoded vector is the index."""
    days = stage(data.silver_days(spark, folder).select("id", "state"), "states")
    encoded = ml.encoder(["state"]).fit(days).transform(days)
    hot = vector_to_array("state_onehot")
    return (
        encoded.select("state", (F.array_position(hot, F.lit(1.0)) - 1).cast("double").alias("at"))
        .groupBy("state", F.col("at").alias("state_index"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _point(keys: str, seed: int) -> str:
    text = f"concat_ws('|', '{seed}', {keys})"
    return f"cast(('0x' || substr(md5({text}), 1, 8)) as bigint) / 4294967296.0::double"


@query("o5_random_split", oracle(
    "select id, cast(date as varchar) as date, case when "
    f"{_point('id, cast(date as varchar)', 42)} < 0.7 then 'train' else 'test' end as split "
    "from silver", "silver"))
def o5(spark, folder):
    """A 70/30 split decided per row key, so it is the same on every run and layout."""
    point = hash_point([F.col("id"), F.col("date")], seed=42, portable=True)
    return data.silver_days(spark, folder).select(
        "id", "date", F.when(point < 0.7, "train").otherwise("test").alias("split")
    )


# --- fitted models ------------------------------------------------------------------------

@query("m5_gradient_boosted_trees")
def m5(spark, folder):
    train, test = staged_parts(spark, folder)
    return predictions(ml.frost_pipeline("gbt").fit(train), test)


@query("m6_random_forest")
def m6(spark, folder):
    train, test = staged_parts(spark, folder)
    return predictions(ml.frost_pipeline("rf").fit(train), test)


@query("m7_logistic_regression")
def m7(spark, folder):
    train, test = staged_parts(spark, folder)
    return predictions(ml.frost_pipeline("lr").fit(train), test)


_CHAINS = {
    "gbt": ("ImputerModel", "VectorAssembler", "GBTClassificationModel"),
    "rf": ("ImputerModel", "VectorAssembler", "RandomForestClassificationModel"),
    "lr": ("ImputerModel", "VectorAssembler", "StandardScalerModel", "LogisticRegressionModel"),
}


@query("m8_stage_composition", "select * from (values " + ", ".join(
    f"('{name}', {at}, '{kind}')"
    for name, chain in _CHAINS.items() for at, kind in enumerate(chain)
) + ") s(algorithm, position, stage)")
def m8(spark, folder):
    """Stages of every algorithm's estimator chain, fitted on the training part."""
    train, _ = staged_parts(spark, folder)
    jobs = {name: partial(ml.frost_pipeline(name).fit, train) for name in _CHAINS}
    rows = [
        (name, position, type(fitted).__name__)
        for name, model in ml.side_by_side(spark, jobs, ml.fits_at_once(train, THREADS)).items()
        for position, fitted in enumerate(model.stages)
    ]
    return spark.createDataFrame(rows, "algorithm STRING, position INT, stage STRING")


@query("m9_parameter_grid")
def m9(spark, folder):
    """Each combination of the linear grid, judged on the held-out year."""
    train, test = staged_parts(spark, folder)
    return _grid_scores(spark, train, test, "lr")


def _grid_scores(spark, train, test, algorithm):
    estimator = ml.frost_pipeline(algorithm)
    grid = {
        ", ".join(f"{p.name}={v}" for p, v in params.items()): params
        for params in ml.parameter_grid(algorithm, estimator.getStages()[-1])
    }
    return ml.metrics_table(spark, ml.grid_scores(train, test, estimator, grid, THREADS))


@query("m9_boosted_grid")
def m9_gbt(spark, folder):
    """Each combination of the boosted grid."""
    return _grid_scores(spark, *bounded_parts(spark, folder), "gbt")


@query("m9_forest_grid")
def m9_rf(spark, folder):
    """Each combination of the forest grid."""
    return _grid_scores(spark, *staged_parts(spark, folder), "rf")


@query("m10_random_folds")
def m10_random(spark, folder):
    """All linear combinations over three seeded random folds."""
    train, _ = staged_parts(spark, folder)
    return ml.tuning_scores(spark, ml.tune(train, "lr", parallelism=THREADS))


GAP_DAYS = 7

_FOLDS_SQL = f"""
    select f.fold, cast(f.start as varchar) as first_day,
      cast(f.stop - interval 1 day as date)::varchar as last_day,
      count(*) filter (where label_date < f.start - interval {GAP_DAYS} day) as n_train,
      count(*) filter (where v.date >= f.start and v.date < f.stop) as n_judged,
      max(label_date) filter (where label_date < f.start - interval {GAP_DAYS} day)::varchar as last_label
    from (select *, cast(lead(date) over (partition by id order by date) as date) as label_date from gold) v
    join (select part - 1 as fold, start, coalesce(lead(start) over (order by part), (
          select cast(max(date) + interval 1 day as date) from gold where next_day_is_frost is not null)) as stop
      from (select cast(floor(before * 4 / total) as int) as part, min(date) as start
        from (select date, sum(count(*)) over (order by date) - count(*) as before,
            sum(count(*)) over () as total
          from gold where next_day_is_frost is not null group by date) group by 1)) f on f.fold >= 0
    where v.next_day_is_frost is not null group by f.fold, f.start, f.stop"""


@query("m10_forward_folds", oracle(_FOLDS_SQL, "gold"))
def m10_folds(spark, folder):
    """Expanding training parts, and a week between their last label and the first judged day."""
    view = stage(fo.dated_view(data.gold_days(spark, folder), 1, ["tmin_c"]), "dated")
    return fo.fold_sizes(view, fo.fold_starts(view, 3), GAP_DAYS)


@query("m10_forward_tuning")
def m10_forward(spark, folder):
    """All linear combinations on folds that look forward, with the exact area of each."""
    view = stage(fo.dated_view(data.gold_days(spark, folder)), "dated")
    return fo.tune_forward(view, "lr", 3, GAP_DAYS, parallelism=THREADS).scores


@query("m10_cross_validation")
def m10(spark, folder):
    """All six linear combinations over three folds of whole years."""
    train, _ = staged_parts(spark, folder)
    folded = ml.year_folds(train)
    return ml.tuning_scores(spark, ml.tune(folded, "lr", parallelism=THREADS, fold_column="fold"))


@query("m11_saved_model")
def m11(spark, folder):
    """Predictions of a model that was saved and loaded again."""
    train, test = staged_parts(spark, folder)
    path = fresh_path(spark, "model")
    ml.frost_pipeline("lr").fit(train).write().overwrite().save(path)
    return predictions(PipelineModel.load(path), test)


@query("m12_feature_importances")
def m12(spark, folder):
    train, _ = bounded_parts(spark, folder)
    return ml.top_features(spark, ml.frost_pipeline("rf").fit(train))


@query("m13_model_comparison")
def m13(spark, folder):
    train, test = staged_parts(spark, folder)
    return ml.metrics_table(spark, ml.compare(train, test, parallelism=THREADS))


@query("m14_ablation_without_rain")
def m14(spark, folder):
    train, test = staged_parts(spark, folder)
    return ml.metrics_table(spark, ml.ablation(train, test, parallelism=THREADS))


@query("m15_horizon_skill")
def m15(spark, folder):
    """One boosted model for each of the fifteen horizons."""
    view = stage(ml.horizon_view(data.gold_days(spark, folder)), "horizons")
    return ml.horizon_skill(view, data.TEST_YEAR, parallelism=THREADS)


@query("m15_shared_horizons")
def m15_shared(spark, folder):
    """One boosted model for all horizons, judged for each of them from one scored table."""
    view = stage(ml.horizon_view(data.gold_days(spark, folder)), "horizons")
    train, test = ml.split_by_year(view, data.TEST_YEAR)
    return ml.shared_horizon_skill(train, test)


@query("e8_fitted_model_by_band")
def e8_fitted(spark, folder):
    """A boosted model judged on the middle latitudes, elsewhere and by year, from one scored table."""
    train, test = bounded_parts(spark, folder)
    scored = ev.frost_probability(ml.frost_pipeline("gbt").fit(train).transform(test))
    named = scored.withColumn("mid_latitude", ev.space.in_latitude_band(F.col("latitude")))
    rows = stage(named.select("year", "mid_latitude", fv.LABEL, "prediction", "p1"), "scored")
    return rk.strata_metrics(rows, F.col("p1"), [[], ["mid_latitude"], ["year"]])


def _temperatures(spark, folder):
    days = data.gold_days(spark, folder).filter(F.col("next_day_tmin_c").isNotNull())
    staged = stage(days.select("year", "next_day_tmin_c", *fv.FEATURES), "temperatures")
    return ml.split_by_year(staged, data.TEST_YEAR)


@query("m16_linear_temperature")
def m16_linear(spark, folder):
    train, test = _temperatures(spark, folder)
    scored = ml.temperature_pipeline("linear").fit(train).transform(test)
    return ev.regression_metrics(scored, "next_day_tmin_c", "prediction")


@query("m16_forest_temperature")
def m16_forest(spark, folder):
    train, test = _temperatures(spark, folder)
    scored = ml.temperature_pipeline("forest").fit(train).transform(test)
    return ev.regression_metrics(scored, "next_day_tmin_c", "prediction")


@query("e1_model_metrics")
def e1(spark, folder):
    train, test = staged_parts(spark, folder)
    scores = ev.evaluate(ml.frost_pipeline("lr").fit(train).transform(test))
    return ml.metrics_table(spark, {"lr": scores})
