"""Scoring rules and scores on the held-out year."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe.catalog import adapters as data
from rimeframe.catalog.registry import query
from rimeframe.catalog.sql import columns, oracle, r6
from rimeframe.operators import evaluation as ev
from rimeframe.operators import modelling as ml
from rimeframe.operators import ranking as rk


def labelled(spark, folder):
    return ml.labelled(data.gold_days(spark, folder))


def held_out(spark, folder):
    return labelled(spark, folder).filter(F.col("year") == data.TEST_YEAR)


def ruled(spark, folder):
    return ev.with_rule(held_out(spark, folder))


def scored(spark, folder):
    """A probability that falls with today's minimum."""
    return held_out(spark, folder).withColumn("p1", F.lit(1) / (F.lit(1) + F.exp("tmin_c")))


_COUNTS = """select count(*) filter (where label = 0 and prediction = 0) as tn,
    count(*) filter (where label = 0 and prediction = 1) as fp,
    count(*) filter (where label = 1 and prediction = 0) as fn,
    count(*) filter (where label = 1 and prediction = 1) as tp from ruled"""


def _positive(source: str, first: str = "") -> str:
    """Precision, recall and F1 of the frost class from tp, fp and fn."""
    return f"""select {first} tp, fp, fn,
        {r6('coalesce(p, 0)', 'precision')}, {r6('coalesce(r, 0)', 'recall')},
        {r6('case when coalesce(p, 0) + coalesce(r, 0) > 0 then 2 * p * r / (p + r) else 0 end', 'f1')}
        from (select *, tp / nullif(tp + fp, 0)::double as p, tp / nullif(tp + fn, 0)::double as r
          from ({source}))"""


@query("p12_label_cast", oracle(f"select {columns('id date label~')} from labelled", "labelled"))
def p12(spark, folder):
    return labelled(spark, folder).select("id", "date", fv.LABEL)


@query("p15_probability_bins", oracle(
    "select cast(least(floor(p1 * 1000), 999) as int) as bin, count(*) as n "
    "from (select 1 / (1 + exp(tmin_c)) as p1 from labelled) where p1 is not null group by 1", "labelled"))
def p15(spark, folder):
    """The class probability taken out of a model-style vector, then binned; all labelled rows."""
    from pyspark.ml.functions import array_to_vector

    p1 = F.col("p1")
    rows = labelled(spark, folder).withColumn("p1", F.lit(1) / (F.lit(1) + F.exp("tmin_c")))
    with_vector = rows.filter(p1.isNotNull()).withColumn(
        "probability", array_to_vector(F.array(F.lit(1.0) - p1, p1))
    )
    unpacked = ev.frost_probability(with_vector.drop("p1"))
    return unpacked.groupBy(ev.score_bin(p1, 1000).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("p16_frost_rule", oracle(
    "select id, cast(date as varchar) as date, case when tmin_c <= 2.0 then 1.0::double else 0.0::double end "
    "as prediction from labelled", "labelled"))
def p16(spark, folder):
    """The rule on all labelled rows."""
    return ev.with_rule(labelled(spark, folder)).select("id", "date", "prediction")


@query("f7_label_present", oracle(
    "select year, count(*) as n from labelled group by year", "labelled"))
def f7(spark, folder):
    return labelled(spark, folder).groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@query("f8_temporal_split", oracle(
    "select case when year < 2000 then 'train' else 'test' end as split, year, count(*) as n "
    "from labelled where year <= 2000 group by 1, 2", "labelled"))
def f8(spark, folder):
    """Testing on the last year but one: the year after it belongs to neither part."""
    train, test = ml.split_by_year(ml.training_view(data.gold_days(spark, folder)), 2000)
    parts = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )
    return parts.groupBy("split", "year").agg(F.count(F.lit(1)).alias("n"))


@query("a22_confusion", oracle(_COUNTS, "ruled"))
def a22(spark, folder):
    return ev.confusion(ruled(spark, folder))


_METRICS = f"""with c as (select tn::double as tn, fp::double as fp, fn::double as fn,
    tp::double as tp from ({_COUNTS})),
    m as (select *, tn + fp + fn + tp as n, coalesce(tp / nullif(tp + fp, 0), 0) as p1,
      coalesce(tp / nullif(tp + fn, 0), 0) as r1, coalesce(tn / nullif(tn + fn, 0), 0) as p0,
      coalesce(tn / nullif(tn + fp, 0), 0) as r0 from c)
    select {r6('(tn + tp) / n', 'accuracy')},
      {r6('(coalesce(2*p1*r1/nullif(p1+r1,0),0)*(tp+fn) + coalesce(2*p0*r0/nullif(p0+r0,0),0)*(tn+fp)) / n', 'f1')},
      {r6('(p1 * (tp + fn) + p0 * (tn + fp)) / n', 'weighted_precision')},
      {r6('(r1 * (tp + fn) + r0 * (tn + fp)) / n', 'weighted_recall')} from m"""


@query("e2_rule_metrics", oracle("select * from (" + _METRICS + ")", "ruled"))
def e2(spark, folder):
    return ev.classification_metrics(ruled(spark, folder))


@query("e3_frost_class_metrics", oracle(_positive(_COUNTS, "tn,"), "ruled"))
def e3(spark, folder):
    return ev.frost_class_metrics(ruled(spark, folder))


@query("e4_rule_by_threshold", oracle(_positive(" union all ".join(
    f"""select {k} as threshold_c,
    count(*) filter (where coalesce(tmin_c <= {k}, false) and label = 1) as tp,
    count(*) filter (where coalesce(tmin_c <= {k}, false) and label = 0) as fp,
    count(*) filter (where not coalesce(tmin_c <= {k}, false) and label = 1) as fn from ruled"""
    for k in range(4)), "threshold_c,"), "ruled"))
def e4(spark, folder):
    return ev.rule_by_threshold(held_out(spark, folder))


@query("e5_curve_points", oracle(
    f"""select bin, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
    {r6('fp / n_neg::double', 'fpr')}, {r6('tp / n_pos::double', 'tpr')},
    {r6('tp / (tp + fp)::double', 'precision')}
    from (select bin, sum(pos) over (order by bin desc) as tp, sum(neg) over (order by bin desc) as fp,
      sum(pos) over () as n_pos, sum(neg) over () as n_neg
      from (select cast(least(floor(p1 * 1000), 999) as int) as bin,
        count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg
        from scored where p1 is not null group by 1))""", "scored"))
def e5(spark, folder):
    return ev.curve_points(scored(spark, folder))


@query("e6_persistence_auc", oracle(
    f"""select {r6('sum(pos * (all_neg - fp + neg / 2.0::double)) / max(all_pos * all_neg)', 'auc')},
    cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg
    from (select *, sum(neg) over (order by step desc) as fp, sum(pos) over () as all_pos,
      sum(neg) over () as all_neg
      from (select cast(round(-tmin_c / 0.1::double) as bigint) as step,
        count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg
        from labelled where year = 2001 and tmin_c is not null group by 1))""", "labelled"))
def e6(spark, folder):
    return rk.persistence_auc(held_out(spark, folder))


_STEPS = "(values " + ", ".join(f"({t}::double)" for t in fv.PROBABILITY_STEPS) + ") s(threshold)"
_SWEEP = f"""select threshold, count(*) filter (where p1 >= threshold and label = 1) as tp,
    count(*) filter (where p1 >= threshold and label = 0) as fp,
    count(*) filter (where p1 < threshold and label = 1) as fn
    from scored, {_STEPS} where p1 is not null group by threshold"""


@query("e7_threshold_sweep", oracle(_positive(_SWEEP, "threshold,"), "scored"))
def e7(spark, folder):
    return ev.threshold_sweep(scored(spark, folder))


@query("e7_best_threshold", oracle(
    f"select * from ({_positive(_SWEEP, 'threshold,')}) order by f1 desc, threshold limit 1",
    "scored"))
def e7_best(spark, folder):
    """Sweep values are rounded before the best is picked, so near-ties resolve the same way."""
    swept = ev.threshold_sweep(scored(spark, folder))
    return ev.best_threshold(swept.withColumn("f1", F.round("f1", 6)))


@query("e8_mid_latitude_metrics", oracle(
    f"select count(*) as n, {r6('avg(label)', 'base_rate')}, "
    + r6("avg(cast(label = prediction as double))", "accuracy")
    + " from ruled where abs(latitude) between 30 and 55", "ruled"))
def e8(spark, folder):
    band = ev.mid_latitude(ruled(spark, folder))
    return band.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(fv.LABEL).alias("base_rate"),
        F.avg((F.col(fv.LABEL) == F.col("prediction")).cast("double")).alias("accuracy"),
    )


@query("e8_mid_latitude_auc", oracle(
    f"""select {r6('sum(pos * (all_neg - fp + neg / 2.0::double)) / max(all_pos * all_neg)', 'auc')},
    cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg
    from (select *, sum(neg) over (order by step desc) as fp, sum(pos) over () as all_pos,
      sum(neg) over () as all_neg
      from (select cast(round(-tmin_c / 0.1::double) as bigint) as step,
        count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg
        from labelled where year = 2001 and tmin_c is not null
        and abs(latitude) between 30 and 55 group by 1))""", "labelled"))
def e8_auc(spark, folder):
    return rk.persistence_auc(ev.mid_latitude(held_out(spark, folder)))


@query("e9_regression_metrics", oracle(
    f"""select count(*) as n, {r6('sqrt(avg(e * e))', 'rmse')}, {r6('avg(e * e)', 'mse')},
    {r6('avg(abs(e))', 'mae')}, {r6('1 - avg(e * e) / var_pop(y)', 'r2')}
    from (select next_day_tmin_c as y, next_day_tmin_c - tmin_c as e from labels_ahead
      where next_day_tmin_c is not null and tmin_c is not null)""",
    "labels_ahead"))
def e9(spark, folder):
    """Persistence as a temperature forecast, over all years."""
    return ev.regression_metrics(data.gold_days(spark, folder), "next_day_tmin_c", "tmin_c")


@query("e10_class_balance", oracle(
    "select case when year < 2001 then 'train' else 'test' end as split, count(*) as n, "
    f"count(*) filter (where label = 1) as n_pos, {r6('avg(label)', 'positive_rate')} "
    "from labelled group by 1", "labelled"))
def e10(spark, folder):
    return ev.class_balance(labelled(spark, folder), data.TEST_YEAR)


def _areas(source: str, keys: str) -> str:
    """ROC and precision-recall areas of p1 by ``keys``, walking down the distinct scores."""
    return f"""select {keys}, max(all_pos)::bigint as n_pos, max(all_neg)::bigint as n_neg,
      sum(neg * (2 * tp - pos) / 2.0::double) / max(all_pos::double * all_neg) as roc_auc,
      sum(pos * (p + coalesce(p0, p)) / 2) / max(all_pos) as pr_auc, sum(pos * p) / max(all_pos) as average_precision
      from (select *, tp / (tp + fp)::double as p, case when tp + fp - pos - neg > 0
          then (tp - pos) / (tp + fp - pos - neg)::double end as p0
        from (select *, sum(pos) over (partition by {keys} order by p1 desc) as tp,
            sum(neg) over (partition by {keys} order by p1 desc) as fp,
            sum(pos) over (partition by {keys}) as all_pos, sum(neg) over (partition by {keys}) as all_neg
          from (select {keys}, p1, count(*) filter (where label = 1) as pos,
              count(*) filter (where label = 0) as neg
            from {source} where p1 is not null group by all))) group by {keys}"""


_AREA_LIST = ", ".join(r6(x) for x in ("roc_auc", "pr_auc", "average_precision"))
#: A score on a grid of tenths, so that engines agree on its ties, and a prediction of it.
_GRID = """(select *, -round(tmin_c * 10) as p1, case when tmin_c <= 2 then 1.0::double else 0.0::double end
    as prediction, coalesce(abs(latitude) between 38 and 40, false) as band, 0 as one from labelled)"""


def gridded(spark, folder):
    rows = ev.with_rule(labelled(spark, folder))
    band = F.coalesce(F.abs("latitude").between(38, 40), F.lit(False))
    return rows.withColumns({"p1": -F.round(F.col("tmin_c") * 10), "band": band})


@query("e1_six_metrics", oracle(
    f"""select n_pos, n_neg, {_AREA_LIST}, accuracy, f1, weighted_precision, weighted_recall
    from ({_areas(_GRID, 'one')}) cross join ({_METRICS.replace('from ruled', 'from ' + _GRID)})""", "labelled"))
def e1_six(spark, folder):
    """All metrics of a fixed score over all labelled rows; areas are exact."""
    rows = gridded(spark, folder)
    areas = rk.ranking_metrics(rows, F.col("p1")).drop("stratum")
    return areas.join(ev.classification_metrics(rows))


_SETS = {"all": (), "band": ("band",), "year": ("year",), "band+year": ("band", "year")}


def _stratum_sql(name: str, keys: tuple) -> str:
    named = ", ".join(keys) or "one"
    shown = ", ".join(k if k in keys else f"null as {k}" for k in ("band", "year"))
    return f"""select '{name}' as stratum, {shown.replace('band', 'band::int as band', 1) if 'band' in keys else shown},
      {_AREA_LIST}, n, tn, fp, fn, tp from ({_areas(_GRID, named)}) join (
        select {named}, count(*) as n, count(*) filter (where label = 0 and prediction = 0) as tn,
          count(*) filter (where label = 0 and prediction = 1) as fp,
          count(*) filter (where label = 1 and prediction = 0) as fn,
          count(*) filter (where label = 1 and prediction = 1) as tp from {_GRID} group by all) using ({named})"""


@query("e8_strata", oracle(
    " union all ".join(_stratum_sql(name, keys) for name, keys in _SETS.items()), "labelled"))
def e8_strata(spark, folder):
    """Whole table, latitude band, year, and both, from one pass over the rows."""
    found = rk.strata_metrics(gridded(spark, folder), F.col("p1"), list(_SETS.values()))
    return found.select("stratum", "band", "year", "roc_auc", "pr_auc", "average_precision",
                        "n", "tn", "fp", "fn", "tp")
