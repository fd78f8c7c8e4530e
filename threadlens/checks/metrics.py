"""Quality measures on fixed rules that stand in for a model's predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.checks.registry import query, rounded, table
from threadlens.operators import metrics

GUESSES = """guesses as (
  select (strpos('FOP', o_orderstatus) - 1)::double as label, (o_orderkey % 3)::double as prediction,
    floor(o_totalprice / 50) / 10000.0 as p0, 1 - floor(o_totalprice / 50) / 10000.0 as p1,
    (o_custkey % 100) / 100.0::double as p2
  from orders)"""

PRICES = """prices as (
  select l_extendedprice as label, l_quantity * 1500 as flat, l_quantity * 1400 + 2000 as bent
  from lineitem)"""


def guesses(spark, folder):
    high = F.floor(F.col("o_totalprice") / 50) / F.lit(10000.0)
    return table(spark, folder, "orders").select(
        (F.instr(F.lit("FOP"), F.col("o_orderstatus")) - 1).cast("double").alias("label"),
        (F.col("o_orderkey") % 3).cast("double").alias("prediction"),
        high.alias("p0"),
        (1 - high).alias("p1"),
        ((F.col("o_custkey") % 100) / F.lit(100.0)).alias("p2"),
    )


def price_guesses(spark, folder, rule):
    quantity = F.col("l_quantity")
    guess = {"flat": quantity * 1500, "bent": quantity * 1400 + 2000}[rule]
    return table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("label"), guess.alias("prediction")
    )


def _regression_sql(rule: str) -> str:
    error = f"(label - {rule})"
    return f"""select '{rule}' as model, round(1 - avg({error} * {error}) / var_pop(label), 6) as r2,
  round(avg({error} * {error}), 2) as mse, round(sqrt(avg({error} * {error})), 4) as rmse,
  round(avg(abs({error})), 4) as mae from prices"""


def compared(spark, folder):
    rows = {r: metrics.regression_metrics(price_guesses(spark, folder, r)) for r in ("flat", "bent")}
    table_ = metrics.compare_models(rows, ["r2", "mse", "rmse", "mae"])
    return table_.withColumns(rounded(6, "r2") | rounded(2, "mse") | rounded(4, "rmse", "mae"))


@query(f"with {PRICES}, m as ({_regression_sql('flat')}) select r2, mse, rmse, mae from m")
def reg_metrics(spark, folder):
    found = metrics.regression_metrics(price_guesses(spark, folder, "flat"))
    return found.withColumns(rounded(6, "r2") | rounded(2, "mse") | rounded(4, "rmse", "mae"))


@query(f"""with {PRICES}, m as ({_regression_sql('flat')} union all {_regression_sql('bent')})
select metric, max(value) filter (where model = 'flat') as flat, max(value) filter (where model = 'bent') as bent
from (unpivot m on r2, mse, rmse, mae into name metric value value) group by metric""")
def model_compare(spark, folder):
    return metrics.metrics_by_model(
        compared(spark, folder), ["flat", "bent"], ["r2", "mse", "rmse", "mae"]
    )


@query(f"""with {GUESSES}, classes as (select unnest([0.0, 1.0, 2.0])::double as c),
per as (select c, count(*) filter (where label = c) as actual, count(*) filter (where prediction = c) as predicted,
  count(*) filter (where label = c and prediction = c) as hits from guesses, classes group by c),
rates as (select *, coalesce(hits / nullif(predicted, 0), 0) as pr, coalesce(hits / nullif(actual, 0), 0) as re from per)
select round(sum(hits) / sum(actual), 6) as accuracy,
  round(sum(pr * actual) / sum(actual), 6) as weighted_precision,
  round(sum(re * actual) / sum(actual), 6) as weighted_recall,
  round(sum(coalesce(2 * pr * re / nullif(pr + re, 0), 0) * actual) / sum(actual), 6) as f1 from rates""")
def class_metrics(spark, folder):
    found = metrics.class_metrics(guesses(spark, folder))
    return found.withColumns(rounded(6, *found.columns))


@query(f"""with {GUESSES} select label, count(*) filter (where prediction = 0) as predicted_0,
  count(*) filter (where prediction = 1) as predicted_1, count(*) filter (where prediction = 2) as predicted_2
from guesses group by label""")
def confusion(spark, folder):
    return metrics.confusion_matrix(guesses(spark, folder), [0.0, 1.0, 2.0])


@query(f"with {GUESSES} select prediction, count(*) as count from guesses group by prediction")
def pred_dist(spark, folder):
    return metrics.prediction_counts(guesses(spark, folder))


def _roc_sql(keys: str, partition: str) -> str:
    return f"""folded as (select {keys} score, count(*) filter (where positive) as pos,
  count(*) filter (where not positive) as neg from long group by all)
select distinct {keys} score,
  round(sum(neg) over (partition by {partition} order by score desc)
    / nullif(sum(neg) over (partition by {partition}), 0), 6) as fpr,
  round(sum(pos) over (partition by {partition} order by score desc)
    / nullif(sum(pos) over (partition by {partition}), 0), 6) as tpr from folded"""


@query(f"""with {GUESSES}, long as (
  select 0 as class, p0 as score, label = 0 as positive from guesses
  union all select 1, p1, label = 1 from guesses union all select 2, p2, label = 2 from guesses),
{_roc_sql("class::bigint as class,", "class")}""")
def roc_ovr(spark, folder):
    found = guesses(spark, folder)
    long = metrics.one_vs_rest(found, "label", {c: F.col(f"p{c}") for c in range(3)})
    points = metrics.roc_points(long, "score", "positive", ["class"])
    return points.withColumns(rounded(6, "fpr", "tpr")).withColumn("class", F.col("class").cast("bigint"))


@query(f"""with {GUESSES}, long as (select p1 as score, label >= 1 as positive from guesses),
{_roc_sql("", "true")}""")
def roc_two_class(spark, folder):
    long = metrics.at_least_one(guesses(spark, folder), "label", F.col("p1"))
    return metrics.roc_points(long, "score", "positive").withColumns(rounded(6, "fpr", "tpr"))


@query(f"with {PRICES} select label, flat as prediction from prices")
def predicted_pairs(spark, folder):
    from threadlens.operators.models import predicted_and_actual

    return predicted_and_actual(price_guesses(spark, folder, "flat"), "label")
