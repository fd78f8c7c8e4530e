"""Model quality as tables, each from one aggregation over the predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.operators.ranks import running_totals
from threadlens.operators.reshape import stack_frames
from threadlens.operators.summary import count_by, ratio


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: r2, mse, rmse, mae."""
    error = F.col(label) - F.col(prediction)
    sums = df.agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(label).alias("spread"),
    )
    return sums.select(
        (1 - ratio(F.col("mse"), F.col("spread"))).alias("r2"),
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
    )


def confusion_cells(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return count_by(df, label, prediction)


def confusion_matrix(
    df: DataFrame, classes: Sequence, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per label, one ``predicted_<class>`` column per class, 0 where empty."""
    table = (
        confusion_cells(df, label, prediction)
        .groupBy(label)
        .pivot(prediction, list(classes))
        .agg(F.sum("count"))
        .na.fill(0)
    )
    return table.withColumnsRenamed({str(c): f"predicted_{str(c).removesuffix('.0')}" for c in classes})


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, weighted precision, weighted recall, weighted F1."""
    cells = confusion_cells(df, label, prediction).select(
        F.col(label).alias("a"), F.col(prediction).alias("p"), "count"
    )
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("a") == F.col("p"), F.col("count")).otherwise(zero)
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("a").alias("class"),
                    F.col("count").alias("actual"),
                    zero.alias("predicted"),
                    hit.alias("hits"),
                ),
                F.struct(
                    F.col("p").alias("class"),
                    zero.alias("actual"),
                    F.col("count").alias("predicted"),
                    zero.alias("hits"),
                ),
            )
        )
    )
    per_class = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
    precision = F.coalesce(ratio(F.col("hits"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(ratio(F.col("hits"), F.col("actual")), F.lit(0.0))
    f1 = F.coalesce(ratio(2 * precision * recall, precision + recall), F.lit(0.0))
    total = F.sum("actual")
    return per_class.agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(precision * F.col("actual")) / total).alias("weighted_precision"),
        (F.sum(recall * F.col("actual")) / total).alias("weighted_recall"),
        (F.sum(f1 * F.col("actual")) / total).alias("f1"),
    )


def roc_points(df: DataFrame, score: str, positive: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, score, fpr, tpr): one point per distinct score, scores from high to low.

    ``positive`` is a boolean column. Equal scores are folded first; the running sums
    never sort a whole group in one task. The corner points (0,0) and (1,1) are implied.
    """
    folded = df.groupBy(*keys, (-F.col(score)).alias("_order")).agg(
        F.count_if(F.col(positive)).alias("pos"), F.count_if(~F.col(positive)).alias("neg")
    )
    summed = running_totals(folded.filter("pos + neg > 0"), keys, "_order", ["pos", "neg"])
    return summed.select(
        *keys,
        (-F.col("_order")).alias("score"),
        ratio(F.col("before_neg") + F.col("neg"), F.col("total_neg")).alias("fpr"),
        ratio(F.col("before_pos") + F.col("pos"), F.col("total_pos")).alias("tpr"),
    )


def one_vs_rest(df: DataFrame, label: str, scores: Mapping[int, Column]) -> DataFrame:
    """(class, score, positive): every row once per class, scored for that class."""
    entries = [
        F.struct(
            F.lit(c).alias("class"),
            score.cast("double").alias("score"),
            (F.col(label) == c).alias("positive"),
        )
        for c, score in scores.items()
    ]
    return df.select(F.inline(F.array(*entries)))


def at_least_one(df: DataFrame, label: str, score: Column) -> DataFrame:
    """The study's two-class reading of a class index: any index from 1 up is positive."""
    return df.select(score.cast("double").alias("score"), (F.col(label) >= 1).alias("positive"))


def prediction_counts(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    return count_by(df, prediction)


def compare_models(metrics: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """One row per model from one-row metric frames."""
    return stack_frames(
        [frame.select(F.lit(model).alias("model"), *names) for model, frame in metrics.items()]
    )


def metrics_by_model(compared: DataFrame, models: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The same table turned: one row per metric, one column per model."""
    long = compared.unpivot(["model"], list(names), "metric", "value")
    return long.groupBy("metric").pivot("model", list(models)).agg(F.max("value"))
