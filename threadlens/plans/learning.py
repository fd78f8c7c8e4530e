"""Training sets, the two regressors, the two forests, and their comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators import cleaning, corpus, features, metrics, models, sampling, trees
from threadlens.plans.engagement import COMMUNITIES
from threadlens.sources.tables import stage

REGRESSION_METRICS = ["r2", "mse", "rmse", "mae"]
CLASS_METRICS = ["accuracy", "weighted_recall", "weighted_precision", "f1"]
FORESTS = {
    "Hyperparameter Set #1": {"trees": 1000, "impurity": "gini", "seed": 42},
    "Hyperparameter Set #2": {"trees": 500, "impurity": "entropy", "seed": 5},
}


def regression_set(titles: DataFrame, ident: str = "id", **options):
    """Fitted TF-IDF of the raw titles, and rows of indicators and features."""
    rows = cleaning.drop_null_rows(titles.select(ident, "DOW", "CPI", "Unemp_Rate", "title"))
    model = features.fit_tfidf(rows, "title", **options)
    kept = model.transform(rows).select(ident, "DOW", "CPI", "Unemp_Rate", "features")
    return model, stage(kept, "title-indicators")


def community_set(
    texts: DataFrame, text: str, ident: str = "id", communities: Sequence[str] = COMMUNITIES, **options
) -> DataFrame:
    """Equally many cleaned texts per community as features. Texts are cleaned once."""
    rows = cleaning.drop_null_rows(texts.select(ident, "subreddit", text))
    balanced = sampling.balance_classes(rows, "subreddit", ident, groups=communities)
    cleaned = stage(corpus.clean_column(balanced, text), "clean-texts")
    model = features.fit_tfidf(cleaned, text, **options)
    return stage(model.transform(cleaned).select(ident, "subreddit", "features"), "communities")


def run_regressions(rows: DataFrame, label: str = "DOW", ident: str = "id", **sizes):
    """Both regressors on the same split: fitted models, predictions, comparison table."""
    train, test = sampling.hash_split(rows, ident)
    estimators = {
        "Decision Tree": models.decision_tree(label),
        "Gradient Boost": models.boosted_trees(label, **sizes),
    }
    fitted = {name: trees.fit_trees(estimator, train) for name, estimator in estimators.items()}
    found = {name: models.predicted_and_actual(m.transform(test), label) for name, m in fitted.items()}
    table = metrics.compare_models(
        {name: metrics.regression_metrics(df) for name, df in found.items()}, REGRESSION_METRICS
    )
    return fitted, found, table


def run_forests(rows: DataFrame, ident: str = "id", forests: Mapping[str, Mapping] = FORESTS):
    """The forests on the same split: fitted pipelines, staged predictions, comparison."""
    train, test = sampling.hash_split(rows, ident)
    fitted = {name: models.fit_forest(train, "subreddit", **options) for name, options in forests.items()}
    found = {}
    for name, model in fitted.items():
        scored = model.transform(test).withColumn("scores", vector_to_array("probability"))
        found[name] = stage(scored.select("label_ix", "prediction", "predicted_label", "scores"), "scored")
    table = metrics.compare_models(
        {name: metrics.class_metrics(df, "label_ix") for name, df in found.items()}, CLASS_METRICS
    )
    return fitted, found, table


def roc_tables(predictions: DataFrame, classes: int = 3) -> dict[str, DataFrame]:
    """One curve per class, and the study's own two-class curve."""
    scores = {c: F.get("scores", F.lit(c)) for c in range(classes)}
    each = metrics.one_vs_rest(predictions, "label_ix", scores)
    two = metrics.at_least_one(predictions, "label_ix", F.get("scores", F.lit(1)))
    return {
        "one_vs_rest": metrics.roc_points(each, "score", "positive", ["class"]),
        "two_class": metrics.roc_points(two, "score", "positive"),
    }
