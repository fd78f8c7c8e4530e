import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from threadlens.operators import metrics, models, sentiment, summary


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    label = rng.integers(0, 3, 4000)
    guess = np.where(rng.random(4000) < 0.6, label, rng.integers(0, 4, 4000))
    score = np.clip((label == 1) * 0.3 + rng.random(4000), 0, 1).round(3)
    rows = [(float(a), float(b), float(c)) for a, b, c in zip(label, guess, score)]
    return spark.createDataFrame(rows, "label double, prediction double, score double").cache()


def test_class_metrics_match_the_library(scored):
    row = metrics.class_metrics(scored).first()
    names = {"accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "f1": "f1"}
    for mine, theirs in names.items():
        want = MulticlassClassificationEvaluator(metricName=theirs).evaluate(scored)
        assert np.isclose(row[mine], want, rtol=1e-12)


def test_regression_metrics_match_the_library(scored):
    row = metrics.regression_metrics(scored).first()
    for name in ("r2", "mse", "rmse", "mae"):
        assert np.isclose(row[name], RegressionEvaluator(metricName=name).evaluate(scored), rtol=1e-9)


def test_confusion_counts_every_row(scored):
    rows = metrics.confusion_matrix(scored, [0.0, 1.0, 2.0, 3.0]).collect()
    assert sum(r[f"predicted_{c}"] for r in rows for c in range(4)) == scored.count()


def test_roc_against_brute_force(scored):
    long = metrics.one_vs_rest(scored, "label", {1: F.col("score")})
    got = {r.score: (r.fpr, r.tpr) for r in metrics.roc_points(long, "score", "positive", ["class"]).collect()}
    pdf = scored.toPandas()
    positive = pdf.label == 1
    assert len(got) == pdf.score.nunique()
    for cut, (fpr, tpr) in got.items():
        above = pdf.score >= cut
        assert np.isclose(fpr, (above & ~positive).sum() / (~positive).sum())
        assert np.isclose(tpr, (above & positive).sum() / positive.sum())


def test_two_class_reading(scored):
    points = metrics.roc_points(metrics.at_least_one(scored, "label", F.col("score")), "score", "positive")
    last = points.orderBy("score").first()
    assert (last.fpr, last.tpr) == (1.0, 1.0)


def test_model_tables(scored):
    frames = {m: metrics.regression_metrics(scored) for m in ("a", "b")}
    by_row = metrics.compare_models(frames, ["r2", "mse"])
    turned = metrics.metrics_by_model(by_row, ["a", "b"], ["r2", "mse"]).collect()
    assert by_row.count() == 2 and {r.metric for r in turned} == {"r2", "mse"}
    assert all(r.a == r.b for r in turned)


def test_default_sizes_are_the_studys():
    found = models.parameters(models.forest("y"))
    assert (found["numTrees"], found["impurity"], found["seed"]) == (1000, "gini", 42)
    tree, boosted = models.parameters(models.decision_tree("y")), models.parameters(models.boosted_trees("y"))
    assert (tree["maxDepth"], tree["maxBins"], tree["impurity"]) == (10, 25, "variance")
    assert (boosted["maxIter"], boosted["stepSize"], boosted["maxDepth"]) == (10, 0.15, 10)
    assert boosted["featureSubsetStrategy"] == "all"


# Published counts of comments by topic and sentiment, and their shares.
TOPICS = {
    "climate": (1227, 100, 755, 58.933717579250725, 36.263208453410186),
    "economy": (6353, 389, 3016, 65.10555441688871, 30.90797294527567),
    "healthcare": (8460, 535, 3906, 65.57631191380513, 30.27672273467173),
    "police": (13158, 845, 5792, 66.47133114422834, 29.259914119727203),
}


def test_topic_shares_match_the_published_table(spark):
    rows = [
        (s, *(t == topic for t in TOPICS), n)
        for topic, counts in TOPICS.items()
        for s, n in zip(("negative", "neutral", "positive"), counts)
    ]
    flags = [f"dummy_{t}" for t in TOPICS]
    schema = "sentiment string, " + ", ".join(f"{f} boolean" for f in flags) + ", n int"
    df = spark.createDataFrame(rows, schema).withColumn("_", F.explode(F.sequence(F.lit(1), "n")))
    for r in sentiment.topic_share(df, flags).collect():
        negative, neutral, positive, low, high = TOPICS[r.topic]
        assert (r.negative, r.neutral, r.positive) == (negative, neutral, positive)
        assert np.isclose(r.pct_negative, low) and np.isclose(r.pct_positive, high)


def test_polarization_without_a_class(spark):
    rows = [("a", "positive"), ("a", "positive"), ("a", "negative"), ("b", "negative")]
    df = spark.createDataFrame(rows, "subreddit string, sentiment string")
    plain = {r.subreddit: r.polarization_score for r in sentiment.polarization(df).collect()}
    filled = {r.subreddit: r.polarization_score for r in sentiment.polarization(df, absent_as_zero=True).collect()}
    assert plain == {"a": 1, "b": None} and filled == {"a": 1, "b": -1}


def test_score_of_missing_text_and_margin(spark):
    df = spark.createDataFrame([(1, "good good bad"), (2, None), (3, "plain"), (4, "bad")], "id int, t string")
    words = {"good": 1.0, "bad": -1.0}
    got = {r.id: r.sentiment for r in sentiment.score_texts(df, "t", words).collect()}
    assert got == {1: "positive", 2: None, 3: "neutral", 4: "negative"}
    wide = {r.id: r.sentiment for r in sentiment.score_texts(df, "t", words, margin=1.0).collect()}
    assert wide[1] == wide[4] == "neutral"


def test_topic_shares_without_a_class(spark):
    df = spark.createDataFrame([("negative", True)] * 2 + [("positive", True)], "sentiment string, dummy_a boolean")
    row = sentiment.topic_share(df, ["dummy_a"]).first()
    assert (row.neutral, round(row.pct_negative, 2)) == (0, 66.67)
    assert sentiment.topic_share(df, ["dummy_a"], absent_as_zero=False).first().pct_negative is None


def test_nan_is_no_measurement(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0), ("a", None)], "g string, v double")
    row = summary.describe_by(df, ["g"], ["v"]).first()
    assert (row["count"], row["mean"], row.q50, row["max"]) == (2, 2.0, 2.0, 3.0)
