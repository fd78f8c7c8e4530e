"""What the model queries learn from and try."""

import compare
import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Observation
from pyspark.sql import functions as F
from threadlens.checks import models as checks
from threadlens.checks.registry import table
from threadlens.operators import embedding, features, models, sampling, trees


def test_forests_try_every_row_whatever_they_are_fitted_on(spark, folder, monkeypatch):
    monkeypatch.setattr(checks, "PER_CLASS", 3)
    found = checks.forest_facts(spark, folder, trees=5, impurity="gini", seed=42).first()
    rows, named, largest, *_ = compare.connect(folder).execute(checks.FOREST_SQL).fetchone()
    assert (found.test_rows, found.named_rows, found.largest_class) == (rows, named, largest)


def test_terms_and_trees_learn_from_all_training_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(checks, "FIT_ROWS", 10, raising=False)
    docs, _ = sampling.hash_split(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    lists = [r.w for r in docs.select(features.spark_tokens("text").alias("w")).collect()]
    text_model, _, learned, _ = checks.regression_run(spark, folder, models.decision_tree("target", depth=2))
    assert set(features.vocabulary_of(text_model)) == {w for some in lists for w in some}
    assert text_model.stages[-1].numDocs == learned.count() == len(lists) > 10
    assert learned.rdd.getNumPartitions() > 1


def test_vectors_of_the_most_frequent_words(spark, monkeypatch):
    rows = [(k, "good fine day" if k % 4 else "bad awful rot", float(k % 4 == 0)) for k in range(80)]
    rows += [(100, None, 1.0), (101, "", 0.0), (102, "unseen", 0.0), (103, "good", None)]
    df = spark.createDataFrame(rows, "id int, text string, label double")
    embedding = models.train_embedding(df, "text", size=4)
    model = models.train_embedded_sentiment(embedding, df.filter("id < 80 or id = 100 or id = 103"), "text", "label")
    found = {r.id: r.sentiment for r in models.trained_sentiment(model, df, "text").collect()}
    assert len(found) == len(rows) and found[100] is None
    assert {found[k] for k in range(0, 80, 4)} == {"negative"} and {found[k] for k in range(1, 80, 4)} == {"positive"}
    words = spark.createDataFrame([(["a", "a", "b", "b", "c"],)], "w array<string>")
    assert [models.least_count(words, "w", most) for most in (3, 2, 1)] == [1, 2, 1 << 30]


def test_embedding_is_saved_and_loaded(spark, tmp_path):
    df = spark.createDataFrame([("a b c", 1.0), ("d e f", 0.0)] * 10, "text string, label double")
    model = models.train_embedded_sentiment(models.train_embedding(df, "text", size=3), df, "text", "label")
    models.save_model(model, str(tmp_path / "m"))
    again = models.trained_sentiment(models.load_model(str(tmp_path / "m")), df, "text")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, models.trained_sentiment(model, df, "text").collect()))


def test_scorers_work_in_a_session_whose_frames_were_observed(spark):
    df = spark.createDataFrame([("a b c", 1.0), ("d e f", 0.0)] * 10, "text string, label double")
    seen = Observation("seen")
    df.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 20}
    embedding = models.train_embedding(df, "text", size=3)
    scorers = [models.train_sentiment(df, "text", "label"), models.train_embedded_sentiment(embedding, df, "text", "label")]
    for model in scorers:
        assert {r.sentiment for r in models.trained_sentiment(model, df, "text").collect()} == {"negative", "positive"}


@pytest.mark.parametrize("kind", ["decision_tree", "boosted_trees"])
def test_sparse_trees_predict_like_those_of_the_library(spark, kind):
    estimator = models.decision_tree("y", depth=4, bins=8) if kind == "decision_tree" else models.boosted_trees("y", rounds=3, depth=2)
    rows = [(Vectors.sparse(6, [(i, float(v)) for i, v in enumerate(f(k) for f in (
        lambda k: k % 3, lambda k: k % 5 // 3, lambda k: k * k % 7 // 2, lambda k: k % 11 % 4, lambda k: 1)) if v]),
        float(k % 3 * 4 + (k * k % 7 // 2) ** 2 + k / 1000)) for k in range(60)]
    df = spark.createDataFrame([*rows, (Vectors.sparse(6, [], []), 2.5)], ["features", "y"])
    ours, theirs = (m.transform(df).select("y", "prediction").collect() for m in (trees.fit_trees(estimator, df), estimator.fit(df)))
    assert {r.y: round(r.prediction, 9) for r in ours} == {r.y: round(r.prediction, 9) for r in theirs}


def test_values_of_many_kinds_share_splits(spark):
    rows = spark.createDataFrame([(0, float(v)) for v in range(1, 41)] + [(1, 2.0)] * 3 + [(1, 5.0)], "i int, v double")
    found = trees.value_splits(rows, 5).collect()
    many = [r for r in found if r.i == 0]
    assert len(many) == 40 and {r.hi for r in many} == {1, 2, 3, 4} and sum(r.starts for r in many) == 4
    assert [(r.v, r.hi, r.threshold) for r in sorted(found, key=lambda r: r.v) if r.i == 1] == [(2.0, 1, 1.0), (5.0, 2, 3.5)]


def test_no_fit_makes_dense_rows_of_the_training_texts(spark, folder, monkeypatch):
    given, fit = [], DecisionTreeRegressor.fit
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda self, df, *rest: given.append(df.count()) or fit(self, df, *rest))
    checks.regression_run(spark, folder, models.decision_tree("target", depth=2))
    assert max(given) <= 2


def test_forests_are_fitted_in_few_parts(spark, folder, monkeypatch):
    parts, fit = [], models.fit_forest
    monkeypatch.setattr(checks, "PER_CLASS", 30)
    monkeypatch.setattr(models, "fit_forest", lambda df, *a, **k: parts.append(df.rdd.getNumPartitions()) or fit(df, *a, **k))
    checks.forest_facts(spark, folder, trees=2, impurity="gini", seed=42)
    assert parts == [1]


def test_vectors_come_from_all_neighbours_in_few_additions(spark, monkeypatch):
    monkeypatch.setattr(embedding, "CHUNK", 4)
    monkeypatch.setattr(embedding, "LONGEST", 7)
    texts = [[0, 1, 2, 1, 0, 3, 3, 1, 2, 0, 4, 1], [], [2], [3, 0, 4, 4, 1, 2, 2]]
    want = np.zeros((5, 5))
    for text in texts:
        for cut in (text[k : k + 7] for k in range(0, len(text), 7)):
            for i, a in enumerate(cut):
                for j, b in enumerate(cut):
                    want[a, b] += 0 < abs(i - j) <= embedding.WINDOW
    df = spark.createDataFrame([(t,) for t in texts], "ids array<int>").repartition(2)
    assert np.allclose(embedding.neighbour_sums(df, np.eye(5)), want)
    words = spark.createDataFrame([(["x", "b", "", "a", "b"],), ([],), (["x"],), (["a", "x"],)], "w array<string>")
    found = embedding.numbered(words, "w", pa.array(["a", "b"])).collect()
    assert sorted(r.ids for r in found) == [[], [], [0], [1, 0, 1]]


def test_passes_of_a_scorer_s_fit_read_counts(spark, monkeypatch):
    given, fit = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, df, *rest: given.append(df) or fit(self, df, *rest))
    df = spark.createDataFrame([("a b c", 1.0), ("d e f", 0.0)] * 10, "text string, label double")
    model = models.train_sentiment(df, "text", "label")
    assert len(model.stages) == 4 and "text" not in given[0].columns
    assert "parquet" in given[0]._jdf.queryExecution().analyzed().toString()
