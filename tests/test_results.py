"""Jobs that write: what they leave, again after a rerun, and nothing else."""

import os

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from threadlens import session
from threadlens.operators import features, models
from threadlens.plans import engagement, jobs, prediction, texts
from threadlens.schemas import COMMENTS, SUBMISSIONS
from threadlens.sources import results, tables


def rows_of(found):
    """Rows by table; numbers that add up in any order are rounded."""

    def plain(row):
        return str([f"{v:.9g}" if isinstance(v, float) else v for v in row])

    return {name: sorted(map(plain, t.collect())) for name, t in found.items()}


@pytest.fixture
def shared(tmp_path, monkeypatch):
    place = tmp_path / "shared"
    place.mkdir()
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(place))
    return place


def test_only_partitions_that_occur_are_replaced(spark, tmp_path):
    folder = str(tmp_path / "out")
    first = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "part string, n int")
    results.save_results({"t": first, "u": first}, folder, {"t": ["part"]})
    later = spark.createDataFrame([("b", 4), ("b", 5)], "part string, n int")
    for _ in range(2):
        results.save_results({"t": later, "u": later}, folder, {"t": ["part"]})
        found = results.read_results(spark, folder)
        assert sorted(map(tuple, found["t"].collect())) == [("a", 1), ("a", 2), ("b", 4), ("b", 5)]
        assert sorted(map(tuple, found["u"].collect())) == [("b", 4), ("b", 5)]
        assert {(r.name, r.total_rows, r.parts) for r in results.read_manifest(spark, folder).collect()} == {("t", 2, "part"), ("u", 2, "")}


def test_a_run_that_fails_leaves_no_manifest(spark, tmp_path, shared):
    folder = str(tmp_path / "out")
    df = spark.range(3)
    results.save_results({"t": df}, folder)
    with pytest.raises(Exception, match="stop here"), tables.staging():
        results.save_results({"t": df, "u": tables.stage(df, "x").selectExpr("raise_error('stop here') as e")}, folder)
    with pytest.raises(Exception):
        results.read_manifest(spark, folder).collect()
    assert os.listdir(shared) == []


def test_engagement_job_runs_again(spark, tmp_path, shared):
    posts, comments = [], []
    for k in range(30):
        name = engagement.COMMUNITIES[k % 3]
        posts.append((name, f"tax plan {k}", k, k % 7, 1_610_000_000 + k * 4000, f"p{k}", "u", ""))
        comments += [("u", f"reply {j}", 1_610_000_000, f"t3_p{k}", f"t3_p{k}", j, name) for j in range(k % 3)]
    archive = spark.createDataFrame(posts, SUBMISSIONS), spark.createDataFrame(comments, COMMENTS)
    folder, seen = str(tmp_path / "out"), []
    for _ in range(2):
        jobs.engagement_job(*archive, folder, per_community=10)
        seen.append(rows_of(results.read_results(spark, folder)))
    assert seen[0] == seen[1] and len(seen[0]["posts"]) == 30
    assert len(seen[0]["posts_and_comments"]) == sum(max(1, k % 3) for k in range(30))
    assert {"table1", "table4", "posts_by_hour"} <= set(seen[0])
    assert os.listdir(shared) == []


def test_saved_models_score_rows_by_partition(spark, tmp_path):
    df = spark.createDataFrame([("a b", 1.0, "x"), ("b c", 2.0, "y"), ("c c a", 3.0, "y")] * 5, "text string, y double, name string")
    indexer = features.fit_indexer(df, "name", "ix")
    stages = [*features.tfidf_stages("text"), indexer, features.one_hot("ix", "vec"), models.forest("ix", trees=3)]
    fitted = Pipeline(stages=[*stages, features.index_to_label("prediction", "predicted_label", indexer)]).fit(df)
    models.save_model(fitted, str(tmp_path / "forest"))
    new = [(1, "a b", "m"), (2, None, "m"), (3, "", "n"), (4, "unseen words", "n"), (4, "unseen words", "n")]
    rows = spark.createDataFrame(new, "prediction int, text string, words string")
    folder = str(tmp_path / "out")
    for _ in range(2):
        prediction.prediction_job(str(tmp_path / "forest"), rows.withColumnRenamed("prediction", "id"), ["id", "words"], folder, ["words"])
        found = results.read_results(spark, folder)["predictions"].collect()
        assert sorted(r.id for r in found) == [1, 2, 3, 4, 4]
        assert all((r.predicted_label in ("x", "y")) == (r.id != 2) == (r.prediction is not None) for r in found)
    plan = prediction.predicted(fitted, rows, ["prediction"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_bare_tree_refuses_rows_it_cannot_read(spark):
    df = spark.createDataFrame([(Vectors.dense(float(k)), float(k)) for k in range(9)], ["features", "y"])
    tree = models.decision_tree("y", depth=2).fit(df)
    with pytest.raises(ValueError, match="features: missing"):
        prediction.predicted(tree, df.select("y"), ["y"])
    with pytest.raises(ValueError, match="features: double instead of vector"):
        prediction.predicted(tree, df.selectExpr("y", "y as features"), ["y"])
    nulls = df.union(df.limit(1).selectExpr("null", "y"))
    found = prediction.predicted(tree, nulls, ["y"]).collect()
    assert len(found) == 10 and sum(r.prediction is None for r in found) == 1
    assert prediction.predicted(tree, df.limit(0), ["y"]).count() == 0


@pytest.fixture(scope="module")
def dated(spark):
    rows = []
    for k in range(90):
        title = ["good tax plan", "bad border order", "awful school news", "great climate talk"][k % 4] + f" {k % 11}"
        rows.append((engagement.COMMUNITIES[k % 3], title, k, k % 7, 1_610_000_000 + k % 12 * 2_500_000, f"p{k}"))
    posts = spark.createDataFrame(rows, "subreddit string, title string, score long, num_comments long, created_utc long, id string")
    months = spark.createDataFrame(
        [(2021, m, 260.0 + m, 6.0 - m / 10, 30000.0 + m) for m in range(1, 13)],
        "Year int, Month int, CPI double, Unemp_Rate double, DOW double",
    ).withColumn("date", F.make_date("Year", "Month", F.lit(1)))
    return engagement.post_features(posts), months


def test_text_and_title_jobs(spark, tmp_path, shared, dated):
    jobs.texts_job(dated[0], "id", "title", dated[1], str(tmp_path / "texts"))
    found = results.read_results(spark, str(tmp_path / "texts"))
    rows = found["texts"].count()
    assert rows == dated[0].filter("year = 2021").count() > 50
    assert found["cleaned"].count() == found["annotated"].count() == rows
    assert found["lengths"].selectExpr("sum(frequency)").first()[0] == rows
    jobs.titles_job(found["texts"], "title", {"good": 1.0, "bad": -1.0}, str(tmp_path / "titles"))
    titles = results.read_results(spark, str(tmp_path / "titles"))
    assert titles["scored"].count() == rows and "polarization_score" in titles["scored"].columns
    assert titles["by_community"].selectExpr("sum(count)").first()[0] == rows
    assert os.listdir(shared) == []


def test_learning_job_then_predictions(spark, tmp_path, shared, dated):
    rows = texts.with_indicators(dated[0], "title", dated[1])
    out = str(tmp_path / "out")
    jobs.learning_job(rows, out, text_options={"vocabulary": 50}, rounds=1, depth=2)
    found = results.read_results(spark, out)
    assert set(found) == {"comparison", "predictions_decision_tree", "predictions_gradient_boost"}
    assert found["comparison"].count() == 2 and os.listdir(shared) == []
    vectors = models.load_model(f"{out}/models/text").transform(rows.select("id", "title"))
    prediction.prediction_job(f"{out}/models/gradient_boost", vectors, ["id"], str(tmp_path / "new"))
    scored = results.read_results(spark, str(tmp_path / "new"))["predictions"]
    assert scored.filter("prediction is not null").count() == rows.count()
