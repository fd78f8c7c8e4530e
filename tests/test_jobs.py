"""The jobs end to end on a small hand-made archive."""

import pytest
from pyspark.sql import functions as F

from threadlens.plans import engagement, learning, sentiments, texts
from threadlens.schemas import COMMENTS, POSTS_WITH_COMMENTS, SAMPLED_POSTS, SUBMISSIONS
from threadlens.sources import tables

HOURS = [0, 6, 7, 12, 13, 18, 19, 23]
LEXICON = {"good": 1.0, "great": 1.0, "bad": -1.0, "awful": -1.0}


def epoch(year, month, hour):
    import calendar

    return calendar.timegm((year, month, 3, hour, 0, 0))


@pytest.fixture(scope="module")
def archive(spark):
    words = ["good tax plan", "bad border order", "awful school news", "great climate talk", "plain words only"]
    posts, comments = [], []
    for community in engagement.COMMUNITIES + ["memes"]:
        for i in range(60):
            title = "[deleted by user]" if i % 20 == 19 else f"{words[i % 5]} {community} {i}. Really?"
            year = 2022 if i % 6 == 5 else 2021
            posts.append(
                (community, title, i % 120, 3000 if i == 7 else i % 9, epoch(year, i % 12 + 1, HOURS[i % 8]), f"{community}{i}", "u", "")
            )
            for j in range(i % 4):
                link = f"t3_{community}{i}"
                body = ["[removed]", f"{words[(i + j) % 5]} {community} thing", "[deleted]"][j]
                comments.append(("u", body, epoch(year, 1, 5), link, link if j < 2 else "t1_x", j, community))
    comments.append(("u", None, 0, "t3_politics1", "t3_politics1", 1, "politics"))
    comments.append(("u", "bad reply good", 0, "t3_politics1", "t1_abc", 1, "politics"))
    return (
        spark.createDataFrame(posts, SUBMISSIONS).cache(),
        spark.createDataFrame(comments, COMMENTS).cache(),
    )


@pytest.fixture(scope="module")
def sampled(archive):
    return engagement.sampled_posts(archive[0], per_community=50).cache()


@pytest.fixture(scope="module")
def featured(sampled):
    return engagement.post_features(sampled).cache()


def test_sample_is_balanced_and_clean(sampled):
    counts = {r.subreddit: r["count"] for r in sampled.groupBy("subreddit").count().collect()}
    assert counts == dict.fromkeys(engagement.COMMUNITIES, 50)
    assert sampled.filter(F.col("title") == "[deleted by user]").count() == 0
    assert sampled.columns == engagement.POST_COLUMNS


def test_comments_are_first_level_and_linked(archive, sampled):
    comments = engagement.first_level_comments(archive[1])
    assert comments.filter(F.col("body").isNull() | F.col("body").startswith("[")).count() == 0
    assert comments.filter(F.col("link_id").startswith("t3_")).count() == 0
    joined = engagement.posts_and_comments(sampled, comments)
    kept = comments.join(sampled, comments.link_id == sampled.id, "left_semi").count()
    assert joined.filter("com_body is not null").count() == kept > 0
    assert joined.select("id").distinct().count() == sampled.count()
    rows = engagement.joined_features(joined)
    assert rows.filter("comment_time is null").count() == joined.filter("com_body is null").count()
    assert {"sub_time_of_day", "comment_length", "dummy_police", "username"} <= set(rows.columns)
    assert not {"com_subreddit", "com_id"} & set(rows.columns)


def test_joined_rows_survive_a_headerless_csv(spark, archive, sampled, tmp_path):
    joined = engagement.posts_and_comments(sampled, engagement.first_level_comments(archive[1]))
    tables.write_csv(joined, str(tmp_path / "joined"))
    back = tables.read_back_csv(spark, str(tmp_path / "joined"), POSTS_WITH_COMMENTS)
    wanted = ["id", "body", "comment_time", "sub_hour", "comment_length", "dummy_climate"]
    a, b = (engagement.joined_features(df).select(wanted).collect() for df in (joined, back))
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_comments_through_sentiment_and_training(spark, archive):
    comments = engagement.comment_features(engagement.first_level_comments(archive[1]))
    months = spark.createDataFrame(
        [(2021, 1, 260.0, 6.0, 30000.0)], "Year int, Month int, CPI double, Unemp_Rate double, DOW double"
    ).withColumn("date", F.make_date("Year", "Month", F.lit(1)))
    texts_ = sentiments.scored(texts.with_indicators(comments, "body", months), "body", LEXICON).cache()
    found = sentiments.comment_tables(texts_)
    assert found["by_community"].agg(F.sum("count")).first()[0] == texts_.count() > 0
    assert found["series"].count() == texts_.select("sentiment").distinct().count()
    sets = learning.community_set(texts_, "body", vocabulary=200)
    sizes = [r["count"] for r in sets.groupBy("subreddit").count().collect()]
    assert len(sizes) == 3 and max(sizes) == min(sizes) > 0


def test_midnight_has_no_part_of_the_day(featured):
    assert featured.filter("hour = 0 and time_of_day is not null").count() == 0
    tables_ = engagement.summary_tables(featured)
    per_part = tables_["table2"].filter("measure = 'score'").agg(F.sum("count")).first()[0]
    assert per_part == featured.filter("hour > 0").count()
    by_community = tables_["table1"].filter("measure = 'score'").collect()
    assert all(r["count"] == 50 for r in by_community)


def test_charts(featured):
    charts = engagement.chart_tables(featured, dots=10)
    rates = charts["comments_per_post"]
    assert rates.agg(F.sum("counts")).first()[0] == featured.count()
    top = featured.selectExpr("percentile(num_comments, 0.99)").first()[0]
    kept = featured.filter(F.col("num_comments") < top)
    assert charts["comments_by_hour"].agg(F.sum("num_comments")).first()[0] == kept.agg(F.sum("num_comments")).first()[0]
    assert charts["score_and_comments"].count() == 30
    limited = engagement.chart_tables(featured, {"Republican": 20, "democrats": 20}, dots=5)
    aligned = {(r.hour, r.subreddit): r.counts for r in limited["comments_per_post"].collect()}
    assert aligned == {(r.hour, r.subreddit): r.counts for r in rates.collect()}


@pytest.fixture(scope="module")
def with_months(spark, featured):
    months = spark.createDataFrame(
        [(2021, m, 260.0 + m, 6.0 - m / 10, 30000.0 + m) for m in range(1, 13)],
        "Year int, Month int, CPI double, Unemp_Rate double, DOW double",
    ).withColumn("date", F.make_date("Year", "Month", F.lit(1)))
    return texts.with_indicators(featured, "title", months).cache()


def test_months_without_indicators_are_lost(featured, with_months):
    assert with_months.count() == featured.filter("year = 2021").count()
    assert {"dummy_education", "dummy_trump", "CPI", "date"} <= set(with_months.columns)


def test_word_tables(with_months):
    found = texts.word_tables(with_months, "id", "title")
    counts = {r.word: r["count"] for r in found["bag_of_words"].collect()}
    assert counts["border"] == with_months.filter("title like '%border%'").count()
    assert found["cloud"].filter("rank = 1").count() == 3
    bins = texts.length_histogram(with_months, "title").collect()
    assert len(bins) == 11 and sum(b.frequency for b in bins) == with_months.count()


def test_sentiment_tables(with_months):
    titles = sentiments.scored(with_months, "title", LEXICON).cache()
    assert titles.count() == with_months.count()
    found = sentiments.title_tables(titles)
    assert found["by_score"].count() == 18
    assert found["by_score"].agg(F.sum("count")).first()[0] == titles.count()
    per_topic = sentiments.comment_tables(titles)
    police = per_topic["by_topic"].filter("topic = 'police'").first()
    assert police.negative == titles.filter("dummy_police and sentiment = 'negative'").count()
    series = per_topic["series"].collect()
    assert len(series) == titles.select("date", "sentiment").distinct().count()
    assert min(r.normalized_CPI for r in series) == 0.0 and max(r.normalized_CPI for r in series) == 1.0


def test_models_from_texts_to_comparison(with_months):
    model, rows = learning.regression_set(with_months, vocabulary=500)
    fitted, found, table = learning.run_regressions(rows, rounds=2, depth=3)
    assert table.count() == 2 and set(fitted) == set(found)
    sets = learning.community_set(with_months, "title", vocabulary=500)
    sizes = {r["count"] for r in sets.groupBy("subreddit").count().collect()}
    assert len(sizes) == 1
    small = {"a": {"trees": 5, "impurity": "gini", "seed": 42}, "b": {"trees": 4, "impurity": "entropy", "seed": 5}}
    _, predictions, compared = learning.run_forests(sets, forests=small)
    assert all(r.accuracy == pytest.approx(r.weighted_recall) for r in compared.collect())
    curves = learning.roc_tables(predictions["a"])
    assert curves["two_class"].agg(F.max("tpr")).first()[0] == 1.0
    assert {r["class"] for r in curves["one_vs_rest"].collect()} == {0, 1, 2}


def test_posts_survive_a_headerless_csv(spark, sampled, tmp_path):
    tables.write_csv(sampled, str(tmp_path / "posts"))
    back = tables.read_back_csv(spark, str(tmp_path / "posts"), SAMPLED_POSTS)
    assert sorted(map(str, back.select("id", "title").collect())) == sorted(map(str, sampled.select("id", "title").collect()))


def test_line_ends_quotes_and_empty_texts_survive_csv(spark, tmp_path):
    rows = [(1, 'two\nlines, "quoted"'), (2, ""), (3, None), (4, "back\\slash\\n and \\s"), (5, "\r\n"), (6, "\\N"), (7, ' pad, "')]
    df = spark.createDataFrame(rows, "id bigint, text string")
    tables.write_csv(df, str(tmp_path / "texts"))
    back = tables.read_back_csv(spark, str(tmp_path / "texts"), "id bigint, text string")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_any_saved_model_predicts_after_loading(spark, tmp_path):
    from pyspark.ml import Pipeline

    from threadlens.operators import features, models

    df = spark.createDataFrame([("a b", 1.0), ("b c", 2.0), ("c c a", 3.0)] * 5, "text string, y double")
    fitted = Pipeline(stages=[*features.tfidf_stages("text"), models.decision_tree("y")]).fit(df)
    boosted = models.boosted_trees("y", rounds=2, depth=2).fit(fitted.transform(df).drop("prediction"))
    for name, model in {"pipe": fitted, "tree": fitted.stages[-1], "boost": boosted}.items():
        models.save_model(model, str(tmp_path / name))
        loaded = models.load_model(str(tmp_path / name))
        rows = df if name == "pipe" else fitted.transform(df).drop("prediction")
        assert loaded.transform(rows).filter("prediction is null").count() == 0


def test_a_trained_scorer_can_leave_texts_neutral(spark, tmp_path):
    from threadlens.operators import models

    rows = [("bad awful", 1.0), ("good fine", 0.0)] * 10
    model = models.train_sentiment(spark.createDataFrame(rows, "t string, y double"), "t", "y")
    texts_ = spark.createDataFrame([(1, "bad"), (2, "good"), (3, "unseen"), (4, None)], "id int, t string")
    found = sentiments.scored_by_model(texts_, "t", model)
    assert {r.id: r.sentiment for r in found.collect()} == {1: "negative", 2: "positive", 3: "neutral", 4: None}
    sentiments.save_tables({"scored": found}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "scored")).count() == 4
