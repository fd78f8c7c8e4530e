from pyspark.sql import functions as F

from threadlens.operators import joins, reshape, summary


def test_hot_post_and_lonely_post(spark):
    posts = spark.createDataFrame([(str(i), f"title {i}") for i in range(50)], "id string, title string")
    comments = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 40).cast("string")).alias("com_link_id"),
        F.col("id").alias("com_no"),
    )
    got = joins.posts_with_comments(posts, comments, "id", "com_link_id")
    want = posts.join(comments, posts.id == comments.com_link_id, "left")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.filter("com_no is null").count() == 10


def test_ids_do_not_multiply_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    ids = spark.createDataFrame([("a",), ("a",), ("c",)], "i string")
    assert sorted(r.v for r in joins.keep_ids(df, "k", ids, "i").collect()) == [1, 3]


def test_months_lost_by_the_inner_join_are_reported(spark):
    facts = spark.createDataFrame([(1, 2021, 1), (2, 2022, 1), (3, 2022, 1)], "id int, year int, month int")
    dims = spark.createDataFrame([(2021, 1, 5.0)], "Year int, Month int, CPI double")
    inner = joins.attach_months(facts, dims)
    assert inner.columns == ["id", "year", "month", "CPI"]
    assert [r.id for r in inner.collect()] == [1]
    assert joins.attach_months(facts, dims, how="left").count() == 3
    lost = joins.months_without_indicators(facts, dims).collect()
    assert [(r.year, r.month, r.lost_rows) for r in lost] == [(2022, 1, 2)]


def test_group_value_on_every_row(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "g string, v int")
    totals = rows.groupBy("g").agg(F.sum("v").alias("total"))
    for groups in (None, ["a", "b"]):
        got = joins.attach_group_value(rows, totals, "g", groups).collect()
        assert sorted((r.g, r.v, r.total) for r in got) == [("a", 1, 3), ("a", 2, 3), ("b", 3, 3)]


def test_series_join_does_not_multiply(spark):
    counts = spark.createDataFrame([("d1", 5), ("d2", 6)], "date string, n int")
    kpis = spark.createDataFrame([("d1", 1.0)] * 4 + [("d2", 2.0)] * 3, "date string, CPI double")
    assert joins.join_series(counts, kpis).count() == 2


def test_months_wide_and_back(spark):
    long = spark.createDataFrame([("2020", "January", 1.0), ("2020", "May", 2.0), ("2021", "May", 3.0)], "Year string, Month string, v double")
    back = reshape.months_to_rows(reshape.rows_to_months(long, "v"), "v").filter("v is not null")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


def test_ratio_and_scaling_of_nothing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(summary.ratio(F.col("a"), F.col("b"))).collect()] == [None, 2.0]
    scaled = summary.normalise(df.withColumn("c", F.lit(3.0)), {"a": "na", "c": "nc"}).collect()
    assert [(r.na, r.nc) for r in scaled] == [(0.0, None), (1.0, None)]
