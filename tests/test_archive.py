"""Posts and comments in buckets: the same rows, one scan each and no shuffle."""

import uuid

import pytest
from pyspark.sql import functions as F

from threadlens.operators import joins
from threadlens.sources import archive


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(str(i), f"title {i}") for i in range(50)] + [("3", "again"), (None, "no id")]
    posts = spark.createDataFrame(rows, "id string, title string")
    hot = F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 60).cast("string"))
    comments = spark.range(6000).select(F.when(F.col("id") == 5, None).otherwise(hot).alias("com_link_id"), F.lit("same").alias("com_body"))
    return posts, comments


def write(spark, tables, folder, **options):
    return archive.write_archive(*tables, "id", "com_link_id", str(folder), f"t{uuid.uuid4().hex}", buckets=4, **options)


def scans_and_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Scan parquet"), plan.count("Exchange"), plan.count("Sort ")


def test_same_rows_as_the_join(spark, tables, tmp_path):
    made = write(spark, tables, tmp_path / "a", per_piece=300)
    found = archive.archived_posts_with_comments(spark, made)
    want = joins.posts_with_comments(*tables, "id", "com_link_id")
    assert found.columns == want.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_one_scan_of_each_table_and_no_exchange(spark, tables, tmp_path):
    made = write(spark, tables, tmp_path / "a", per_piece=300)
    scans, exchanges, _ = scans_and_exchanges(archive.archived_posts_with_comments(spark, made))
    assert (scans, exchanges) == (2, 0)


def test_a_hot_post_is_several_tasks_work(spark, tables, tmp_path):
    made = write(spark, tables, tmp_path / "a", per_piece=300)
    found = archive.archived_posts_with_comments(spark, made).filter("id = '7'")
    per_task = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("t")).count().collect()]
    assert len(per_task) == 4 and max(per_task) < 0.6 * sum(per_task)


def test_each_post_and_comment_once(spark, tables, tmp_path):
    made = write(spark, tables, tmp_path / "a", per_piece=300)
    assert sorted(map(str, archive.archived_posts(spark, made).collect())) == sorted(map(str, tables[0].collect()))
    assert archive.archived_comments(spark, made).count() == tables[1].count()


def test_written_again_and_opened_by_another_name(spark, tables, tmp_path):
    folder = tmp_path / "a"
    first = write(spark, tables, folder)
    again = archive.write_archive(*tables, "id", "com_link_id", str(folder), first.posts.removesuffix("_posts"), buckets=4, per_piece=300)
    assert again == first
    other = archive.open_archive(spark, str(folder), f"o{uuid.uuid4().hex}", "id", "com_link_id", 4)
    a, b = (archive.archived_posts_with_comments(spark, x) for x in (first, other))
    assert scans_and_exchanges(b)[:2] == (2, 0)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_no_rows(spark, tables, tmp_path):
    made = write(spark, (tables[0].limit(0), tables[1].limit(0)), tmp_path / "a")
    assert archive.archived_posts_with_comments(spark, made).collect() == []
