import pytest
from pyspark.sql import functions as F

from threadlens.sources import reports


def counting(spark, seen):
    """A frame that counts the rows that pass through it."""

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return spark.range(1000).repartition(4).mapInArrow(passed, "id bigint")


def test_the_pass_that_writes_reports(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    rows = counting(spark, seen).select(
        "id", F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).alias("a.b"), F.array("id").alias("list"), F.lit(None).cast("date").alias("none")
    )
    report = reports.write_with_report(rows, str(tmp_path / "t"))
    assert [tuple(r) for r in report.collect()] == [
        ("id", 1000, 0, "0", "999"), ("a.b", 1000, 750, "0", "996"), ("list", 1000, 0, None, None), ("none", 1000, 1000, None, None),
    ]
    assert seen.value == 1000 and spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_report_of_nothing(spark, tmp_path):
    report = reports.write_with_report(spark.range(0), str(tmp_path / "t")).collect()
    assert [tuple(r) for r in report] == [("id", 0, 0, None, None)]


def test_totals_come_from_footers(spark, folder):
    found = reports.footer_totals(spark, f"{folder}/lineitem.parquet", ["l_orderkey", "l_quantity"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan and "MIN(l_orderkey)" in plan
    plain = spark.read.parquet(f"{folder}/lineitem.parquet").agg(
        F.count(F.lit(1)), F.min("l_orderkey"), F.max("l_orderkey"), F.min("l_quantity"), F.max("l_quantity")
    )
    assert tuple(found.first()) == tuple(plain.first())
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_texts_have_no_sure_bounds(spark, folder):
    with pytest.raises(ValueError, match="text"):
        reports.footer_totals(spark, f"{folder}/documents.parquet", ["text"])
