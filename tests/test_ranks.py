"""Quantiles and running totals against brute force, with one group of most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadlens.operators import ranks, summary


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    hot = rng.lognormal(3, 2, 20_000).round(3)
    values = np.concatenate([hot, np.repeat(1.5, 15_000), rng.integers(0, 5, 400), [9.0]])
    groups = ["hot"] * 35_000 + ["few"] * 400 + ["one"]
    pdf = pd.DataFrame({"g": groups, "v": values.astype(float)}).sample(frac=1, random_state=1)
    return pdf, spark.createDataFrame(pdf).repartition(6).cache()


def test_quantiles_per_group(skewed):
    pdf, df = skewed
    got = {r.g: r for r in ranks.exact_quantiles(df, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.99}).collect()}
    for g, part in pdf.groupby("g"):
        want = np.quantile(part.v, [0.25, 0.5, 0.99])
        assert np.allclose([got[g].a, got[g].b, got[g].c], want, rtol=1e-12)


def test_quantile_of_the_whole_table(skewed):
    pdf, df = skewed
    assert np.isclose(ranks.exact_quantiles(df, [], "v", {"q": 0.99}).first().q, pdf.v.quantile(0.99))


def test_running_totals(skewed):
    pdf, df = skewed
    got = ranks.running_totals(ranks.value_weights(df, ["g"], "v"), ["g"], "v", ["n"]).toPandas()
    want = pdf.groupby(["g", "v"]).size().rename("n").reset_index()
    want["before_n"] = want.groupby("g").n.cumsum() - want.n
    want["total_n"] = want.groupby("g").n.transform("sum")
    merged = got.merge(want, on=["g", "v"], suffixes=("", "_w"))
    assert len(merged) == len(want) == len(got)
    for c in ("n", "before_n", "total_n"):
        assert (merged[c] == merged[f"{c}_w"]).all()


def test_a_hot_group_is_cut_into_many_ranges(skewed):
    """No window task sees more than a small part of the hot group's values."""
    _, df = skewed
    weights = ranks.value_weights(df, ["g"], "v")
    sizes = (
        ranks._place(weights.withColumn("_cuts", ranks._cuts(weights, ["g"], "v")), "v")
        .groupBy("g", "_range")
        .count()
        .agg(F.max("count"), F.sum("count"))
        .first()
    )
    assert sizes[0] < sizes[1] / 50


def test_null_and_missing_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 5.0), ("b", None)], "g string, v double")
    got = {r.g: r.q for r in ranks.exact_quantiles(df, ["g"], "v", {"q": 0.5}).collect()}
    assert got == {"a": 1.0, None: 5.0}
    described = summary.describe_by(df, ["g"], ["v"]).collect()
    assert {r.g: (r["count"], r.q50) for r in described} == {"a": (1, 1.0), "b": (0, None)}


def test_describe_matches_pandas(skewed):
    pdf, df = skewed
    got = summary.describe_by(df, ["g"], ["v"]).toPandas().set_index("g")
    want = pdf.groupby("g").v.describe()
    for mine, theirs in zip(
        ["count", "mean", "std", "min", "q25", "q50", "q75", "max"],
        ["count", "mean", "std", "min", "25%", "50%", "75%", "max"],
    ):
        assert np.allclose(
            got[mine].astype(float).sort_index(), want[theirs].sort_index(), rtol=1e-9, equal_nan=True
        )


def test_histogram_total_and_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 5, 10, 11, 11]], "v double")
    rows = summary.histogram(df, "v", 11).orderBy("bin").collect()
    assert [r.frequency for r in rows] == [1, 1, 0, 0, 0, 1, 0, 0, 0, 0, 3]
    same = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert sum(r.frequency for r in summary.histogram(same, "v", 11).collect()) == 2
