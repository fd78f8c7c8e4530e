"""Trees over blocks of rows: the same whether a node is split by all tasks or finished in one."""

import pytest
from pyspark.ml.linalg import Vectors
from threadlens.operators import models, postings, trees


def some_rows(spark, n=240):
    """Six features of few and many values; some rows have none, and two features are equal."""
    found = []
    for k in range(n):
        values = [k % 3, k % 5 // 3, k * k % 7 // 2, k % 11 % 4, (k * 37 % 29) / 7, k % 5 // 3]
        found.append((Vectors.sparse(6, [(i, float(v)) for i, v in enumerate(values) if v]), k % 3 * 4 + (k * k % 7 // 2) ** 2 + k % 13 / 10))
    return spark.createDataFrame([*found, (Vectors.sparse(6, [], []), 2.5)], ["features", "y"])


@pytest.mark.parametrize("entries, cells", [(1 << 23, 1 << 22), (0, 1 << 22), (60, 1 << 22), (0, 1)])
def test_trees_are_the_library_s_wherever_a_node_is_split(spark, monkeypatch, entries, cells):
    monkeypatch.setattr(trees, "MOST_ENTRIES", entries)
    monkeypatch.setattr(trees, "BLOCK_ENTRIES", 100)
    monkeypatch.setattr(postings, "CELLS", cells)
    df = some_rows(spark).repartition(4).cache()
    estimator = models.boosted_trees("y", rounds=2, depth=4)
    ours, theirs = (m.transform(df).select("y", "prediction").collect() for m in (trees.fit_trees(estimator, df), estimator.fit(df)))
    assert sorted((r.y, round(r.prediction, 9)) for r in ours) == sorted((r.y, round(r.prediction, 9)) for r in theirs)


def test_a_round_of_boosting_over_few_entries_takes_few_jobs(spark):
    df = some_rows(spark).cache()
    df.count()

    def jobs(rounds):
        spark.sparkContext.setJobGroup(f"rounds-{rounds}", "")
        trees.fit_trees(models.boosted_trees("y", rounds=rounds, depth=10), df)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{rounds}"))

    # Each level of a tree took two jobs or more.
    assert 0 < jobs(4) - jobs(1) <= 3 * 8
