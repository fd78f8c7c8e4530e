"""Forests over all rows of sparse features."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from threadlens.checks import models as checks
from threadlens.operators import forests, models, sampling, trees


def some_rows(spark, n=300):
    found = []
    for k in range(n):
        values = [k % 3, k % 5 // 3, k * k % 7 // 2, k % 11 % 4, (k * 37 % 29) / 7, 1]
        label = (k % 3 + k * k % 7 // 2 + (k % 13 == 0)) % 4
        found.append((Vectors.sparse(6, [(i, float(v)) for i, v in enumerate(values) if v]), float(label)))
    return spark.createDataFrame([*found, (Vectors.sparse(6, [], []), 2.0)], ["features", "y"])


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_a_tree_of_all_rows_and_features_is_the_library_s(spark, monkeypatch, impurity):
    monkeypatch.setattr(trees, "BLOCK_ENTRIES", 100)
    df = some_rows(spark).repartition(3).cache()
    estimator = models.forest("y", trees=1, impurity=impurity, bootstrap=False, maxDepth=4)
    assert forests.can_fit(estimator)
    ours, theirs = (m.transform(df) for m in (forests.fit_forest(estimator, df, 4), estimator.fit(df)))
    found = ours.select("y", "features", F.col("probability").alias("p"), F.col("prediction").alias("c"))
    both = found.collect(), theirs.select("y", "features", "probability", "prediction").collect()
    assert len({r.c for r in both[0]}) > 2
    for mine, other in zip(*(sorted(x, key=lambda r: (str(r.features), r.y)) for x in both)):
        assert mine.c == other.prediction and np.allclose(mine.p.toArray(), other.probability.toArray())


def test_a_forest_s_trees_have_samples_and_features_of_their_own(spark):
    df = some_rows(spark).repartition(3).cache()
    estimator = models.forest("y", trees=30, impurity="gini", seed=7)
    ours, theirs = (forests.fit_forest(estimator, df, 4), estimator.fit(df))
    assert ours.getNumTrees == 30 and ours.numClasses == 4 and ours.numFeatures == 6
    assert len({t.toDebugString.split("\n", 1)[1] for t in ours.trees}) > 20
    right = [m.transform(df).filter("prediction = y").count() for m in (ours, theirs)]
    assert abs(right[0] - right[1]) < 45 and min(right) > 150


def test_forests_learn_from_all_training_rows(spark, folder, monkeypatch):
    given, fit = [], models.fit_forest
    monkeypatch.setattr(checks, "PER_CLASS", 3)
    monkeypatch.setattr(models, "fit_forest", lambda df, *a, **k: given.append(df.select("doc_id").collect()) or fit(df, *a, **k))
    checks.forest_facts(spark, folder, trees=2, impurity="gini", seed=42)
    train, _ = sampling.hash_split(checks.balanced_texts(spark, folder), "doc_id")
    wanted = sorted(r.doc_id for r in train.select("doc_id").collect())
    assert sorted(r.doc_id for r in given[0]) == wanted and len(wanted) > 3 * 4


def test_sums_of_blocks_are_those_of_all_rows(spark, monkeypatch):
    df = some_rows(spark).repartition(4).cache()
    estimator = models.forest("y", trees=2, impurity="gini", bootstrap=False, featureSubsetStrategy="all")
    found = []
    for entries in (50, 1 << 22):
        monkeypatch.setattr(trees, "BLOCK_ENTRIES", entries)
        found.append(forests.fit_forest(estimator, df, 4).toDebugString.split("\n", 1)[1])
    assert found[0] == found[1]
