import numpy as np
import pytest
from helpers_llm import groups

from threadlens.llm import vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, node bigint, shard string, unit binary"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 5, "s", None) for i, v in rows], SCHEMA)


def clouds(seed, centres, per, noise=0.1, width=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(centres):
        centre = rng.normal(size=width)
        for _ in range(per):
            rows.append(centre + noise * rng.normal(size=width))
    return [(k, v.astype(np.float32)) for k, v in enumerate(rows)]


def slow(rows):
    units = []
    for i, v in rows:
        v = None if v is None or i is None or any(x is None for x in v) else np.array(v, dtype=np.float32).astype(np.float64)
        units.append(None if v is None or not len(v) or not np.isfinite(v).all() or not v.any() else v / np.linalg.norm(v))
    links = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.95
    ]
    n = np.zeros(len(rows), dtype=int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    root = groups(links, range(len(rows)))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(least.get(root[k], i), i)
    return sorted((str(i), int(n[k]), str(least.get(root[k])), i is not None and i == least[root[k]]) for k, (i, _) in enumerate(rows))


def found(spark, rows):
    got = vectors.near_duplicates(table(spark, rows)).collect()
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got)


def test_links_match_brute_force(spark):
    rows = clouds(1, 40, 8)
    assert found(spark, rows) == slow(rows)


def test_many_clusters_and_parts(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 60)
    monkeypatch.setattr(vectors, "TASK", 40)
    rows = clouds(2, 60, 6) + [(k + 1000, v) for k, v in clouds(3, 1, 150, noise=0.05)]
    got, wanted = found(spark, rows), slow(rows)
    links = sum(w[1] for w in wanted)
    assert sum(min(g[1], w[1]) for g, w in zip(got, wanted)) >= 0.98 * links
    assert all(g[1] <= w[1] for g, w in zip(got, wanted))
    assert np.mean([g[2] == w[2] for g, w in zip(got, wanted)]) > 0.98


def test_odd_vectors_link_with_nothing(spark):
    good = clouds(4, 3, 3, width=4)
    v = good[0][1]
    rows = good + [(50, None), (51, []), (52, [0, 0, 0, 0]), (53, [1, float("nan"), 0, 0]), (54, [float("inf"), 1, 1, 1])]
    rows += [(55, [None, 1, 1, 1]), (None, v), (56, v), (57, v), (57, v), (58, [*v, 0]), (59, [1e-30, 1e-30, 0, 0]), (60, [3e38, 3e38, 0, 0]), (61, -v)]
    assert found(spark, rows) == slow(rows)


def test_recall_is_audited_against_all_vectors(spark):
    rows = clouds(5, 30, 5)
    units = vectors.unit_vectors(table(spark, rows))
    from pyspark.sql import functions as F

    nodes = units.select(F.col("vec_id").alias("rep"), F.col("vec_id").alias("node"), "unit", F.lit(1).cast("bigint").alias("weight"))
    true = {int(i): n + 1 for i, n, *_ in slow(rows)}
    counts = spark.createDataFrame([(k, n) for k, n in true.items()], "node bigint, n bigint")
    assert vectors.audited_recall(nodes, counts) == 1.0
    assert vectors.audited_recall(nodes, counts.filter("node <> 0")) < 0.99


def test_pruning_drops_what_a_nearer_one_hides():
    x = np.array([[1, 0], [0.99, 0.14], [0.95, 0.31], [0, 1]], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    like = x @ x.T
    kept = vectors.robust_prune(like[:1, 1:], lambda i, j: like[np.broadcast_to(i, j.shape), j], np.array([[1, 2, 3]]), 3)
    assert kept[0].tolist()[0] == 1 and 2 not in kept[0].tolist()


@pytest.mark.parametrize("rows", [[], [(1, [1.0]), (2, [2.0])]])
def test_tiny_tables(spark, rows):
    assert found(spark, rows) == slow(rows)


def test_links_to_oneself_do_not_hide_lost_ones(spark):
    from pyspark.sql import functions as F

    rows = [(100 * k, v) for k, v in enumerate(np.eye(210))]
    rows += [(100 * 300, rows[0][1])]
    rows[-1] = (rows[-1][0], rows[0][1] + 0.1 * rows[1][1])
    units = vectors.unit_vectors(table(spark, rows))
    nodes = units.select(F.col("vec_id").alias("rep"), F.col("vec_id").alias("node"), "unit", F.lit(1).cast("bigint").alias("weight"))
    counts = spark.createDataFrame([(i, 1) for i, _ in rows], "node bigint, n bigint")
    assert vectors.audited_recall(nodes, counts) == 0
    assert vectors.audited_recall(nodes.filter("node <> 30000"), counts) == 1


@pytest.mark.filterwarnings("ignore")
def test_lost_links_are_found_by_comparing_all(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 20)
    monkeypatch.setattr(vectors, "TASK", 50)
    monkeypatch.setattr(vectors, "EFFORTS", [(1, 1)])
    rows = [(100 * k, v) for k, v in clouds(7, 2, 90, noise=0.22)]
    rows += [(100 * k + 1, rows[0][1]) for k in range(300)]
    assert found(spark, rows) == slow(rows)
