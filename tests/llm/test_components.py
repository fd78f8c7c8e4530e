import random

import numpy as np
from helpers_llm import groups

from threadlens.llm.components import components, local_forest


def test_components_of_chains_stars_and_repeats(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 180)]
    links += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(7, 7), (5, 4), (5, 4)]
    links += [(-(1 << 63), 300), (300, (1 << 62))]
    rng.shuffle(links)
    found = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    nodes = {x for link in links for x in link}
    assert {n: found.get(n, n) for n in nodes} == groups([x for x in links if x[0] != x[1]], nodes)
    assert all(n > c for n, c in found.items())


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert components(spark.createDataFrame([(1, None), (None, None)], "a bigint, b bigint")).count() == 0


def test_local_forest_keeps_sets():
    a, b = local_forest(np.array([5, 9, 1]), np.array([9, 7, 2]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(2, 1), (7, 5), (9, 5)]
