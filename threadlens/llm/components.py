"""Connected components of links too many for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import importable
from threadlens.sources.tables import drop_stage, stage

CHUNK = 1_000_000


def join_roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union-find over positions: the smallest position of each set, given links a-b.

    ``label`` holds the sets so far, each position naming its set's smallest one.
    """
    while len(a):
        high, low = np.maximum(label[a], label[b]), np.minimum(label[a], label[b])
        apart = high != low
        if not apart.any():
            break
        a, b, high, low = a[apart], b[apart], high[apart], low[apart]
        np.minimum.at(label, high, low)
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further
    return label


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the same sets as a-b, from each node to the smallest node it reaches."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = join_roots(np.arange(len(nodes)), place[: len(a)], place[len(a) :])
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list[tuple[np.ndarray, np.ndarray]] = []

    def made() -> pa.RecordBatch:
        a, b = local_forest(*(np.concatenate(x) for x in zip(*kept)))
        return pa.RecordBatch.from_pydict({"a": a, "b": b})

    for batch in batches:
        kept.append((batch["a"].to_numpy(zero_copy_only=False), batch["b"].to_numpy(zero_copy_only=False)))
        if sum(len(a) for a, _ in kept) >= CHUNK:
            yield made()
            kept = []
    if kept:
        yield made()


def _star_round(links: DataFrame) -> DataFrame:
    """Large star, then small star, over links (a, b) with a > b.

    Minima are folded before the shuffle; the joins back are inner, so that adaptive
    execution can split a hub's links.
    """
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (
        both.join(least, "a")
        .filter("b > a and b != m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that is not the smallest of its component.

    ``links`` (a, b) are bigint pairs in any order, repeated or not; rows with a null are
    ignored. Each task first replaces its links by a forest, then star rounds run until
    the links no longer change; every round is written, so nothing is worked out twice, and
    replaces the one before.
    """
    spark = importable(links.sparkSession)
    given = links.select("a", "b").filter("a != b")
    now = stage(given.mapInArrow(_forests, "a bigint, b bigint"), "links")
    before = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
        last, now = now, stage(_star_round(now), "links")
        drop_stage(last)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
