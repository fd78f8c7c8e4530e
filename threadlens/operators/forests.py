"""Forests of classification trees over all rows, as sparse as those of ``trees``.

All trees grow a level at a time. A task adds up, for each tree, what its blocks say of the splits that each node of
the level tries; a tree's sums meet in one task, whose size depends on the features tried and not on the rows. Which rows
a tree's sample has how often, and which features a node tries, is worked out anew from the seed wherever it is needed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.sql import DataFrame

from threadlens.operators import postings
from threadlens.operators.postings import Splits
from threadlens.operators.trees import Coded, as_model, coded_blocks
from threadlens.sources.tables import drop_stage, forget

#: Trees whose sums a task returns together.
TOGETHER = 50
#: Levels of a tree at most: nodes are numbered like those of a whole tree.
DEEPEST = 14

SUMS = "tree int, block bigint, totals binary, places binary, counts binary"
BEST = "tree int, node int, split int, gain double, total array<double>, above array<double>"


def features_tried(strategy: str, trees: int, size: int) -> int | None:
    """How many features a node tries, as MLlib counts them; None for strategies that are not known here."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    return {"all": size, "sqrt": math.ceil(math.sqrt(size)), "log2": max(1, math.ceil(math.log2(size))), "onethird": math.ceil(size / 3)}.get(strategy)


def best_splits(coded: Coded, estimator: Estimator, classes: int, level: int, low: np.ndarray, high: np.ndarray, open_nodes: np.ndarray) -> list:
    """(tree, node, split or -1, gain, counts per class, counts above the split) of the open nodes of a level.

    ``low`` and ``high`` are the entries that go right, per tree and node; ``low`` is -1 where a node has no split.
    """
    spark = coded.blocks.sparkSession
    state = spark.sparkContext.broadcast((*coded.splits, low, high, open_nodes))
    seed, trees, size = estimator.getSeed() % (1 << 63), len(low), coded.size
    some = features_tried(estimator.getFeatureSubsetStrategy(), trees, size)
    rate, repeated = estimator.getSubsamplingRate(), estimator.getBootstrap()
    impurity, least = estimator.getImpurity(), (estimator.getMinInstancesPerNode(), estimator.getMinInfoGain())
    kind, together, work = Splits, TOGETHER, (postings.opened, postings.by_split, postings.weights_of, postings.placed)
    opened, by_split, weights, placed = work
    features, class_sums, best_of = postings.features_of, postings.class_sums, postings.best_of

    def as_small(places: np.ndarray, cells: int) -> np.ndarray:
        return places.astype(np.uint32 if cells < 1 << 32 else np.int64)

    def batch_of(held: list) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), kinds)], ["tree", "block", "totals", "places", "counts"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits, (lows, highs, is_open) = kind(*state.value[:3]), state.value[3:]
        many = np.diff(splits.first)
        for number, y, lens, code in opened(batches):
            columns = by_split(np.repeat(np.arange(len(y)), lens), code, splits)
            label = y.astype(np.int64)
            held = []
            for t in range(trees):
                nodes = np.flatnonzero(is_open[t]) + (1 << level)
                if not len(nodes):
                    continue
                w = weights(seed, t, number, len(y), rate, repeated)
                node = placed(columns, lows[t], highs[t], len(y), level)
                tried = features(seed, t, nodes, size, some)
                totals, places, counts = class_sums(columns, label, w, node, nodes, tried, classes, splits)
                places = as_small(places, int(many[tried].sum()) * classes)
                held.append((t, number, totals.tobytes(), places.tobytes(), counts.astype(np.uint32).tobytes()))
                if len(held) == together:
                    yield batch_of(held)
                    held = []
            if held:
                yield batch_of(held)

    def best(table: pa.Table) -> pa.Table:
        splits, is_open = kind(*state.value[:3]), state.value[5]
        t = table["tree"][0].as_py()
        nodes = np.flatnonzero(is_open[t]) + (1 << level)
        tried = features(seed, t, nodes, size, some)
        cells = int(np.diff(splits.first)[tried].sum())
        totals, sums = np.zeros(len(nodes) * classes), np.zeros(cells * classes)
        sort = as_small(np.zeros(0), cells * classes).dtype
        for batch in table.to_batches():
            for total, places, counts in zip(*(batch[x] for x in ("totals", "places", "counts"))):
                totals += np.frombuffer(total.as_buffer(), np.float64)
                sums[np.frombuffer(places.as_buffer(), sort)] += np.frombuffer(counts.as_buffer(), np.uint32)
        totals = totals.reshape(-1, classes)
        found = best_of(sums.reshape(-1, classes), totals, tried, impurity, *least, splits)
        rows = [(t, int(k), split, gain, list(total), list(above)) for k, total, (split, gain, above) in zip(nodes, totals, found)]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), *[pa.list_(pa.float64())] * 2]
        return pa.table([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["tree", "node", "split", "gain", "total", "above"])

    parts = min(trees, 4 * spark.sparkContext.defaultParallelism)
    sums = coded.blocks.mapInArrow(counted, SUMS).repartition(parts, "tree")
    return sums.groupBy("tree").applyInArrow(best, BEST).collect()


def _nodes(chosen: dict[int, int], stats: dict[int, np.ndarray], gains: dict[int, float], coded: Coded, kind: str) -> list[tuple]:
    """The rows of MLlib's node table, from the root, left side first; leaves of one parent that name one class are
    their parent, as in MLlib."""
    leaf = {k: k not in chosen for k in stats}
    for k in sorted(chosen, reverse=True):
        leaf[k] = leaf[2 * k] and leaf[2 * k + 1] and stats[2 * k].argmax() == stats[2 * k + 1].argmax()
    order, waiting = [], [1]
    while waiting:
        k = waiting.pop()
        order.append(k)
        if not leaf[k]:
            waiting += [2 * k + 1, 2 * k]
    ids = {k: n for n, k in enumerate(order)}
    rows = []
    for k in order:
        split, sides, gain = (-1, [], -1), (-1, -1), -1.0
        if not leaf[k]:
            split = (int(coded.splits.feature[chosen[k]]), [float(coded.thresholds[chosen[k]])], -1)
            sides, gain = (ids[2 * k], ids[2 * k + 1]), gains[k]
        counts = stats[k]
        impurity = float(postings.impurities(counts[None], kind)[0])
        rows.append((ids[k], float(counts.argmax()), impurity, [float(x) for x in counts], int(counts.sum()), gain, *sides, split))
    return rows


def can_fit(estimator: Estimator) -> bool:
    """Whether ``fit_forest`` knows the estimator's settings."""
    known = features_tried(estimator.getFeatureSubsetStrategy(), estimator.getNumTrees(), 1) is not None
    plain = not estimator.isSet(estimator.weightCol) and estimator.getMinWeightFractionPerNode() == 0
    return known and plain and estimator.getMaxDepth() <= DEEPEST


def fit_forest(estimator: Estimator, rows: DataFrame, classes: int):
    """``estimator.fit`` of a forest on all rows, for features that are not negative and labels below ``classes``.

    Rows are in as many blocks as they have parts, or more; samples and features differ from MLlib's for a seed.
    """
    coded = coded_blocks(rows, estimator.getLabelCol(), estimator.getFeaturesCol(), estimator.getMaxBins())
    trees, depth, kind = estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getImpurity()
    chosen, gains, stats = ([{} for _ in range(trees)] for _ in range(3))
    low, high = (np.full((trees, 1), -1, dtype=np.int32) for _ in range(2))
    open_nodes = np.ones((trees, 1), dtype=bool)
    for level in range(max(depth, 1)):
        if not open_nodes.any():
            break
        after = np.zeros((trees, 2 << level), dtype=bool)
        low, high = (np.hstack([x, np.full((trees, (2 << level) - x.shape[1]), -1, dtype=np.int32)]) for x in (low, high))
        for t, k, split, gain, total, above in best_splits(coded, estimator, classes, level, low, high, open_nodes):
            stats[t][k] = np.array(total)
            if split < 0 or not depth:
                continue
            chosen[t][k], gains[t][k] = split, gain
            low[t, k], high[t, k] = split, coded.splits.last[split]
            sides = np.array([np.subtract(total, above), above])
            stats[t][2 * k], stats[t][2 * k + 1] = sides
            after[t, 2 * (k - (1 << level)) : 2 * (k - (1 << level)) + 2] = postings.impurities(sides, kind) > postings.LEAST
        forget(rows.sparkSession)
        open_nodes = after if level + 1 < depth else np.zeros_like(after)
    drop_stage(coded.blocks)
    nodes = [_nodes(chosen[t], stats[t], gains[t], coded, kind) for t in range(trees)]
    return as_model(estimator, coded.size, nodes, rows.sparkSession, max(classes, 2))
