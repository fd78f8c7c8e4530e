"""Numpy work of the tasks that fit trees, over rows as numbers of the splits they lie above.

A feature has a split below each of its values or quantiles of them. Splits are numbered by feature and
value, from ``first[i]`` to ``first[i + 1]`` - 1 for feature i, and an entry is the last split it lies
above: it lies above the earlier ones of its feature too. Zeros lie above none and cost nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Sent to workers whole, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A node whose values differ less, or whose best split gains less, is a leaf.
LEAST = 1e-12
#: Sums held at once for all nodes and splits of a level.
CELLS = 1 << 22


class Splits(NamedTuple):
    """The first split of each feature and of one past the last, and each split's feature and least value above it."""

    first: np.ndarray
    feature: np.ndarray
    least: np.ndarray

    @property
    def last(self) -> np.ndarray:
        """The last split of each split's feature."""
        return self.first[self.feature + 1] - 1


class Tree(NamedTuple):
    """Nodes by number: rows with an entry from ``low`` to ``high`` go to ``right``, others to ``left``; leaves lead to themselves."""

    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: int


def block_of(number: int, y: np.ndarray, lens: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
    total = [float(x) for x in (len(y), y.sum(), (y * y).sum(), len(code))]
    parts = [np.asarray(y, np.float64), np.asarray(lens, np.int32), np.asarray(code, np.int32)]
    row = [number, *total, *(x.tobytes() for x in parts)]
    names = ["block", "n", "s", "q", "e", "y", "lens", "codes"]
    kinds = [pa.int64(), *[pa.float64()] * 4, *[pa.binary()] * 3]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(block, y, lens, codes) of each block."""
    for batch in batches:
        for k in range(batch.num_rows):
            y, lens, code = (np.frombuffer(batch[x][k].as_buffer(), t) for x, t in (("y", np.float64), ("lens", np.int32), ("codes", np.int32)))
            yield batch["block"][k].as_py(), y, lens, code


def numbers_of(i: np.ndarray, v: np.ndarray, splits: Splits) -> np.ndarray:
    """The last split that lies below each value v of a feature i."""
    code, end = splits.first[i], splits.first[i + 1]
    up = np.flatnonzero(code + 1 < end)
    while len(up):
        up = up[splits.least[code[up] + 1] <= v[up]]
        code[up] += 1
        up = up[code[up] + 1 < end[up]]
    return code


def reached(tree: Tree, row: np.ndarray, code: np.ndarray, rows: int) -> np.ndarray:
    """The node each row ends in; ``row`` and ``code`` are the rows' entries."""
    node = np.zeros(rows, dtype=np.int32)
    for _ in range(tree.depth):
        hit = (code >= tree.low[node][row]) & (code <= tree.high[node][row])
        right = np.zeros(rows, dtype=bool)
        right[row[hit]] = True
        node = np.where(right, tree.right[node], tree.left[node])
    return node


def summed_above(sums: np.ndarray, place: np.ndarray, more: np.ndarray) -> None:
    """Sums of the last split above become sums of all rows above, in place; ``place`` counts a feature's splits
    from 0 and ``more`` tells where the next one is of the same feature. Features never share an addition, so equal
    ones stay equal to the last digit."""
    several = np.flatnonzero(more)
    order = several[np.argsort(-place[several], kind="stable")]
    cuts = np.flatnonzero(np.diff(place[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        sums[part] += sums[part + 1]


def variance_gains(above: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What each split gains of a node's variance: ``above`` and ``total`` begin with rows and sum."""
    n, s = above[:, 0], above[:, 1]
    mean = total[1] / total[0]
    real = (n > 0) & (n < total[0])
    n = np.where(real, n, 1)
    rest = np.where(real, total[0] - n, 1)
    # Both sides' distance from the node's mean, which loses fewer digits than their squares.
    off = (s / n - mean) ** 2 * n + ((total[1] - s) / rest - mean) ** 2 * rest
    return np.where(real, off / total[0], 0.0)


def totals_of(y: np.ndarray) -> tuple[float, float, float]:
    return float(len(y)), float(y.sum()), float((y * y).sum())


def spread_of(total: tuple) -> float:
    """The variance of a node's values."""
    n, s, q = total[:3]
    return max(0.0, q / n - (s / n) ** 2)


def grown(y: np.ndarray, lens: np.ndarray, code: np.ndarray, root: int, depth: int, splits: Splits) -> list[tuple]:
    """(node, split or -1, gain, rows, sum, sum of squares) of the tree below a node whose rows are all here."""
    known = np.zeros(len(splits.feature), dtype=bool)
    known[code] = True
    table, code = np.flatnonzero(known), (np.cumsum(known, dtype=np.int32) - 1)[code]
    found = []
    waiting = [(root, depth, y, np.repeat(np.arange(len(y), dtype=np.int32), lens), code, table)]
    while waiting:
        node, left, y, row, code, table = waiting.pop()
        total = totals_of(y)
        split, gain = -1, -1.0
        if left and total[0] > 1 and spread_of(total) > LEAST and len(code):
            feature = splits.feature[table]
            more = np.append(feature[1:] == feature[:-1], False)
            before = np.append(False, more[:-1])
            sums = np.column_stack([np.bincount(code, minlength=len(table)), np.bincount(code, y[row], minlength=len(table))])
            starts = np.flatnonzero(~before)
            place = np.arange(len(table)) - np.repeat(starts, np.diff(np.append(starts, len(table))))
            summed_above(sums, place, more)
            gains = variance_gains(sums, total)
            best = int(gains.argmax())
            if gains[best] > LEAST:
                gain = float(gains[best])
                # Of splits that no row lies between, the first.
                split = int(table[best - 1] + 1 if before[best] else splits.first[feature[best]])
                end = int(np.searchsorted(feature, feature[best], side="right"))
                above = np.zeros(len(y), dtype=bool)
                above[row[(code >= best) & (code < end)]] = True
                for side, mine in ((2 * node, ~above), (2 * node + 1, above)):
                    kept = mine[row]
                    known = np.zeros(len(table), dtype=bool)
                    known[code[kept]] = True
                    again = np.cumsum(known, dtype=np.int32) - 1
                    waiting.append((side, left - 1, y[mine], (np.cumsum(mine, dtype=np.int32) - 1)[row[kept]], again[code[kept]], table[known]))
        found.append((node, split, gain, *total))
    return found


class Columns(NamedTuple):
    """A block's entries by split: ``row`` of those of split k are from ``at[k]`` to ``at[k + 1]``."""

    row: np.ndarray
    code: np.ndarray
    at: np.ndarray


def by_split(row: np.ndarray, code: np.ndarray, splits: Splits) -> Columns:
    order = np.argsort(code, kind="stable")
    at = np.append(0, np.cumsum(np.bincount(code, minlength=len(splits.feature))))
    return Columns(row[order].astype(np.int32), code[order], at)


def weights_of(seed: int, tree: int, block: int, rows: int, rate: float, repeated: bool) -> np.ndarray:
    """How often a tree's sample has each row of a block; the same whenever it is asked for."""
    if not repeated and rate >= 1:
        return np.ones(rows)
    rng = np.random.default_rng([seed, 1, tree, block])
    return (rng.poisson(rate, rows) if repeated else rng.random(rows) < rate).astype(np.float64)


def features_of(seed: int, tree: int, nodes: np.ndarray, size: int, some: int) -> np.ndarray:
    """The features that each node of a tree tries, in order; the same whenever they are asked for."""
    if some >= size:
        return np.tile(np.arange(size), (len(nodes), 1))
    picked = [np.random.default_rng([seed, 2, tree, int(k)]).choice(size, some, replace=False, shuffle=False) for k in nodes]
    return np.sort(np.array(picked), axis=1)


def placed(columns: Columns, low: np.ndarray, high: np.ndarray, rows: int, level: int) -> np.ndarray:
    """The node of one tree that each row has reached; children of k are 2k and 2k + 1, and ``low`` is -1 for leaves."""
    node = np.ones(rows, dtype=np.int32)
    for d in range(level):
        after = np.where(low[node] >= 0, 2 * node, node)
        for k in range(1 << d, 2 << d):
            if low[k] >= 0:
                row = columns.row[columns.at[low[k]] : columns.at[high[k] + 1]]
                after[row[node[row] == k]] += 1
        node = after
    return node


def class_sums(columns: Columns, y: np.ndarray, w: np.ndarray, node: np.ndarray, nodes: np.ndarray, tried: np.ndarray, classes: int, splits: Splits):
    """(rows per node and class, places, rows there): places are of the tried splits of all nodes in order, by class."""
    spot = np.full(max(int(node.max(initial=0)), int(nodes.max())) + 1, -1, dtype=np.int64)
    spot[nodes] = np.arange(len(nodes))
    mine = spot[node]
    real = (mine >= 0) & (w > 0)
    totals = np.bincount(mine[real] * classes + y[real], w[real], minlength=len(nodes) * classes)
    feature = tried.ravel()
    low, high = splits.first[feature], splits.first[feature + 1]
    offset = np.cumsum(high - low) - (high - low)
    start = columns.at[low]
    size = columns.at[high] - start
    pair = np.repeat(np.arange(len(feature)), size)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size - start, size)
    row = columns.row[at]
    kept = np.flatnonzero((mine[row] == pair // tried.shape[1]) & real[row])
    pair, row = pair[kept], row[kept]
    key = (offset[pair] + columns.code[at[kept]] - low[pair]) * classes + y[row]
    places, which = np.unique(key, return_inverse=True)
    return totals, places, np.bincount(which, w[row], minlength=len(places))


def impurities(counts: np.ndarray, kind: str) -> np.ndarray:
    """Gini or entropy (in bits) of each row's class counts."""
    share = counts / np.maximum(counts.sum(axis=-1, keepdims=True), 1)
    if kind == "gini":
        return np.where(counts.sum(axis=-1) > 0, 1 - (share * share).sum(axis=-1), 0.0)
    return -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=-1)


def best_of(sums: np.ndarray, totals: np.ndarray, tried: np.ndarray, kind: str, least_rows: float, least_gain: float, splits: Splits):
    """Per node: the best tried split or -1, its gain, and the class counts above it."""
    feature = tried.ravel()
    many = splits.first[feature + 1] - splits.first[feature]
    offset = np.append(0, np.cumsum(many))
    place = np.arange(offset[-1]) - np.repeat(offset[:-1], many)
    summed_above(sums, place, place + 1 < np.repeat(many, many))
    ends = offset[:: tried.shape[1]]
    total = np.repeat(totals, np.diff(ends), axis=0)
    rest = total - sums
    n, above, below = total.sum(axis=1), sums.sum(axis=1), rest.sum(axis=1)
    gain = np.repeat(impurities(totals, kind), np.diff(ends)) - (above * impurities(sums, kind) + below * impurities(rest, kind)) / np.maximum(n, 1)
    gain[(above < max(least_rows, 1)) | (below < max(least_rows, 1)) | (gain < least_gain)] = 0.0
    found = []
    for k in range(len(totals)):
        mine = gain[ends[k] : ends[k + 1]]
        best = int(mine.argmax()) + int(ends[k]) if len(mine) else -1
        if best < 0 or gain[best] <= LEAST:
            found.append((-1, -1.0, np.zeros(totals.shape[1])))
            continue
        pair = int(np.searchsorted(offset, best, side="right")) - 1
        found.append((int(splits.first[feature[pair]] + place[best]), float(gain[best]), sums[best]))
    return found
