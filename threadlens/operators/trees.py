"""Regression trees and forests over sparse rows with a full vocabulary.

MLlib's own fit turns every row into one number per feature, present or not: a megabyte a row
with 262,144 words. Here a row is the numbers of the splits it lies above, so zeros cost nothing, and rows
are written in blocks of such numbers once. A level of a tree is one pass over the blocks, whose tasks return sums
per node and split; a node with few enough entries is sent to one task, which grows all that is
below it. The result is MLlib's own model.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.operators import postings
from threadlens.operators.postings import Splits, Tree
from threadlens.session import new_path
from threadlens.sources.tables import drop_path, drop_stage, forget, read_parquet, stage

#: Entries of a node that one task can hold, four bytes each; a larger node is split by all tasks.
MOST_ENTRIES = 1 << 23
#: Entries of a block of rows.
BLOCK_ENTRIES = 1 << 22


def entries(features: str) -> Column:
    """The entries (i, v) of a vector column that are not zero."""
    vector = F.unwrap_udt(features)
    places = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    return F.filter(F.arrays_zip(places.alias("i"), vector["values"].alias("v")), lambda e: e["v"] != 0)


def value_splits(rows: DataFrame, bins: int) -> DataFrame:
    """(i, v, hi, threshold, starts): how many splits of a feature lie below each of its values.

    A feature has a split below each value, or, of more than ``bins`` - 1 values, below each
    quantile of them; ``starts`` marks the value right above the last of its splits.
    """
    counted = rows.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    ordered = Window.partitionBy("i").orderBy("v")
    whole = Window.partitionBy("i")
    parts = counted.select(
        "i",
        "v",
        F.coalesce(F.lag("v").over(ordered), F.lit(0.0)).alias("_last"),
        F.row_number().over(ordered).alias("_rank"),
        F.count(F.lit(1)).over(whole).alias("_values"),
        F.floor((F.sum("n").over(ordered) - F.col("n")) * (bins - 1) / F.sum("n").over(whole)).alias("_part"),
    )
    parts = parts.withColumn("_part", F.when(F.col("_values") < bins, F.col("_rank")).otherwise(F.col("_part")))
    before = F.lag("_part").over(ordered)
    return parts.select(
        "i",
        "v",
        F.dense_rank().over(Window.partitionBy("i").orderBy("_part")).alias("hi"),
        ((F.col("_last") + F.col("v")) / 2).alias("threshold"),
        (before.isNull() | (before != F.col("_part"))).alias("starts"),
    )


class Coded(NamedTuple):
    """Rows in written blocks, and what their numbers mean."""

    blocks: DataFrame
    splits: Splits
    thresholds: np.ndarray
    size: int


#: A row of blocks, as ``postings.block_of`` makes them.
BLOCK = "block bigint, n double, s double, q double, e double, y binary, lens binary, codes binary"


def coded_blocks(rows: DataFrame, label: str, features: str, bins: int) -> Coded:
    """The rows as blocks of at most ``BLOCK_ENTRIES`` entries, or one row.

    Held whole, by the driver and each task, are the splits: ``bins`` - 1 per feature at most.
    """
    spark = rows.sparkSession
    vector = F.unwrap_udt(features)
    places = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    width = F.coalesce(vector["size"], F.size(vector["values"]))
    # Written, so that rows that were dealt out are not dealt again for each pass.
    plain = stage(rows.select(F.col(label).cast("double").alias("y"), places.alias("i"), vector["values"].alias("v"), width.alias("size")), "plain")
    size = plain.select("size").first()
    if size is None:
        raise ValueError("a tree needs rows")
    each = plain.select(F.inline(F.arrays_zip("i", "v"))).filter("v <> 0")
    found = value_splits(each, bins).filter("starts").select("i", "hi", "v", "threshold").toArrow()
    i, hi, v, threshold = (found[x].to_numpy() for x in ("i", "hi", "v", "threshold"))
    if len(v) and v.min() < 0:
        raise ValueError("features of sparse trees are not negative")
    order = np.lexsort((hi, i))
    first = np.append(0, np.cumsum(np.bincount(i, minlength=size[0]))).astype(np.int32)
    splits = Splits(first, i[order].astype(np.int32), v[order])
    known, most, block, cut = spark.sparkContext.broadcast(tuple(splits)), BLOCK_ENTRIES, postings.block_of, postings.numbers_of
    kind = Splits

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        given = kind(*known.value)
        for batch in batches:
            y = batch["y"].to_numpy()
            places, values = batch["i"], batch["v"]
            real = values.flatten().to_numpy()
            code = cut(places.flatten().to_numpy()[real != 0], real[real != 0], given)
            ends = values.offsets.to_numpy() - values.offsets[0].as_py()
            ends = np.append(0, np.cumsum(real != 0))[ends]
            start = 0
            while start < len(y):
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
                yield block(number, y[start:stop], np.diff(ends[start : stop + 1]), code[ends[start] : ends[stop]])
                number, start = number + 1, stop

    blocks = stage(plain.select("y", "i", "v").mapInArrow(coded, BLOCK), "blocks")
    drop_stage(plain)
    return Coded(blocks, splits, threshold[order], size[0])


def _tree(chosen: dict[int, int], splits: Splits) -> tuple[Tree, list[int]]:
    """The inner nodes as arrays, and the node that each number stands for; children of node k are 2k and 2k + 1."""
    order = [1]
    for k in order:
        if k in chosen:
            order += [2 * k, 2 * k + 1]
    at = {k: n for n, k in enumerate(order)}
    none = np.iinfo(np.int32).max
    low = [chosen.get(k, none) for k in order]
    high = [int(splits.last[chosen[k]]) if k in chosen else -1 for k in order]
    sides = [[at[2 * k + side] if k in chosen else at[k] for k in order] for side in (0, 1)]
    depth = max((k.bit_length() for k in chosen), default=0)
    return Tree(*(np.array(x, dtype=np.int32) for x in (low, high, *sides)), depth), order


SUMS = "range int, node bigint, part bigint, codes binary, n binary, s binary, q binary, e binary"
BEST = "node bigint, gain double, split int, n double, s double, q double, e double"


def best_splits(coded: Coded, chosen: dict[int, int], nodes: list[int], totals: dict[int, tuple]) -> dict[int, tuple]:
    """(gain, split, rows, sum, sum of squares, entries above it) of the best split of each node that has one.

    A task adds up what its rows say of each split of these nodes; sums of a range of splits meet in one task.
    """
    spark = coded.blocks.sparkSession
    many = len(coded.splits.feature)
    if not many:
        return {}
    tree, order = _tree(chosen, coded.splits)
    spot = np.full(len(order), -1)
    for k, node in enumerate(nodes):
        spot[order.index(node)] = k
    parts = spark.sparkContext.defaultParallelism
    wanted = max(parts, -(-many * len(nodes) // postings.CELLS))
    edges = np.unique(coded.splits.first[np.searchsorted(coded.splits.first, np.linspace(0, many, wanted + 1))])
    known = spark.sparkContext.broadcast(tuple(coded.splits))
    group = max(1, postings.CELLS // many)
    opened, walk, kind, above, gains = postings.opened, postings.reached, Splits, postings.summed_above, postings.variance_gains
    names = [x.split()[0] for x in SUMS.split(", ")]
    given = [totals[k] for k in nodes]

    def sent(sums: np.ndarray, start: int, part: int) -> Iterator[pa.RecordBatch]:
        for k in range(sums.shape[1] // many):
            mine = sums[:, k * many : (k + 1) * many]
            code = np.flatnonzero(mine[0])
            cuts = np.searchsorted(code, edges)
            for r in range(len(edges) - 1):
                here = code[cuts[r] : cuts[r + 1]]
                if len(here):
                    data = [here.astype(np.int32), mine[0, here].astype(np.int32), *(mine[j, here] for j in (1, 2, 3))]
                    row = [r, nodes[start + k], part, *(x.tobytes() for x in data)]
                    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, part = None, None
        for block, y, lens, code in opened(batches):
            row = np.repeat(np.arange(len(y)), lens)
            mine = spot[walk(tree, row, code, len(y))]
            for start in range(0, len(nodes), group):
                width = min(group, len(nodes) - start)
                inside = (mine >= start) & (mine < start + width)
                kept = inside[row]
                at = row[kept]
                key = (mine[at] - start) * many + code[kept]
                sums = np.zeros((4, width * many)) if whole is None else whole
                for j, value in enumerate((np.ones(len(y)), y, y * y, lens.astype(np.float64))):
                    np.add.at(sums[j], key, value[at])
                if group < len(nodes):
                    yield from sent(sums, start, block)
                else:
                    whole, part = sums, block if part is None else part
        if whole is not None:
            yield from sent(whole, 0, part)

    def best(table: pa.Table) -> pa.Table:
        splits = kind(*known.value)
        r = table["range"][0].as_py()
        low, high = int(edges[r]), int(edges[r + 1])
        feature = splits.feature[low:high]
        place = np.arange(low, high) - splits.first[feature]
        more = np.append(feature[1:] == feature[:-1], False)
        found = []
        rows = table.sort_by([("node", "ascending"), ("part", "ascending")]).to_pylist()
        for k, node in enumerate(nodes):
            sums = np.zeros((high - low, 4))
            for x in (x for x in rows if x["node"] == node):
                at = np.frombuffer(x["codes"], np.int32) - low
                sums[at, 0] += np.frombuffer(x["n"], np.int32)
                for j, name in enumerate(("s", "q", "e"), 1):
                    sums[at, j] += np.frombuffer(x[name], np.float64)
            above(sums, place, more)
            worth = gains(sums, given[k])
            top = int(worth.argmax())
            found.append((node, float(worth[top]), low + top, *map(float, sums[top])))
        columns = ["node", "gain", "split", "n", "s", "q", "e"]
        kinds = [pa.int64(), pa.float64(), pa.int32(), *[pa.float64()] * 4]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*found), kinds)], columns)

    sums = coded.blocks.mapInArrow(summed, SUMS).repartition(min(parts, len(edges) - 1), "range")
    result: dict[int, tuple] = {}
    for x in sums.groupBy("range").applyInArrow(best, BEST).collect():
        if x["gain"] > postings.LEAST and (x["gain"], -x["split"]) > (lambda y: (y[0], -y[1]))(result.get(x["node"], (0.0, 0))):
            result[x["node"]] = tuple(x)[1:]
    return result


def finished(coded: Coded, chosen: dict[int, int], nodes: list[int], depth: int) -> list[tuple]:
    """(node, split or -1, gain, rows, sum, sum of squares) of all nodes from these ones down, each one's rows in one task."""
    spark = coded.blocks.sparkSession
    tree, order = _tree(chosen, coded.splits)
    wanted = np.full(len(order), -1, dtype=np.int64)
    for node in nodes:
        wanted[order.index(node)] = node
    known = spark.sparkContext.broadcast(tuple(coded.splits))
    opened, walk, kind, grow_here, block = postings.opened, postings.reached, Splits, postings.grown, postings.block_of

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, y, lens, code in opened(batches):
            row = np.repeat(np.arange(len(y)), lens)
            at = walk(tree, row, code, len(y))
            of_row, of_entry = np.argsort(at, kind="stable"), np.argsort(at[row], kind="stable")
            rows, every = at[of_row], at[row][of_entry]
            for k in np.unique(rows):
                if wanted[k] >= 0:
                    mine = of_row[np.searchsorted(rows, k) : np.searchsorted(rows, k, side="right")]
                    here = of_entry[np.searchsorted(every, k) : np.searchsorted(every, k, side="right")]
                    made = block(number, y[mine], lens[mine], code[here])
                    yield made.append_column("node", pa.array([wanted[k]], pa.int64()))

    def below(table: pa.Table) -> pa.Table:
        node = table["node"][0].as_py()
        pieces = list(opened(table.sort_by("block").to_batches()))
        y, lens, code = (np.concatenate([x[j] for x in pieces]) for j in (1, 2, 3))
        found = grow_here(y, lens, code, node, depth - node.bit_length() + 1, kind(*known.value))
        kinds = [pa.int64(), pa.int32(), *[pa.float64()] * 4]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*found), kinds)], ["node", "split", "gain", "n", "s", "q"])

    parts = min(len(nodes), spark.sparkContext.defaultParallelism)
    sent = coded.blocks.mapInArrow(dealt, f"{BLOCK}, node bigint").repartition(parts, "node")
    return sent.groupBy("node").applyInArrow(below, "node bigint, split int, gain double, n double, s double, q double").collect()


def grow(coded: Coded, depth: int) -> tuple[dict[int, int], dict[int, tuple], dict[int, float]]:
    """The splits of inner nodes, (rows, sum, sum of squares) of all nodes, and the gains of inner ones.

    Each level of the nodes with many entries is one pass over the rows; all others are finished in one more.
    """
    root = coded.blocks.agg(*[F.coalesce(F.sum(x), F.lit(0.0)) for x in "nsqe"]).first()
    if not root[0]:
        raise ValueError("a tree needs rows")
    totals, chosen, gains = {1: tuple(root)}, {}, {}
    waiting, small = [1], []
    while waiting:
        waiting = [k for k in waiting if k.bit_length() <= depth and totals[k][0] > 1 and postings.spread_of(totals[k]) > postings.LEAST]
        small += [k for k in waiting if totals[k][3] <= MOST_ENTRIES]
        large = [k for k in waiting if totals[k][3] > MOST_ENTRIES]
        waiting = []
        for k, (gain, split, *above) in (best_splits(coded, chosen, large, totals) if large else {}).items():
            totals[2 * k + 1] = tuple(above)
            totals[2 * k] = tuple(a - b for a, b in zip(totals[k], above))
            gains[k] = gain
            waiting += [2 * k, 2 * k + 1]
            chosen[k] = split
    below = finished(coded, chosen, small, depth) if small else []
    for k, split, gain, *total in below:
        totals[k] = tuple(total)
        if split >= 0:
            chosen[k], gains[k] = split, gain
    return chosen, {k: (int(x[0]), *x[1:3]) for k, x in totals.items()}, gains


def left_over(coded: Coded, chosen: dict[int, int], totals: dict[int, tuple], step: float | None) -> DataFrame:
    """The blocks with what the next tree learns: doubled once, after the first tree, which has no step."""
    tree, order = _tree(chosen, coded.splits)
    means = np.array([totals[k][1] / totals[k][0] for k in order])
    opened, walk, block = postings.opened, postings.reached, postings.block_of

    def after(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, y, lens, code in opened(batches):
            found = means[walk(tree, np.repeat(np.arange(len(y)), lens), code, len(y))]
            yield block(number, (y - found) * 2 if step is None else y - 2 * step * found, lens, code)

    return stage(coded.blocks.mapInArrow(after, BLOCK), "left")


def _nodes(chosen, totals, gains, coded: Coded) -> list[tuple]:
    """The rows of MLlib's node table, numbered from the root, left side first."""
    order, waiting = [], [1]
    while waiting:
        k = waiting.pop()
        order.append(k)
        if k in chosen:
            waiting += [2 * k + 1, 2 * k]
    ids = {k: n for n, k in enumerate(order)}
    rows = []
    for k in order:
        n, s, q = totals[k]
        inner = k in chosen
        split = (int(coded.splits.feature[chosen[k]]), [float(coded.thresholds[chosen[k]])], -1) if inner else (-1, [], -1)
        sides = (ids[2 * k], ids[2 * k + 1]) if inner else (-1, -1)
        rows.append((ids[k], s / n, postings.spread_of(totals[k]), [float(n), s, q], n, gains.get(k, -1.0), *sides, split))
    return rows


NODE = """id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double,
leftChild int, rightChild int, split struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>"""


def as_model(estimator: Estimator, size: int, trees: list[list[tuple]], spark, labels: int = 2):
    """MLlib's model of these trees: one fitted on a row per label, saved, its nodes replaced, loaded again."""
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    few = [(Vectors.sparse(size, [0], [float(k)]), float(k)) for k in range(labels)]
    fitted = estimator.fit(spark.createDataFrame(few, [features, label]))
    path, filled = new_path(spark, "tree"), new_path(spark, "tree")
    fitted.save(path)
    kinds = read_parquet(spark, f"{path}/data").schema
    if "treeID" in kinds.names:
        rows = spark.createDataFrame([(t, row) for t, nodes in enumerate(trees) for row in nodes], f"treeID int, nodeData struct<{_fields(NODE)}>")
        read_parquet(spark, f"{path}/treesMetadata").coalesce(1).write.parquet(f"{filled}/treesMetadata")
    else:
        rows = spark.createDataFrame(trees[0], NODE)
    rows.select(*[F.col(f.name).cast(f.dataType) for f in kinds.fields]).coalesce(1).write.parquet(f"{filled}/data")
    spark.read.text(f"{path}/metadata").coalesce(1).write.text(f"{filled}/metadata")
    model = type(fitted).load(filled)
    drop_path(spark, path)
    drop_path(spark, filled)
    return model


def _fields(kinds: str) -> str:
    """A table's columns as those of a struct."""
    return ", ".join(f"{name}: {kind}" for name, kind in (part.strip().split(" ", 1) for part in kinds.replace("\n", " ").split(", ")))


def fit_trees(estimator: Estimator, rows: DataFrame):
    """``estimator.fit`` of a decision tree or squared-loss boosted trees, for features that are not negative.

    Depth, bins, rounds and step are the estimator's; each round's tree learns twice what is left over, as in MLlib.
    """
    spark = rows.sparkSession
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    depth, bins = estimator.getMaxDepth(), estimator.getMaxBins()
    boosted = estimator.hasParam("maxIter")
    rounds = estimator.getMaxIter() if boosted else 1
    coded = coded_blocks(rows, label, features, bins)
    trees = []
    for done in range(rounds):
        chosen, totals, gains = grow(coded, depth)
        trees.append(_nodes(chosen, totals, gains, coded))
        forget(spark)
        if done + 1 < rounds:
            step = None if done == 0 else estimator.getStepSize()
            after = left_over(coded, chosen, totals, step)
            drop_stage(coded.blocks)
            coded = coded._replace(blocks=after)
    drop_stage(coded.blocks)
    return as_model(estimator, coded.size, trees, spark)
