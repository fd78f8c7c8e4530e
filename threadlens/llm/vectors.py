"""Near copies among embeddings by graph search.

Vectors are cut into overlapping shards around cluster centres. Each shard's vectors get a
flat graph with robust pruning, a vector's neighbour lists of all its shards are put
together, and every vector is then searched from the shards' medoids: greedily at first,
then outwards over all vectors within range. Links are verified in double precision, and
the recall is audited against a comparison with all vectors; while it is too low the search
is widened, and in the end all vectors are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import importable
from threadlens.llm.components import components, join_roots
from threadlens.sources.tables import stage

COSINE = 0.95
#: Vectors per cluster aimed at, and the clusters fitted at most.
SHARD = 1000
CLUSTERS = 4096
#: Vectors the centres are fitted on: so many per cluster, those of smallest hash.
PER_CLUSTER = 32
#: Nodes that one task holds at most; the nodes and the searches of larger clusters are dealt to several.
TASK = 2500
NEAR = 24
FAR = 8
#: (shards per vector, width of the beam), widened while the audited recall is too low; then all are compared.
EFFORTS = [(2, 32), (3, 64), (6, 128)]
RECALL = 0.99
AUDITED = 500

_GRAPH = pa.schema([("node", pa.int64()), ("near", pa.list_(pa.int64()))])
_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("met", pa.int64())])


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, unit) of the rows that can link: no null, zero or non-finite component, an id."""

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for vec_id, vector in zip(batch["vec_id"].to_pylist(), batch["embedding"]):
                values = vector.values
                if values is None or not len(values) or values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all() or not x.any():
                    continue
                x = x / np.abs(x).max()  # so that no square overflows or vanishes
                ids.append(vec_id)
                out.append((x / np.sqrt(x @ x)).tobytes())
            yield pa.RecordBatch.from_pydict({"vec_id": pa.array(ids, pa.int64()), "unit": pa.array(out, pa.binary())})

    wanted = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return wanted.filter("vec_id is not null and embedding is not null").mapInArrow(units, "vec_id bigint, unit binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)


def centres(nodes: DataFrame, count: int) -> np.ndarray:
    """Cluster centres fitted on a bounded sample of vectors of one length."""
    width = nodes.select(F.octet_length("unit").alias("w")).first().w // 8
    wanted = max(1, min(-(-count // SHARD), CLUSTERS, (4 << 20) // width))

    @F.arrow_udf("array<double>")
    def listed(units: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(u.as_py(), dtype=np.float64) for u in units], pa.list_(pa.float64()))

    some = nodes.orderBy(F.xxhash64("node"), "node").limit(wanted * PER_CLUSTER)
    rows = stage(some.select(array_to_vector(listed("unit")).alias("features")), "sample")
    if wanted == 1:
        return np.array([rows.first().features.toArray()])
    fit = KMeans(k=wanted, seed=7, maxIter=8, initSteps=1, distanceMeasure="cosine").fit(rows)
    found = np.array(fit.clusterCenters())
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-300)


def assigned(nodes: DataFrame, centre: np.ndarray, shards: int) -> DataFrame:
    """(node, weight, unit, shard, own): each node with its nearest centres; ``own`` marks the first."""
    shared = nodes.sparkSession.sparkContext.broadcast(centre)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        k = min(shards, len(c))
        for batch in batches:
            if not batch.num_rows:
                continue
            likeness = _matrix(batch["unit"]) @ c.T
            best = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
            order = np.argsort(-np.take_along_axis(likeness, best, axis=1), axis=1, kind="stable")
            best = np.take_along_axis(best, order, axis=1)
            for rank in range(k):
                yield pa.RecordBatch.from_arrays(
                    [batch["node"], batch["weight"], batch["unit"], pa.array(best[:, rank].astype(np.int64)), pa.array([rank == 0] * batch.num_rows)],
                    ["node", "weight", "unit", "shard", "own"],
                )

    return nodes.mapInArrow(nearest, "node bigint, weight bigint, unit binary, shard bigint, own boolean")


def robust_prune(likeness: np.ndarray, between, candidates: np.ndarray, most: int, alpha: float = 1.2) -> np.ndarray:
    """Per row the candidates kept, -1 where fewer: nearest first, dropping those that a kept one stands before.

    ``likeness`` (rows, candidates) is their cosine, ``between(i, j)`` that of two nodes.
    """
    rows = np.arange(len(candidates))
    left = np.where(candidates >= 0, likeness, -np.inf)
    kept = np.full((len(candidates), most), -1, dtype=np.int64)
    for k in range(most):
        best = left.argmax(axis=1)
        real = left[rows, best] > -np.inf
        if not real.any():
            break
        chosen = candidates[rows, best]
        kept[real, k] = chosen[real]
        left[rows, best] = -np.inf
        # Squared distances of unit vectors are 2 - 2 cos.
        hidden = alpha * alpha * (1 - between(chosen[:, None], candidates)) <= (1 - likeness)
        left[hidden] = -np.inf
    return kept


def build_graph(x: np.ndarray) -> list[np.ndarray]:
    """Neighbour lists of one shard: pruned near ones, some far ones, and the way back along both."""
    n = len(x)
    if n == 1:
        return [np.zeros(0, dtype=np.int64)]
    rng = np.random.default_rng(n)
    likeness = x @ x.T
    np.fill_diagonal(likeness, -2)
    wide = min(n - 1, 2 * NEAR)
    near = np.argpartition(-likeness, wide - 1, axis=1)[:, :wide]
    near_kept = robust_prune(np.take_along_axis(likeness, near, axis=1), lambda i, j: likeness[np.broadcast_to(i, j.shape), j], near, NEAR)
    far = rng.integers(0, n, (n, 4 * FAR))
    far_kept = robust_prune(np.take_along_axis(likeness, far, axis=1), lambda i, j: likeness[np.broadcast_to(i, j.shape), j], far, FAR)
    start = np.repeat(np.arange(n), NEAR + FAR)
    end = np.concatenate([near_kept, far_kept], axis=1).ravel()
    real = (end >= 0) & (end != start)
    edges = np.unique(np.concatenate([start[real] * n + end[real], end[real] * n + start[real]]))
    return np.split(edges % n, np.searchsorted(edges, np.arange(1, n) * n))


def medoids(x: np.ndarray, count: int = 8) -> np.ndarray:
    """The node nearest to the mean, then nodes far from those chosen."""
    chosen = [int((x @ x.mean(axis=0)).argmax())]
    nearest = x @ x[chosen[0]]
    for _ in range(min(count, len(x)) - 1):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return np.unique(chosen)


class Search:
    """Searches of many queries at once over one task's graph."""

    def __init__(self, x: np.ndarray, near: list[np.ndarray]):
        self.x = x
        width = max(1, max(map(len, near)))
        self.near = np.full((len(x), width), -1, dtype=np.int64)
        for i, some in enumerate(near):
            self.near[i, : len(some)] = some
        self.starts = medoids(x)

    def run(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all visited pairs within range."""
        n, m = len(self.x), len(q)
        seen = np.zeros((m, n), dtype=bool)
        open_ = np.full((m, n), -np.inf)
        seen[:, self.starts] = True
        open_[:, self.starts] = q @ self.x[self.starts].T
        best = np.sort(open_, axis=1)[:, -min(beam, n) :]  # the beam's likeness, least first
        hits = [np.argwhere(open_ >= COSINE)]
        active = np.arange(m)
        while len(active):
            # One step: each query opens its best node while it can still better the beam or lies in range.
            at = open_[active].argmax(axis=1)
            value = open_[active, at]
            go = (value > -np.inf) & ((value >= best[active, 0]) | (value >= COSINE - 0.03))
            active, at = active[go], at[go]
            if not len(active):
                break
            open_[active, at] = -np.inf
            nodes = self.near[at]
            rows = np.broadcast_to(active[:, None], nodes.shape)
            fresh = nodes >= 0
            fresh[fresh] = ~seen[rows[fresh], nodes[fresh]]
            r, c = rows[fresh], nodes[fresh]
            seen[r, c] = True
            likeness = np.einsum("ij,ij->i", q[r], self.x[c])
            open_[r, c] = likeness
            near = likeness >= COSINE
            if near.any():
                hits.append(np.stack([r[near], c[near]], axis=1))
            wide = np.full(nodes.shape, -np.inf)
            wide[fresh] = likeness
            both = np.concatenate([best[active], wide], axis=1)
            best[active] = np.partition(both, both.shape[1] - best.shape[1], axis=1)[:, -best.shape[1] :]
            best[active, 0] = best[active].min(axis=1)
        found = np.concatenate(hits)
        return found[:, 0], found[:, 1]


def _graph(table: pa.Table) -> pa.Table:
    x = _matrix(table["unit"])
    nodes = table["node"].to_numpy()
    near = [nodes[some] for some in build_graph(x)]
    return pa.Table.from_arrays([pa.array(nodes), pa.array(near, pa.list_(pa.int64()))], schema=_GRAPH)


def _searcher(beam: int | None):
    def search(table: pa.Table) -> pa.Table:
        """Links of one task: its forest over the nodes, and how many own rows and nodes each query found.

        Without a beam, each query is compared with all nodes here.
        """
        query_only = table["only"].to_numpy(zero_copy_only=False)
        nodes, own = table["node"].to_numpy(), table["own"].to_numpy(zero_copy_only=False)
        weight = table["weight"].to_numpy()
        x = _matrix(table["unit"])
        held = np.flatnonzero(~query_only)
        if not len(held):
            return _FOUND.empty_table()
        ids = nodes[held]
        if beam is not None:
            order = np.argsort(ids)
            near = []
            for some in table["near"].take(pa.array(held)).to_pylist():
                some = np.array(some or [], dtype=np.int64)
                spot = order[np.minimum(np.searchsorted(ids, some, sorter=order), len(ids) - 1)]
                near.append(np.unique(spot[ids[spot] == some]))
            graph = Search(x[held], near)
        asks = np.flatnonzero(table["asks"].to_numpy(zero_copy_only=False))
        query, node = [], []
        spots = {int(i): k for k, i in enumerate(ids)}
        for first in range(0, len(asks), 1000):
            some = asks[first : first + 1000]
            if beam is None:
                r, c = np.nonzero(x[some] @ x[held].T >= COSINE - 1e-9)
                query.append(some[r])
                node.append(c)
                continue
            r, c = graph.run(x[some], beam)
            query.append(some[r])
            node.append(c)
            # A query that is a node must meet itself; if not, it is compared with all nodes here.
            met = np.zeros(len(some), dtype=bool)
            met[r[ids[c] == nodes[some[r]]]] = True
            lost = np.flatnonzero(~met & np.array([int(nodes[s]) in spots for s in some]))
            if len(lost):
                again = np.argwhere(x[some[lost]] @ x[held].T >= COSINE)
                query.append(some[lost[again[:, 0]]])
                node.append(again[:, 1])
        if not query:
            return _FOUND.empty_table()
        pairs = np.unique(np.concatenate(query) * len(held) + np.concatenate(node))
        q, c = pairs // len(held), pairs % len(held)
        # The check that counts: the cosine in double precision, the same whichever comes first.
        sure = np.einsum("ij,ij->i", x[q], x[held[c]]) >= COSINE
        q, c = q[sure], held[c[sure]]
        count = np.zeros(len(nodes), dtype=np.int64)
        np.add.at(count, q[own[c]], weight[c[own[c]]])
        met_here = np.bincount(q[own[c]], minlength=len(nodes))
        label = join_roots(np.arange(len(nodes)), q, c)
        linked = np.flatnonzero((label != np.arange(len(nodes))) | (count > 0))
        return pa.Table.from_arrays(
            [pa.array(nodes[linked]), pa.array(nodes[label[linked]]), pa.array(count[linked]), pa.array(met_here[linked])],
            schema=_FOUND,
        )

    return search


def searched(nodes: DataFrame, centre: np.ndarray, shards: int, beam: int | None) -> DataFrame:
    """(a, b, n, met) rows: a is linked into b's component; n more links of a, to met more nodes, were found.

    Without a beam no graph is built: what shares a cluster is compared.
    """
    members = stage(assigned(nodes, centre, shards), "members")
    # A cluster's size, and into how many parts its nodes go: a row per cluster, at most CLUSTERS.
    sizes = members.groupBy("shard").agg(F.count(F.lit(1)).alias("size"))
    parts = F.broadcast(sizes.select("shard", F.ceil(F.col("size") / TASK).cast("bigint").alias("parts")))
    dealt = members.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    if beam is None:
        linked = dealt.withColumn("near", F.lit(None).cast("array<bigint>"))
    else:
        built = dealt.groupBy("shard", "part").applyInArrow(_graph, "node bigint, near array<bigint>")
        lists = built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        linked = dealt.join(lists, "node")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("other")
    # A cluster in one part is one task. Of a larger one, each part of its nodes meets each part of its searches.
    held = linked.select("shard", "part", every, "node", "weight", "unit", "own", "near")
    held = held.withColumn("asks", F.col("part") == F.col("other")).withColumn("only", F.lit(False))
    asking = (
        dealt.filter("parts > 1")
        .select("shard", F.col("part").alias("other"), "parts", "node", "weight", "unit")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .filter("part <> other")
        .select(
            "shard", "part", "other", "node", "weight", "unit", F.lit(False).alias("own"),
            F.lit(None).cast("array<bigint>").alias("near"), F.lit(True).alias("asks"), F.lit(True).alias("only"),
        )
    )
    tasks = held.unionByName(asking)
    return tasks.groupBy("shard", "part", "other").applyInArrow(_searcher(beam), "a bigint, b bigint, n bigint, met bigint")


def audited_recall(nodes: DataFrame, counts: DataFrame) -> float:
    """Links found over links there are, for a bounded number of vectors compared with all.

    The vectors are those of smallest hash whose id is divisible by 100. ``counts`` says how many
    nodes each has found (node, n), itself among them. That one is sure, and so are folded
    copies: only links between different nodes count, each once.
    """
    asked = nodes.filter("rep % 100 = 0").orderBy(F.xxhash64("node"), "node").limit(AUDITED)
    rows = asked.join(counts, "node", "left").select("node", "unit", F.coalesce("n", F.lit(0)).alias("n")).collect()
    if not rows:
        return 1.0
    shared = nodes.sparkSession.sparkContext.broadcast(np.stack([np.frombuffer(r.unit, dtype=np.float64) for r in rows]))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        total = np.zeros(len(q), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                total += (q @ _matrix(part["unit"]).T >= COSINE).sum(axis=1)
        yield pa.RecordBatch.from_pydict({"q": np.arange(len(q)), "n": total})

    there = nodes.select("unit").mapInArrow(compared, "q bigint, n bigint").groupBy("q").agg(F.sum("n").alias("n"))
    truth = {r.q: r.n - 1 for r in there.collect()}  # a row per audited vector
    links = sum(truth.values())
    return sum(max(0, min(r.n - 1, truth[k])) for k, r in enumerate(rows)) / links if links > 0 else 1.0


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding).

    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing, nor do rows without an id; these are their own component. Vectors of different
    lengths are never linked. Equal vectors are searched once and count as links of each
    other. Other columns are not looked at. An empty table gives an empty result.
    """
    importable(vectors.sparkSession)
    units = stage(unit_vectors(vectors), "units")
    distinct = units.groupBy("unit").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    named = stage(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = None
    sizes = named.groupBy(F.octet_length("unit").alias("w")).agg(F.count(F.lit(1)).alias("n")).collect()
    for w, n in sorted(sizes):  # one length as a rule
        mine = named.filter(F.octet_length("unit") == w)
        centre = centres(mine, n)
        for shards, beam in EFFORTS:
            links = stage(searched(mine.select("node", "weight", "unit"), centre, shards, beam), "found")
            recall = audited_recall(mine, links.groupBy(F.col("a").alias("node")).agg(F.sum("met").alias("n")))
            if recall >= RECALL:
                break
        else:
            # All in one cluster, whose parts meet each other.
            links = stage(searched(mine.select("node", "weight", "unit"), centre[:1], 1, None), "found")
        found = links if found is None else found.unionAll(links)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    if found is None:
        alone = F.lit(0).cast("bigint")
        return rows.select("vec_id", alone.alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    roots = components(found.select("a", "b"))
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    placed = named.select("node", "rep", "weight").join(counts, "node", "left").join(roots, "node", "left")
    placed = placed.select(
        "node", "rep", (F.coalesce("n", "weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = placed.join(least, "root").select("node", "n_links", "component_id")
    linked = units.join(named.select("unit", "node"), "unit").select("vec_id", "node").join(classes, "node")
    known = linked.select("vec_id", "n_links", "component_id")
    others = rows.join(units.select("vec_id").distinct(), "vec_id", "left_anti").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return known.unionAll(others).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
