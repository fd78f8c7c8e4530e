"""Near copies by SimHash: fingerprints, and a self-join that walks a binary trie of them.

Two fingerprints that differ in at most ``BITS`` of 64 bits agree in one of ``BITS + 1``
blocks. So every fingerprint goes once to each block's task, turned so that the block
comes first; fingerprints that share the block form one subtrie, which is walked in pairs
of nodes from the block down. A pair adds up the bits in which it differs and is dropped
as soon as they exceed the budget.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import importable
from threadlens.llm.components import components, join_roots
from threadlens.sources.tables import stage

BITS = 4
WORDS = 4
SEED = 42

# Blocks of the 64 bits: first bit and width.
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
#: A block value with more fingerprints is cut further, by pairs of deeper nodes.
HOT = 20_000
#: Pairs of nodes with at most so many pairs of fingerprints are compared directly.
LEAF = 64
ROWS = 200_000
FRONTIER = 500_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None) -> int:
    """SimHash of the 4-word shingles, repeats included; 0 for a text without words."""
    from xxhash import xxh64_digest

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(WORDS, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), 1 << 14):
        hashes = b"".join([xxh64_digest(joined[s:e], SEED) for s, e in zip(starts[at : at + (1 << 14)], ends[at:])])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(text.as_py()) for text in batch["text"]]
        others = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*(batch[name] for name in others), pa.array(found, pa.int64())], [*others, "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of documents (doc_id, text); a null text has no words."""
    importable(docs.sparkSession)
    wanted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


def turned(code: np.ndarray, by: int) -> np.ndarray:
    """Bits rotated left."""
    return (code << np.uint64(by)) | (code >> np.uint64((64 - by) % 64)) if by else code


class Subtries:
    """The subtries of one task, as ranges of sorted codes."""

    def __init__(self, code: np.ndarray, group: np.ndarray):
        self.code = code
        self.label = np.arange(len(code))
        differ = code[1:] ^ code[:-1]
        # Leading bits that neighbours share; neighbours of different groups share none.
        whole = np.where(differ == 0, 64, 64 - _bit_length(differ))
        self.shared = np.concatenate([[-1], np.where(group[1:] != group[:-1], -1, whole)])
        self.starts: dict[int, np.ndarray] = {}

    def nodes(self, depth: int) -> np.ndarray:
        """Where the nodes at a depth start, and the end."""
        if depth not in self.starts:
            self.starts[depth] = np.append(np.flatnonzero(self.shared < depth), len(self.code))
        return self.starts[depth]

    def verify(self, a, a_end, b, b_end) -> None:
        """Compare all fingerprints of pairs of small nodes; link those within the budget."""
        wide, count = b_end - b, (a_end - a) * (b_end - b)
        for first, last in _slices(count, 4 << 20):
            n, w = count[first:last], wide[first:last]
            which = np.repeat(np.arange(len(n)), n)
            k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            i, j = a[first:last][which] + k // w[which], b[first:last][which] + k % w[which]
            near = (i < j) & (np.bitwise_count(self.code[i] ^ self.code[j]) <= BITS)
            self.label = join_roots(self.label, i[near], j[near])

    def walk(self, seeds: dict[int, list[tuple[int, int, int, int, int]]]) -> None:
        """Walk pairs of nodes down from the seeds: depth -> (start, end, start, end, differing bits)."""
        work = [(depth, np.array(pairs, dtype=np.int64).T) for depth, pairs in seeds.items()]
        while work:
            depth, pairs = work.pop()
            if pairs.shape[1] > FRONTIER:
                half = pairs.shape[1] // 2
                work += [(depth, pairs[:, :half]), (depth, pairs[:, half:])]
                continue
            a, a_end, b, b_end, _ = pairs
            small = ((a_end - a) * (b_end - b) <= LEAF) | (depth == 64)
            if small.any():
                self.verify(a[small], a_end[small], b[small], b_end[small])
                pairs = pairs[:, ~small]
            if pairs.shape[1]:
                work.append((depth + 1, self.children(depth, pairs)))

    def children(self, depth: int, pairs: np.ndarray) -> np.ndarray:
        a, a_end, b, b_end, differ = pairs
        below = self.nodes(depth + 1)
        a_mid = np.minimum(below[np.searchsorted(below, a, side="right")], a_end)
        b_mid = np.minimum(below[np.searchsorted(below, b, side="right")], b_end)
        bit = np.uint64(63 - depth)
        parts = []
        for x, x_end in ((a, a_mid), (a_mid, a_end)):
            for y, y_end in ((b, b_mid), (b_mid, b_end)):
                real = (x < x_end) & (y < y_end) & (x <= y)  # of two mirrored pairs one will do
                x1, y1 = x[real], y[real]
                now = differ[real] + (((self.code[x1] ^ self.code[y1]) >> bit) & np.uint64(1)).astype(np.int64)
                within = now <= BITS
                parts.append(np.stack([x1, x_end[real], y1, y_end[real], now])[:, within])
        return np.concatenate(parts, axis=1)


def _bit_length(x: np.ndarray) -> np.ndarray:
    length = np.zeros(len(x), dtype=np.int64)
    x = x.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = x >> np.uint64(step) > 0
        length[big] += step
        x[big] >>= np.uint64(step)
    return length + (x > 0)


def _slices(count: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive slices whose counts add up to about ``most``."""
    total = np.cumsum(count)
    first = 0
    while first < len(count):
        spent = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, spent + most, side="right")))
        yield first, last
        first = last


def _links_of(block: np.ndarray, width: np.ndarray, x: np.ndarray, y: np.ndarray, code: np.ndarray, value: np.ndarray):
    """Forest links of whole groups of rows sorted by (block, value, x, y, code)."""
    keys = np.stack([block, value, x, y])
    fresh = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
    first = np.flatnonzero(fresh)
    ends = np.append(first[1:], len(code))
    tries = Subtries(code, np.cumsum(fresh))
    seeds: dict[int, list] = {}
    for lo, hi in zip(first.tolist(), ends.tolist()):
        if hi - lo < 2:
            continue
        depth = BLOCKS[block[lo]][1]
        if x[lo] == y[lo]:
            seeds.setdefault(depth, []).append((lo, hi, lo, hi, 0))
            continue
        deeper = depth + int(width[lo])
        mine = (code[lo:hi] >> np.uint64(64 - deeper)) & np.uint64((1 << int(width[lo])) - 1)
        mid = lo + int(np.searchsorted(mine, np.uint64(y[lo])))
        if lo < mid < hi:
            seeds.setdefault(deeper, []).append((lo, mid, mid, hi, int(x[lo] ^ y[lo]).bit_count()))
    tries.walk(seeds)
    linked = np.flatnonzero(tries.label != np.arange(len(code)))
    a, b = code[linked], code[tries.label[linked]]
    for k, (start, _) in enumerate(BLOCKS):
        mine = block[linked] == k
        a[mine], b[mine] = turned(a[mine], (64 - start) % 64), turned(b[mine], (64 - start) % 64)
    return a.view(np.int64), b.view(np.int64)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups at a time, about ``ROWS`` rows together."""
    kept: list[list[np.ndarray]] = []

    def done(columns) -> pa.RecordBatch:
        a, b = _links_of(*columns)
        return pa.RecordBatch.from_pydict({"a": a, "b": b})

    for batch in batches:
        block, width, x, y, value = (
            batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("block", "width", "x", "y", "value")
        )
        code = batch["code"].to_numpy(zero_copy_only=False).view(np.uint64)
        kept.append([block, width, x, y, code, value])
        if sum(len(k[0]) for k in kept) < ROWS:
            continue
        columns = [np.concatenate(c) for c in zip(*kept)]
        keys = np.stack([columns[k] for k in (0, 5, 2, 3)])
        open_at = int(np.append(np.flatnonzero((keys[:, :-1] != keys[:, -1:]).any(axis=0)) + 1, 0).max())
        if np.any((keys[:, :-1] != keys[:, -1:]).any(axis=0)):
            yield done([c[:open_at] for c in columns])
            kept = [[c[open_at:] for c in columns]]
        else:
            kept = [columns]
    if kept:
        yield done([np.concatenate(c) for c in zip(*kept)])


def near_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` within ``BITS`` bits of each other.

    The links are a forest per task: of the fingerprints that one subtrie joins, each is
    linked to the smallest, which loses no connection. Block values with more than ``HOT``
    fingerprints are cut by the bits that follow: a task then holds one pair of deeper
    nodes, and a fingerprint goes to the pairs whose nodes differ within the budget. The
    sizes that decide are those of at most 40,960 block values, so they are broadcast.
    """
    importable(distinct.sparkSession)
    blocks = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(k).alias("block"),
                    F.lit(bits).alias("bits"),
                    (
                        F.shiftleft("fp", start).bitwiseOR(F.shiftrightunsigned("fp", 64 - start)) if start else F.col("fp")
                    ).alias("code"),
                )
                for k, (start, bits) in enumerate(BLOCKS)
            ]
        )
    )
    rows = distinct.select(blocks.alias("r")).select(
        "r.*", F.expr("cast(shiftrightunsigned(r.code, 64 - r.bits) as int)").alias("value")
    )
    sizes = rows.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n"))
    hot = sizes.filter(F.col("n") > HOT).select(
        "block", "value", F.least(F.ceil(F.log2(F.col("n") / HOT)), F.lit(12)).cast("int").alias("width")
    )
    sized = rows.join(F.broadcast(hot), ["block", "value"], "left").withColumn("width", F.coalesce("width", F.lit(0)))
    node = F.expr("cast(shiftrightunsigned(code, 64 - bits - width) & (shiftleft(1, width) - 1) as int)")
    masks = F.expr(f"filter(sequence(0, shiftleft(1, width) - 1), m -> bit_count(m) <= {BITS})")
    paired = sized.withColumn("node", node).withColumn("mask", F.explode(masks))
    other = F.col("node").bitwiseXOR(F.col("mask"))
    tasks = paired.select(
        "block", "value", "width", F.least("node", other).alias("x"), F.greatest("node", other).alias("y"), "code"
    )
    # Sorting by sign-flipped codes puts them in unsigned order.
    unsigned = F.col("code").bitwiseXOR(F.lit(-(1 << 63)))
    dealt = tasks.repartition("block", "value", "x", "y").sortWithinPartitions("block", "value", "x", "y", unsigned)
    return dealt.select("block", "width", "x", "y", "value", "code").mapInArrow(_joined, "a bigint, b bigint")


def classes(prints: DataFrame) -> DataFrame:
    """(fp, component_id, root): the smallest doc_id that each distinct fingerprint reaches, and its class.

    ``prints`` (doc_id, fp) is read several times, so it should be a written table. Null
    doc_ids take part but name no component; one of null ids alone has a null id.
    """
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    found = components(near_links(distinct.select("fp")))
    members = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    named = members.groupBy("root").agg(F.min("first").alias("component_id"))
    return members.join(named, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs`` (doc_id, text).

    Texts without words, null ones included, have fingerprint zero, linked like any other.
    Rows that repeat a doc_id stay rows. Other columns are not looked at. An empty table
    gives an empty result.
    """
    prints = stage(fingerprints(docs), "fingerprints")
    return prints.join(classes(prints), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class of near copies, with all its columns: that of smallest doc_id.

    Rows that repeat a doc_id are documents of their own unless they are near copies; within
    one class and doc_id the text of least digest stays, and of rows with the same doc_id
    and text one, whatever columns of whatever type they have besides. Rows without a doc_id cannot be named
    as copies; they are compared but stay.
    """
    longest = "_" * max(len(c) for c in docs.columns)
    digest, copies = f"{longest}_digest", f"{longest}_copies"
    text = F.col("text").cast("string")
    named = docs.withColumn(digest, F.coalesce(F.md5(text), F.lit("-")))
    wanted = named.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.col(digest).alias("digest"))
    importable(docs.sparkSession)
    prints = stage(wanted.mapInArrow(_fingerprints, "doc_id bigint, digest string, fp bigint"), "fingerprints")
    counted = prints.filter("doc_id is not null").groupBy("fp", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    first = counted.join(classes(prints), "fp").groupBy("root").agg(F.min(F.struct("doc_id", "digest", "n")).alias("f"))
    kept = stage(first.select("f.doc_id", F.col("f.digest").alias(digest), F.col("f.n").alias(copies)), "kept")

    def rows(which: str) -> DataFrame:
        return named.join(kept.filter(f"{copies} {which} 1"), ["doc_id", digest])

    # Equal texts of one doc_id are folded on the map side, so they may be any share of the rows.
    whole = F.struct(*docs.columns)
    folded = rows(">").groupBy("doc_id", digest).agg(F.min_by(whole, F.to_json(whole)).alias(copies))
    one = rows("=").select(*docs.columns).unionByName(folded.select(f"{copies}.*"))
    return one.unionByName(docs.filter(F.col("doc_id").isNull()))
