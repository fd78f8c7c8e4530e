"""Benchmark passages in documents, by a prefix-filtered join on rare shingles.

An item's windows are its runs of ``WINDOW`` words. A window can only occur where all of
its shingles do, so it is looked up by one alone: the one that is rarest in the corpus.
Where that shingle stands in a document, its offset says where the window would start;
windows that would not fit are dropped, and the rest are compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.common import columns_free_of, importable
from threadlens.sources.tables import stage

WINDOW = 10
SHINGLE = 5
#: Bytes of windows that are broadcast together; larger benchmarks take several passes.
BLOCK_BYTES = 16 << 20

# Letters and digits as they are, capitals lowered, bytes of other scripts kept, the rest blank.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_MIX = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def windows_of(items: DataFrame) -> DataFrame:
    """(item_id, window): each item's distinct windows as words joined by blanks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch["item_id"].to_pylist(), batch["text"]):
                words = words_of(text.as_py())
                width = min(WINDOW, len(words))
                found = {b" ".join(words[i : i + width]).decode() for i in range(len(words) - width + 1)} if words else ()
                if found:
                    ids = pa.array([item_id] * len(found), pa.int64())
                    yield pa.RecordBatch.from_pydict({"item_id": ids, "window": pa.array(found, pa.string())})

    wanted = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(cut, "item_id bigint, window string").distinct()


def shingle_keys(ids: np.ndarray, width: int) -> np.ndarray:
    """One number per run of ``width`` word numbers; different runs may share it."""
    n = len(ids) - width + 1
    keys = np.zeros(max(0, n), dtype=np.uint64)
    for k in range(width if n > 0 else 0):
        keys = keys * np.uint64(_MIX) + ids[k : k + n].astype(np.uint64) + np.uint64(1)
    return keys


class Block:
    """Windows of a part of the benchmark, ready to be looked up."""

    def __init__(self, rows: list[tuple[str, list[int]]]):
        self.numbers: dict[bytes, int] = {}
        self.windows: list[np.ndarray] = []
        self.items = [sorted(items) for _, items in rows]
        for window, _ in rows:
            words = window.encode().split(b" ")
            self.windows.append(np.array([self.numbers.setdefault(w, len(self.numbers)) for w in words], dtype=np.int64))
        self.lengths = np.array([len(w) for w in self.windows], dtype=np.int64)
        self.counted: dict[int, np.ndarray] = {}
        for width in {self.shingle(w) for w in self.windows}:
            keys = [shingle_keys(w, width) for w in self.windows if self.shingle(w) == width]
            self.counted[width] = np.unique(np.concatenate(keys))
        self.lookup: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    @staticmethod
    def shingle(window: np.ndarray) -> int:
        return min(SHINGLE, len(window))

    def numbered(self, words: list[bytes]) -> np.ndarray:
        """Word numbers; -1 for words that no window has."""
        return np.fromiter(map(self.numbers.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def places(self, ids: np.ndarray, width: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose shingle is wanted, and which one it is."""
        if len(ids) < width:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        at = np.flatnonzero(known[width:] - known[:-width] == width)
        keys = shingle_keys(ids, width)[at]
        which = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
        real = wanted[which] == keys
        return at[real], which[real]

    def count(self, words: list[bytes], totals: dict[int, np.ndarray]) -> None:
        ids = self.numbered(words)
        for width, wanted in self.counted.items():
            np.add.at(totals[width], self.places(ids, width, wanted)[1], 1)

    def choose(self, totals: dict[int, np.ndarray]) -> None:
        """Give each window its rarest shingle, the first of equally rare ones."""
        chosen: dict[int, list[tuple[int, int, int]]] = {}
        for number, window in enumerate(self.windows):
            width = self.shingle(window)
            keys = shingle_keys(window, width)
            rarity = totals[width][np.searchsorted(self.counted[width], keys)]
            offset = int(rarity.argmin())
            chosen.setdefault(width, []).append((int(keys[offset]), number, offset))
        for width, found in chosen.items():
            found.sort()
            keys = np.array([k for k, _, _ in found], dtype=np.uint64)
            self.lookup[width] = keys, np.array([n for _, n, _ in found]), np.array([o for _, _, o in found])

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(window number, first word) of all occurrences."""
        ids = self.numbered(words)
        numbers, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for width, (keys, which, offset) in self.lookup.items():
            distinct, first = np.unique(keys, return_index=True)
            size = np.diff(np.append(first, len(keys)))
            at, key = self.places(ids, width, distinct)
            n = size[key]
            row = np.repeat(first[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            begin, number = np.repeat(at, n) - offset[row], which[row]
            fits = (begin >= 0) & (begin + self.lengths[number] <= len(ids))
            begin, number = begin[fits], number[fits]
            for length in np.unique(self.lengths[number]).tolist():
                mine = self.lengths[number] == length
                b, k = begin[mine], number[mine]
                same = (ids[b[:, None] + np.arange(length)] == np.stack([self.windows[x] for x in k.tolist()])).all(axis=1)
                numbers.append(k[same])
                starts.append(b[same])
        return np.concatenate(numbers), np.concatenate(starts)


def blocks_of(docs: DataFrame, items: DataFrame) -> Iterator[Block]:
    """The benchmark's windows in blocks of bounded size, with rarity counted over all documents."""
    spark = importable(docs.sparkSession)
    windows = stage(windows_of(items), "windows")
    size = windows.agg(F.sum(F.octet_length("window") + 8)).first()[0] or 0
    parts = -(-size // BLOCK_BYTES)
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("window", "item_id"), F.lit(max(1, parts))))
    for part in range(parts):
        rows = (
            dealt.filter(F.col("part") == part).groupBy("window").agg(F.collect_list("item_id").alias("items")).orderBy("window")
        )
        block = Block([(r.window, r["items"]) for r in rows.collect()])
        if not block.windows:
            continue
        shared = spark.sparkContext.broadcast(block)

        def counted(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            totals = {width: np.zeros(len(keys), dtype=np.int64) for width, keys in block.counted.items()}
            for batch in batches:
                for text in batch["text"]:
                    block.count(words_of(text.as_py()), totals)
            for width, total in totals.items():
                some = np.flatnonzero(total)
                widths = np.full(len(some), width, dtype=np.int64)
                yield pa.RecordBatch.from_pydict({"width": widths, "place": some, "n": total[some]})

        texts = docs.select(F.col("text").cast("string").alias("text"))
        per_shingle = texts.mapInArrow(counted, "width bigint, place bigint, n bigint").groupBy("width", "place")
        totals = {width: np.zeros(len(keys), dtype=np.int64) for width, keys in block.counted.items()}
        for r in per_shingle.agg(F.sum("n").alias("n")).collect():  # no more rows than the block has shingles
            totals[r.width][r.place] = r.n
        block.choose(totals)
        yield block


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)
_ARROW = pa.struct(
    [("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.int64()))]
)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Spans without overlaps, in order."""
    if not len(starts):
        return [], []
    order = np.lexsort([ends, starts])
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.append(True, starts[1:] > ends[:-1])
    return starts[fresh].tolist(), ends[np.append(fresh[1:], True)].tolist()


def _found(block: Block, text: str | None, before: dict | None) -> dict:
    words = words_of(text)
    numbers, starts = block.find(words)
    ends = starts + block.lengths[numbers]
    items = {i for k in set(numbers.tolist()) for i in block.items[k]}
    if before:
        starts, ends = np.append(before["starts"], starts).astype(np.int64), np.append(before["ends"], ends).astype(np.int64)
        items |= set(before["items"])
    first, last = merged(starts, ends)
    return {"n_words": len(words), "starts": first, "ends": last, "items": sorted(items)}


def with_hits(docs: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """``docs`` with a struct column: n_words, word spans inside window occurrences, items that occur.

    The documents are read once to count and once to look up per block of the benchmark;
    nothing is shuffled. Null and empty texts have no words. Items of null or empty text
    have no windows; of an item with a null id the words are hit, but no item is listed.
    Rows that repeat an item_id are one item. Without windows nothing is hit.
    """
    spark = importable(docs.sparkSession)
    words_only = Block([])
    found, any_block = docs.withColumn(name, F.lit(None).cast(FOUND)), False
    for block in blocks_of(docs, items):
        found = _add_hits(stage(found, "hits") if any_block else found, spark.sparkContext.broadcast(block), name)
        any_block = True
    return found if any_block else _add_hits(found, spark.sparkContext.broadcast(words_only), name)


def _add_hits(docs: DataFrame, shared, name: str) -> DataFrame:
    @F.arrow_udf(FOUND)
    def hits(texts: pa.Array, before: pa.Array) -> pa.Array:
        block = shared.value
        return pa.array([_found(block, t.as_py(), b.as_py()) for t, b in zip(texts, before)], _ARROW)

    return docs.withColumn(name, hits(F.col("text").cast("string"), F.col(name)))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row of ``docs`` (doc_id, text)."""
    found = with_hits(docs.select("doc_id", "text"), items, "h")
    n_hit = F.expr("aggregate(zip_with(h.ends, h.starts, (e, s) -> e - s), 0L, (t, n) -> t + n)")
    listed = F.array_join(F.array_sort(F.transform("h.items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("h.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("h.items").cast("bigint").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any window of the benchmark, with all their columns."""
    own = columns_free_of(["h"], docs.columns)["h"]
    return with_hits(docs, items, own).filter(F.size(F.col(f"`{own}`.starts")) == 0).drop(own)
