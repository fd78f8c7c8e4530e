"""Removal of every byte inside a long string that occurs twice, by refining suffix buckets.

Suffixes fall into buckets by their first bytes, and a bucket is refined by the bucket ids
of the same suffixes at a later offset: two ids of 8 bytes make one of 16, two of those
one of 32, and so on to ``LENGTH``, each level reusing the ids of the one before. Only
buckets with more than one member are refined.

To do that without a row per byte, buckets of ``GRAM`` bytes are first kept at anchors
alone: of the grams inside each string of ``LENGTH`` bytes, the one whose id sorts first.
Equal strings have equal anchors in equal places, so a string can only repeat where its
anchor's bucket has another member. An anchor's strings lie side by side; if that whole
stretch repeats, all of them do. Only where it does not are single strings compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import forget, importable
from threadlens.sources.tables import drop_stage, stage

LENGTH = 200
GRAM = 32
INSIDE = LENGTH - GRAM + 1
#: Bytes looked at together; longer documents are looked at in overlapping pieces.
PIECE = 1 << 17

# Odd multipliers that mix two ids into one.
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64((1 << 22) - 1)


def mixed(first: np.ndarray, later: np.ndarray) -> np.ndarray:
    """The bucket id of a suffix from its id and the id at a later offset."""
    h = first * _A
    h ^= h >> np.uint64(32)
    h += later
    h *= _B
    h ^= h >> np.uint64(29)
    return h


class Buckets:
    """Bucket ids of all suffixes of a piece, level by level."""

    def __init__(self, raw: bytes):
        self.size = len(raw)
        padded = raw + bytes(16)
        first = np.empty(self.size, dtype=np.uint64)
        for k in range(8):
            part = np.frombuffer(padded, dtype="<u8", offset=k, count=(len(padded) - k) // 8)
            mine = first[k::8]
            mine[:] = part[: len(mine)]
        self.levels = {8: first[: max(0, self.size - 7)]}

    def ids(self, width: int) -> np.ndarray:
        """Ids of the first ``width`` bytes; the last ``width - 1`` suffixes of the piece have none."""
        if width not in self.levels:
            half = 1 << ((width - 1).bit_length() - 1)
            below = self.ids(half)
            n = self.size - width + 1
            self.levels[width] = mixed(below[:n], below[width - half :][:n])
        return self.levels[width]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    span, least = 1, values
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return np.minimum(least[: len(values) - width + 1], least[width - span :]) if span < width else least


def anchors(raw: bytes, real: np.ndarray) -> dict[str, np.ndarray]:
    """The anchors of a piece: gram id, id of the whole stretch, place and first and last string.

    ``real`` tells for each place whether a string of ``LENGTH`` bytes starts there.
    """
    buckets = Buckets(raw)
    gram = buckets.ids(GRAM)
    place = np.arange(len(gram), dtype=np.uint64)
    # Low bits hold the place, so that the first of equal grams sorts first.
    least = sliding_least((gram & ~_PLACE) | place, INSIDE)
    at = (least & _PLACE).astype(np.int64)
    real = real[: len(at)]
    fresh = np.append(True, at[1:] != at[:-1]) | np.append(True, ~real[:-1])
    first = np.flatnonzero(fresh & real)
    ending = np.append(fresh[1:], True) | np.append(~real[1:], True)
    last = np.flatnonzero(ending & real)
    spot = at[first]
    end = last + LENGTH
    whole = (end - first).astype(np.uint64) * _B + (spot - first).astype(np.uint64)
    for k in range(-(-(LENGTH + INSIDE) // GRAM)):
        whole = mixed(whole, gram[np.minimum(first + GRAM * k, end - GRAM)])
    return {"gram": gram[spot], "whole": whole, "at": spot, "first": first, "last": last}


def pieces(texts: list[tuple[int, bytes]]) -> Iterator[tuple[bytes, np.ndarray, list[tuple[int, int, int, int, int]]]]:
    """Documents (row, bytes) side by side: bytes, where strings start, and the parts.

    A part is its start, row, place in the document, and the places between which its
    stretches begin. A document of more than ``PIECE`` bytes comes in several parts with
    margins, so that each stretch lies whole in the part in which it begins.
    """
    raws: list[bytes] = []
    parts: list[tuple[int, int, int, int, int]] = []
    size = 0
    for row, raw in texts:
        for base in range(0, max(0, len(raw) - LENGTH + 1), PIECE):
            begin = max(0, base - INSIDE)
            part = raw[begin : base + PIECE + INSIDE + LENGTH]
            if raws and size + len(part) > 2 * PIECE:
                yield _piece(raws, parts)
                raws, parts, size = [], [], 0
            raws.append(part)
            parts.append((size, row, begin, base, base + PIECE))
            size += len(part)
    if raws:
        yield _piece(raws, parts)


def _piece(raws: list[bytes], parts: list) -> tuple[bytes, np.ndarray, list]:
    joined = b"".join(raws)
    real = np.zeros(len(joined), dtype=bool)
    for raw, (start, *_) in zip(raws, parts):
        real[start : start + len(raw) - LENGTH + 1] = True
    return joined, real, parts


def _batched(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[list[tuple]]:
    """Rows (row, bytes, ...) by about ``PIECE`` bytes."""
    some, size = [], 0
    for batch in batches:
        rest = [batch[c] for c in more]
        for k, (row, text) in enumerate(zip(batch["row"].to_pylist(), batch["text"])):
            raw = (text.as_py() or "").encode()
            some.append((row, raw, *[c[k] for c in rest]))
            size += len(raw)
            if size >= PIECE:
                yield some
                some, size = [], 0
    if some:
        yield some


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some in _batched(batches):
        for raw, real, parts in pieces(some):
            found = anchors(raw, real)
            start, row, begin, lowest, end = np.array(parts, dtype=np.int64).T
            part = np.searchsorted(start, found["first"], side="right") - 1
            shift = (begin - start)[part]
            first = found["first"] + shift
            mine = (first >= lowest[part]) & (first < end[part])
            columns = {
                "row": row[part], "gram": _signed(found["gram"]), "whole": _signed(found["whole"]),
                "at": found["at"] + shift, "first": first, "last": found["last"] + shift,
            }
            yield pa.RecordBatch.from_pydict({name: values[mine] for name, values in columns.items()})


#: An anchor's strings by how far before the anchor they start: segments of so many offsets.
SEGMENT = 22


def _regions(raw: bytes, lows: np.ndarray, highs: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Slices of a text side by side, and where each starts."""
    sizes = highs - lows
    return b"".join([raw[a:b] for a, b in zip(lows.tolist(), highs.tolist())]), np.cumsum(sizes) - sizes


def _listed(cell: pa.StructScalar, *names: str) -> list[np.ndarray]:
    values = cell.values
    return [values.field(n).to_numpy(zero_copy_only=False) for n in names]


def _side_by_side(some: list[tuple], names: tuple[str, ...], reach) -> tuple[Buckets, dict[str, np.ndarray]]:
    """The regions that listed places of several texts need, and their columns with ``row`` and ``zero``,
    the place in the regions that stands for the start of the text."""
    raws, columns, size = [], [], 0
    for row, raw, cell in some:
        listed = dict(zip(names, _listed(cell, *names)))
        lows, highs = reach(listed, len(raw))
        joined, starts = _regions(raw, lows, highs)
        listed |= {"row": np.full(len(lows), row), "zero": size + starts - lows, "low": lows, "high": highs}
        raws.append(joined)
        columns.append(listed)
        size += len(joined)
    return Buckets(b"".join(raws)), {n: np.concatenate([c[n] for c in columns]) for n in columns[0]}


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per anchor and segment of its strings: the ids of what all of them hold and of all they span."""

    def reach(x, size):
        return np.maximum(0, x["first"] - SEGMENT), np.minimum(size, x["last"] + LENGTH + SEGMENT)

    names = ("gram", "at", "first", "last", "need")
    for some in _batched(batches, "places"):
        buckets, x = _side_by_side(some, names, reach)
        shared, spanned = buckets.ids(LENGTH - SEGMENT + 1), buckets.ids(LENGTH + SEGMENT - 1)
        for segment in range(-(-INSIDE // SEGMENT)):
            near, far = segment * SEGMENT, segment * SEGMENT + SEGMENT - 1
            mine = (x["at"] - x["last"] <= far) & (x["at"] - x["first"] >= near)
            at, zero = x["at"][mine], x["zero"][mine]
            fits = (at - far >= x["low"][mine]) & (at - near + LENGTH <= x["high"][mine])
            span = spanned[np.where(fits, at - far + zero, 0)] if len(spanned) else np.zeros(len(at), np.uint64)
            columns = {
                "row": pa.array(x["row"][mine]), "gram": pa.array(x["gram"][mine]), "at": pa.array(at),
                "segment": pa.array(np.full(len(at), segment)),
                "first": pa.array(np.maximum(x["first"][mine], at - far)),
                "last": pa.array(np.minimum(x["last"][mine], at - near)),
                "core": pa.array(_signed(shared[at - near + zero])),
                "span": pa.array(_signed(span), mask=~fits),
                "need": pa.array(x["need"][mine]),
            }
            yield pa.RecordBatch.from_pydict(columns)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of the listed segments: two ids that tell it apart, and its place."""

    def reach(x, size):
        return x["first"], x["last"] + LENGTH

    names = ("gram", "at", "first", "last", "need")
    for some in _batched(batches, "places"):
        buckets, x = _side_by_side(some, names, reach)
        whole = buckets.ids(LENGTH)
        count = x["last"] - x["first"] + 1
        which = np.repeat(np.arange(len(count)), count)
        place = x["first"][which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        offset = (x["at"][which] - place).astype(np.uint64)
        columns = {
            "row": x["row"][which], "key": _signed(mixed(x["gram"][which].view(np.uint64), offset)),
            "string": _signed(whole[place + x["zero"][which]]), "place": place, "need": x["need"][which],
        }
        yield pa.RecordBatch.from_pydict(columns)


def _counted(rows: DataFrame, bucket: list[str], n: str, first: str | None = None) -> DataFrame:
    """Rows with the size of their bucket, and if wanted whether they are its first member.

    Sizes are folded before they are shuffled, and joined back by a join that adaptive
    execution can split on a hot bucket.
    """
    order = F.min(F.struct("row", "at")).alias("_first")
    sizes = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias(n), *([order] if first else []))
    found = rows.join(sizes, bucket)
    if first:
        found = found.withColumn(first, (F.col("_first.row") == F.col("row")) & (F.col("_first.at") == F.col("at"))).drop("_first")
    return found


def _per_text(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(row, text, places): texts with the anchors listed for them, no more than a text has."""
    listed = F.collect_list(F.struct("gram", "at", "first", "last", "need")).alias("places")
    return docs.select("row", "text").join(places.groupBy("row").agg(listed), "row")


def repeated_starts(docs: DataFrame) -> DataFrame:
    """(row, first, last): ranges of places at which a repeated string starts, as a written table.

    ``docs`` (row, text) is a written table whose ``row`` tells rows apart. Texts are read
    once for the anchors, and those with open buckets once for each of two refinements.
    """
    spark = importable(docs.sparkSession)
    found = stage(
        docs.select("row", "text").mapInArrow(
            _anchors, "row bigint, gram bigint, whole bigint, at bigint, first bigint, last bigint"
        ),
        "anchors",
    )
    grams = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    open_ = stage(found.join(grams, "gram", "left_semi"), "open-anchors")
    drop_stage(found)
    forget(spark)

    sized = stage(_counted(open_, ["gram", "whole"], "n", "leads"), "anchor-buckets")
    drop_stage(open_)
    done = [sized.filter("n > 1").select("row", "first", "last")]
    alone = sized.filter("n = 1").select("gram").distinct()
    members = sized.filter("n = 1 or leads").join(alone, "gram", "left_semi")
    members = members.select("row", "gram", "at", "first", "last", (F.col("n") == 1).alias("need"))
    segments = stage(
        _per_text(docs, members).mapInArrow(
            _segments,
            "row bigint, gram bigint, at bigint, segment bigint, first bigint, last bigint, core bigint, span bigint, need boolean",
        ),
        "segments",
    )
    forget(spark)

    spans = segments.filter("span is not null")
    sizes = spans.groupBy("gram", "segment", "span").agg(
        F.count(F.lit(1)).alias("m"), F.min(F.struct("row", "at")).alias("lead")
    )
    same = ["gram", "segment", "core"]
    cores = segments.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*same)
    known = segments.join(cores, same, "left_semi").join(sizes, ["gram", "segment", "span"], "left")
    leads = (F.col("lead.row") == F.col("row")) & (F.col("lead.at") == F.col("at"))
    known = stage(known.withColumn("m", F.coalesce("m", F.lit(1))).withColumn("leads", leads).drop("lead"), "segment-buckets")
    drop_stage(segments)
    done.append(known.filter("need and m > 1").select("row", "first", "last"))
    alone = known.filter("need and m = 1").select(*same).distinct()
    members = known.filter("m = 1 or leads").join(alone, same, "left_semi")
    members = members.select("row", "gram", "at", "first", "last", (F.col("need") & (F.col("m") == 1)).alias("need"))
    strings = stage(
        _per_text(docs, members).mapInArrow(
            _strings, "row bigint, key bigint, string bigint, place bigint, need boolean"
        ),
        "strings",
    )
    forget(spark)

    again = strings.groupBy("key", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "string")
    found = strings.filter("need").join(again, ["key", "string"], "left_semi")
    done.append(found.select("row", F.col("place").alias("first"), F.col("place").alias("last")))
    starts = stage(done[0].unionAll(done[1]).unionAll(done[2]), "repeats")
    for used in (sized, known, strings):
        drop_stage(used)
    forget(spark)
    return starts


def covered(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by the strings that start from first to last."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate(last[order] + LENGTH)
    fresh = np.append(True, start[1:] > end[:-1])
    return start[fresh], end[np.append(fresh[1:], True)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sizes, removed, spans = [], [], [], []
        for text, cell in zip(batch["text"], batch["places"]):
            raw = (text.as_py() or "").encode()
            sizes.append(len(raw))
            if cell.values is None or not len(cell.values):
                kept.append(raw)
                removed.append(0)
                spans.append(0)
                continue
            start, end = covered(*_listed(cell, "first", "last"))
            edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(raw)]
            kept.append(b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2])]))
            removed.append(int((end - start).sum()))
            spans.append(len(start))
        columns = {
            "doc_id": batch["doc_id"], "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
            "kept": pa.array(kept, pa.binary()),
        }
        yield pa.RecordBatch.from_pydict(columns)


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) per row of ``docs`` (doc_id, text).

    ``kept`` holds the remaining UTF-8 bytes, which may start or end inside a character.
    Null and empty texts have no bytes and stay empty. Equal rows repeat each other, whatever
    their ids. Texts of fewer than ``LENGTH`` bytes are kept whole. Other columns are not
    looked at. An empty table gives an empty result.
    """
    wanted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stage(wanted.withColumn("row", F.monotonically_increasing_id()), "texts")
    places = repeated_starts(rows).groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("places"))
    joined = rows.join(places, "row", "left").select("doc_id", "text", "places")
    return joined.mapInArrow(_cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def repeat_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of ``without_repeats``."""
    found = without_repeats(docs)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
