"""Fuzzy repeats of lines by MinHash.

A line is the set of its runs of ``SHINGLE`` characters. Each shingle's hash puts it in one
of ``BINS`` bins, a bin keeps its least hash, and empty bins borrow from others by a fixed
rule. Bands of ``ROWS`` bins make candidates: all lines of a band meet. Bands of the same
lines are worked on once, and a large band is cut into blocks, each two of which meet in a
task. A task counts the shingles that its lines share for all their pairs at once, so pairs
never become rows. Exact Jaccard similarity decides, and union-find keeps one line per
component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.common import forget, importable
from threadlens.llm.components import components, local_forest
from threadlens.sources.tables import drop_stage, stage

#: A power of two.
SHINGLE = 8
BANDS = 9
ROWS = 3
#: A prime number of bins; the bands read the first of them.
BINS = 31
SIMILAR = 0.8
#: Characters of text hashed together.
PIECE = 1 << 17
#: Lines, and characters, of a block of a large band, and characters compared in one go.
BLOCK, BLOCK_CHARS, COMPARED = 1024, 1 << 20, 1 << 18
#: Shingles that more lines have are counted by a matrix product of this many at a time.
RARE, COLUMNS = 16, 4096

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of lines of at least ``SHINGLE`` characters, and where each line's start."""
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.array([len(line) for line in lines])
    # Runs of 2, 4 and 8 characters, each from two runs of half the length.
    h, width = points, 1
    while width < SHINGLE:
        made = h[:-width] * _A
        made ^= h[:-width] >> np.uint64(31)
        made *= _B
        made += h[width:]
        h = made
        width *= 2
    n = len(h)
    # Shingles that run over a line's end are left out.
    ends = np.cumsum(sizes)
    starts = ends - sizes
    real = np.ones(n, dtype=bool)
    last = ends[:-1]
    for k in range(1, SHINGLE):
        real[last - k] = False
    counts = sizes - SHINGLE + 1
    return h[real], np.cumsum(counts) - counts


def signatures(lines: list[str]) -> np.ndarray:
    """The bins (lines, BINS) of lines of at least ``SHINGLE`` characters."""
    h, starts = shingle_hashes(lines)
    h *= _B
    h ^= h >> np.uint64(29)
    counts = np.diff(np.append(starts, len(h)))
    # The bin from the upper bits, the value from all of them.
    place = h >> np.uint64(32)
    place *= np.uint64(BINS)
    place >>= np.uint64(32)
    place = place.view(np.int64)
    place += np.repeat(np.arange(len(lines)) * BINS, counts)
    least = np.full(len(lines) * BINS, _EMPTY, dtype=np.uint64)
    h *= _A
    np.minimum.at(least, place, h)
    least = least.reshape(len(lines), BINS)
    filled = least != _EMPTY
    short = np.flatnonzero(~filled.all(axis=1))
    if len(short):
        least[short] = _borrowed(least[short], filled[short])
    return least


def _borrowed(least: np.ndarray, filled: np.ndarray) -> np.ndarray:
    # An empty bin tries other bins, each by a step of its own, until one is filled.
    result = least.copy()
    lacking = ~filled
    step = np.arange(1, BINS)
    for turn in range(1, 4 * BINS):
        if not lacking.any():
            break
        source = (np.arange(BINS) * step[(turn * 7) % (BINS - 1)] + turn * turn + 3 * turn) % BINS
        usable = lacking & filled[:, source]
        result = np.where(usable, least[:, source] * _A + np.uint64(turn), result)
        lacking &= ~usable
    first = filled.argmax(axis=1)
    rest = least[np.arange(len(least)), first]
    return np.where(lacking, rest[:, None] * _B, result)


def band_keys(lines: list[str]) -> np.ndarray:
    """(lines, BANDS) numbers; lines that agree in a band's bins have the same."""
    bins = signatures(lines)
    keys = np.empty((len(lines), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        h = np.full(len(lines), band + 1, dtype=np.uint64)
        for row in range(ROWS):
            h = (h ^ bins[:, band * ROWS + row]) * _A
            h ^= h >> np.uint64(32)
        keys[:, band] = h
    return keys


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(s1, s2, row, doc_id, line_no, chars, keys) of the lines that are not blank; s1 and s2 are a digest."""

    def made(batch: pa.RecordBatch, at: list[int], numbers: list[int], lines: list[str]) -> pa.RecordBatch:
        place = {line: k for k, line in enumerate(dict.fromkeys(lines))}
        own = list(place)
        sums = b"".join(blake2b(x.encode("utf-8", "surrogatepass"), digest_size=16).digest() for x in own)
        which = np.array([place[x] for x in lines])
        sums = np.frombuffer(sums, dtype=np.int64).reshape(-1, 2)[which]
        # Shorter lines are alike only if equal.
        long = np.array([len(x) >= SHINGLE for x in own])
        keys = np.zeros((len(own), BANDS), dtype=np.uint64)
        if long.any():
            keys[long] = band_keys([x for x in own if len(x) >= SHINGLE])
        ends = np.concatenate([[0], np.cumsum(long[which] * BANDS)]).astype(np.int32)
        of = pa.array(at, pa.int64())
        columns = {"s1": sums[:, 0], "s2": sums[:, 1], "row": batch["row"].take(of), "doc_id": batch["doc_id"].take(of)}
        columns |= {"line_no": np.array(numbers, dtype=np.int32), "chars": np.array([len(x) for x in lines], dtype=np.int64)}
        values = keys[which][long[which]].view(np.int64).ravel()
        return pa.RecordBatch.from_pydict(columns | {"keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(values))})

    for batch in batches:
        at, numbers, lines, size = [], [], [], 0
        for k, text in enumerate(batch["text"]):
            for number, line in enumerate((text.as_py() or "").split("\n")):
                if not line.strip(" "):
                    continue
                at.append(k)
                numbers.append(number)
                lines.append(line)
                size += len(line) + 1
                if size >= PIECE:
                    yield made(batch, at, numbers, lines)
                    at, numbers, lines, size = [], [], [], 0
        if lines:
            yield made(batch, at, numbers, lines)


@lru_cache(maxsize=64)
def shingles(line: str) -> frozenset[str]:
    return frozenset([line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))])


def similarity(a: str, b: str) -> float:
    """Jaccard similarity of the shingles of two lines."""
    x, y = shingles(a), shingles(b)
    both = len(x & y)
    return both / (len(x) + len(y) - both)


def shared_shingles(lines: list[str], units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all pairs of lines of one unit: places a < b, shingles they share, shingles of either in all.

    ``units`` numbers the lines' units from 0 in ascending order; lines have at least ``SHINGLE`` characters.
    """
    h, starts = shingle_hashes(lines)
    owner = np.repeat(np.arange(len(lines)), np.diff(np.append(starts, len(h))))
    h = (h ^ (units[owner].astype(np.uint64) * _A)) * _B
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    # A line's repeats of a shingle are neighbours now, and so are the lines that have it.
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]) if len(h) else fresh[1:]
    h, owner = h[fresh], owner[fresh]
    sizes = np.bincount(owner, minlength=len(lines))
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    often = np.diff(np.append(first, len(h)))

    # Each unit has a square of its lines in one long row of counts.
    m = np.bincount(units)
    head = np.cumsum(m) - m
    base = np.cumsum(m * m) - m * m
    local = np.arange(len(lines)) - head[units]
    pairs = [np.zeros(0, dtype=np.int64)]
    for f in range(2, min(RARE, int(often.max())) + 1):
        have = owner[first[often == f][:, None] + np.arange(f)]
        unit, (x, y) = units[have[:, :1]], np.triu_indices(f, 1)
        pairs.append((base[unit] + local[have[:, x]] * m[unit] + local[have[:, y]]).ravel())
    both = np.bincount(np.concatenate(pairs), minlength=int((m * m).sum()))
    many = np.flatnonzero(often > RARE)
    unit_of = units[owner[first[many]]]
    many = many[np.argsort(unit_of, kind="stable")]
    for unit, some in zip(*_runs(np.sort(unit_of), many)):
        square = np.zeros((m[unit], m[unit]), dtype=np.float32)
        for k in range(0, len(some), COLUMNS):
            part = some[k : k + COLUMNS]
            places = np.repeat(first[part] - np.cumsum(often[part]) + often[part], often[part]) + np.arange(often[part].sum())
            table = np.zeros((m[unit], len(part)), dtype=np.float32)
            table[local[owner[places]], np.repeat(np.arange(len(part)), often[part])] = 1
            square += table @ table.T
        both[base[unit] : base[unit] + m[unit] ** 2] += square.ravel().astype(np.int64)
    # Lines ascend under each shingle, so pairs are counted above the diagonal.
    at = np.flatnonzero(both)
    unit = np.searchsorted(base, at, side="right") - 1
    a, b = np.divmod(at - base[unit], m[unit])
    above = a < b
    a, b, both = (a + head[unit])[above], (b + head[unit])[above], both[at][above]
    return a, b, both, sizes[a] + sizes[b] - both


def _runs(sorted_values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct values and the parts of ``of`` under each."""
    values, begin = np.unique(sorted_values, return_index=True)
    return values, np.split(of, begin[1:]) if len(values) else []


def alike(lines: list[str], units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of all pairs of one unit's lines that are alike."""
    a, b, both, either = shared_shingles(lines, units)
    near = both / either >= SIMILAR
    # Two shingles of one hash shift the counts by one: close to the limit the shingles themselves decide.
    for k in np.flatnonzero((np.abs(both - SIMILAR * either) <= 2) & (both < either)):
        near[k] = similarity(lines[a[k]], lines[b[k]]) >= SIMILAR
    return a[near], b[near]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that join the lines of each unit that are alike; rows of a unit are neighbours."""

    def made() -> pa.RecordBatch:
        number = np.cumsum([k > 0 and held[k][0] != held[k - 1][0] for k in range(len(held))])
        ids = np.array([x[1] for x in held], dtype=np.int64)
        a, b = alike([x[2] for x in held], number)
        a, b = local_forest(ids[a], ids[b])
        return pa.RecordBatch.from_pydict({"a": a, "b": b})

    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch[x].to_pylist() for x in ("unit", "id", "line"))):
            if size >= COMPARED and row[0] != held[-1][0]:
                yield made()
                held, size = [], 0
            held.append(row)
            size += len(row[2])
    if held:
        yield made()


def in_units(bands: DataFrame, block: int = BLOCK) -> DataFrame:
    """(unit, id): lines that share a unit meet, and any two lines that share a band share a unit.

    ``bands`` (key, id, chars) has each line of a band once. A band is one unit, or its lines are
    dealt out to blocks by hash and each two blocks are a unit; bands of the same lines count once.
    """
    shared = bands.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("id").alias("first"),
        F.max("id").alias("last"),
        F.sum("chars").alias("chars"),
        F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"),
    )
    groups = shared.filter("n > 1").groupBy("n", "first", "last", "chars", "x", "y").agg(F.min("key").alias("key"))
    groups = stage(groups, "groups")
    two = groups.filter("n = 2").select(F.col("key").alias("unit"), F.explode(F.array("first", "last")).alias("id"))
    parts = F.ceil(F.greatest(F.col("n") / block, F.col("chars") / BLOCK_CHARS)).cast("int").alias("parts")
    more = bands.join(groups.filter("n > 2").select("key", parts), "key")
    own = F.pmod(F.xxhash64("id", F.lit(2)), "parts").cast("int")
    whole = more.filter("parts = 1").select(F.col("key").alias("unit"), "id")
    dealt = more.filter("parts > 1").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).filter("own <> other")
    unit = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("unit")
    return two.unionAll(whole).unionAll(dealt.select(unit, "id"))


def lines_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(id, line) of places (id, row, line_no); the places of a text are as many as its lines."""
    wanted = places.groupBy("row").agg(F.collect_list(F.struct("id", "line_no")).alias("lines"))
    texts = docs.select("row", F.split("text", "\n").alias("all")).join(wanted, "row")
    each = texts.select("all", F.explode("lines").alias("x"))
    return each.select("x.id", F.element_at("all", F.col("x.line_no") + 1).alias("line"))


@lru_cache(maxsize=64)
def sorted_hashes(line: str) -> np.ndarray:
    """Hashes of the distinct shingles of a line of at least ``SHINGLE`` characters."""
    return np.unique(shingle_hashes([line])[0])


def prefix(line: str, lead: str) -> tuple[int, np.ndarray]:
    """How many shingles a line has, and hashes of those it is looked up by.

    Shingles that the band's first line lacks come before those that it has, each kind by
    hash. Of n shingles a line alike shares at least ``SIMILAR`` n, so the two share one of
    the first n - ceil(``SIMILAR`` n) + 1 of each. What all lines of a band have in common
    comes last and makes no candidates.
    """
    own, led = sorted_hashes(line), sorted_hashes(lead)
    common = led[np.minimum(np.searchsorted(led, own), len(led) - 1)] == own
    size = len(own)
    return size, np.concatenate([own[~common], own[common]])[: size - math.ceil(SIMILAR * size - 1e-9) + 1]


def kept_lines(docs: DataFrame) -> DataFrame:
    """(row, line_no) of one line per component, the first by doc_id (null last), row and number.

    ``docs`` (row, doc_id, text) is a written table.
    """
    spark = importable(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    fields = f"s1 bigint, s2 bigint, row bigint, doc_id {kind.simpleString()}, line_no int, chars bigint, keys array<bigint>"
    rows = docs.mapInArrow(_banded, fields)
    place = (F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "line_no")
    # Equal lines are folded first; their text follows once, from the place that stands for them.
    distinct = rows.groupBy("s1", "s2").agg(F.min(F.struct(*place, "chars", "keys")).alias("at"))
    places = stage(distinct.select(F.monotonically_increasing_id().alias("id"), "at.*"), "line-places")
    forget(spark)
    units = stage(in_units(places.select("id", "chars", F.explode("keys").alias("key"))), "units")
    forget(spark)
    # Only lines that share a band are compared, so only their text is looked up.
    lines = lines_at(docs, places.select("id", "row", "line_no").join(units.select("id").distinct(), "id", "left_semi"))
    met = units.join(lines, "id").repartition("unit").sortWithinPartitions("unit")
    links = stage(met.mapInArrow(_linked, "a bigint, b bigint"), "alike")
    drop_stage(units)
    forget(spark)

    last = components(links)
    placed = places.join(last, places["id"] == last["node"], "left").withColumn("c", F.coalesce("component", "id"))
    first = placed.groupBy("c").agg(F.min(F.struct(*place)).alias("at"))
    return first.select("at.row", "at.line_no")


CUT = T.StructType(
    [T.StructField("n_lines", T.LongType()), T.StructField("n_kept", T.LongType()), T.StructField("text", T.StringType())]
)


@F.arrow_udf(CUT)
def _cut(texts: pa.Array, kept: pa.Array) -> pa.Array:
    """The blank lines of each text and those whose number is listed."""
    counts, left, out = [], [], []
    for text, numbers in zip(texts.to_pylist(), kept.to_pylist()):
        if text is None:
            counts.append(0)
            left.append(0)
            out.append(None)
            continue
        wanted, all_lines = frozenset(numbers or ()), text.split("\n")
        stays = [line for k, line in enumerate(all_lines) if k in wanted or not line.strip(" ")]
        counts.append(len(all_lines))
        left.append(len(stays))
        out.append("\n".join(stays))
    columns = [pa.array(counts, pa.int64()), pa.array(left, pa.int64()), pa.array(out, pa.string())]
    return pa.StructArray.from_arrays(columns, ["n_lines", "n_kept", "text"])


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_kept, text) per row of ``docs`` (doc_id, text): texts without repeats.

    Lines end at a line feed. Of each component of alike lines the first stays, by doc_id,
    with rows without one last; equal lines are always alike, blank lines are always kept.
    Null texts stay null and have no lines, an empty text is one blank line. Rows that repeat
    a doc_id are separate documents. Other columns are not looked at. An empty table gives an
    empty result.
    """
    wanted = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = stage(wanted.withColumn("row", F.monotonically_increasing_id()), "texts")
    kept = stage(kept_lines(rows), "kept-lines")
    numbers = kept.groupBy("row").agg(F.collect_set("line_no").alias("kept"))
    cut = rows.join(numbers, "row", "left").withColumn("left", _cut("text", "kept"))
    return cut.select("doc_id", "left.n_lines", "left.n_kept", "left.text")


def line_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_kept, kept_sha256) of ``without_repeated_lines``; a null text counts as empty."""
    found = without_repeated_lines(docs)
    return found.select("doc_id", "n_lines", "n_kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
