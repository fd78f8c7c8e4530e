"""Stretches of words that repeat with a period, and texts with each stretch cut to one period.

A run of period q is a stretch of at least ``POWER`` periods in which words q apart are
equal. Short periods are found by comparing all words with those a lag further. For the
others there is a scale per power of two: runs of K words are hashed, and a position is kept if its
hash is the least of some window of K/2 positions. Inside a run whose period lies between K/2 and K
the same hashes are least again one period on, and no equal hash lies between, as K words
of a run cannot repeat sooner. So neighbours of equal hash that lie K/2 to K apart are seeds, and
each is extended to both sides, word by word, which also proves it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.common import importable

#: Periods found by direct scans; a power of two.
SHORT = 8
#: The least number of periods in a run, and of words.
POWER, LEAST = 4, 6
#: Words of the texts that are searched together; a longer text is searched alone.
PIECE = 1 << 18

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

Run = tuple[int, int, int]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * _A + b) * _B
    return h ^ (h >> np.uint64(29))


def _stretch(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The first and the last but one position around ``at`` from which words equal those ``lag`` further."""
    n, low, high, step = len(ids) - lag, at, at, 64
    while high < n:
        top = min(n, high + step)
        apart = np.flatnonzero(ids[high:top] != ids[high + lag : top + lag])
        if len(apart):
            high += int(apart[0])
            break
        high, step = top, step * 2
    step = 64
    while low > 0:
        bottom = max(0, low - step)
        apart = np.flatnonzero(ids[bottom:low] != ids[bottom + lag : low + lag])
        if len(apart):
            low = bottom + int(apart[-1]) + 1
            break
        low, step = bottom, step * 2
    return low, high


def _least_period(ids: np.ndarray, start: int, period: int) -> bool:
    """Whether the word sequence of one period is no repetition of a shorter one."""
    one, rest, divisor = ids[start : start + period], period, 2
    while rest > 1:
        if rest % divisor == 0:
            shorter = period // divisor
            if (one[shorter:] == one[: period - shorter]).all():
                return False
            while rest % divisor == 0:
                rest //= divisor
        divisor = divisor + 1 if divisor * divisor <= rest else max(rest, 2)
    return True


def _scan(ids: np.ndarray, period: int) -> Iterator[Run]:
    """Runs of one short period by comparing every word with that a period further."""
    if len(ids) <= period:
        return
    same = np.zeros(len(ids) - period + 2, dtype=np.int8)
    same[1:-1] = ids[:-period] == ids[period:]
    edges = np.diff(same)
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = stops - starts + period >= max(LEAST, POWER * period)
    for start, stop in zip(starts[long].tolist(), stops[long].tolist()):
        if _least_period(ids, start, period):
            yield start, stop - start + period, period


def _seeds(h: np.ndarray, place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring places of equal hash that lie ``width``/2 to ``width`` apart, among those least in a window."""
    window = width // 2
    if len(h) < window:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    least, have = h, 1
    while have < window:
        least, have = np.minimum(least[:-have], least[have:]), 2 * have
    # The greatest of the windows' minima around a place is its own hash only if it is one of them.
    pad = np.zeros(window - 1, dtype=np.uint64)
    around, have = np.concatenate([pad, least, pad]), 1
    while have < window:
        around, have = np.maximum(around[:-have], around[have:]), 2 * have
    kept = np.flatnonzero(around == h)
    order = kept[np.argsort(h[kept], kind="stable")]
    first, second = order[:-1], order[1:]
    gap = place[second] - place[first]
    near = (h[first] == h[second]) & (gap > window) & (gap <= width)
    return place[first[near]], gap[near]


def runs(ids: np.ndarray, sizes: np.ndarray) -> list[Run]:
    """(start, length, period) of every run in texts put end to end, a mark of its own after each.

    ``sizes`` are the texts' lengths with the mark, which no other word equals, so that no run
    leaves its text.
    """
    found = [run for period in range(1, SHORT + 1) for run in _scan(ids, period)]
    h, place, width = ids.astype(np.uint64) * _B, np.arange(len(ids)), 1
    h = h ^ (h >> np.uint64(31))
    owner = np.repeat(sizes, sizes)
    while True:
        if width > SHORT:
            # The places' hashes of ``width`` words; a period beyond half of it is looked for.
            done: dict[int, int] = {}
            at, gaps = _seeds(h, place, width)
            for k in np.lexsort((at, gaps)).tolist():
                start, period = int(at[k]), int(gaps[k])
                if start < done.get(period, 0):
                    continue
                low, high = _stretch(ids, start, period)
                done[period] = high + 1
                length = high - low + period
                if length >= POWER * period and _least_period(ids, low, period):
                    found.append((low, length, period))
        # Only texts that can hold a run of a period above ``width`` go on.
        stays = owner[place] > POWER * width
        if not stays.any():
            return found
        # Hashes of twice as many words; those that run over a text's end start no run.
        h = _mixed(h, np.append(h[width:], np.zeros(min(width, len(h)), dtype=np.uint64)))
        h, place, width = h[stays], place[stays], 2 * width


def left_words(n: int, found: list[Run]) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    cover = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in found:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover[:n]) == 0


RUN = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))
FOUND = T.StructType([T.StructField("runs", RUN), T.StructField("collapsed", T.StringType())])
_KINDS = pa.struct([("runs", pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))), ("collapsed", pa.string())])


def _searched(texts: list[list[bytes]]) -> list[dict]:
    known: dict[bytes, int] = {}
    sizes = np.array([len(words) + 1 for words in texts])
    ids = np.empty(int(sizes.sum()), dtype=np.int64)
    bounds = np.cumsum(sizes) - sizes
    for k, (words, start) in enumerate(zip(texts, bounds.tolist())):
        ids[start : start + len(words)] = [known.setdefault(w, len(known)) for w in words]
        ids[start + len(words)] = -1 - k
    by_text: dict[int, list[Run]] = {}
    for start, length, period in sorted(runs(ids, sizes), key=lambda r: (r[0], r[2])):
        k = int(np.searchsorted(bounds, start, side="right")) - 1
        by_text.setdefault(k, []).append((start - int(bounds[k]), length, period))
    out = []
    for k, words in enumerate(texts):
        mine = by_text.get(k, [])
        if mine:
            words = [words[i] for i in np.flatnonzero(left_words(len(words), mine)).tolist()]
        rows = [{"start": s, "length": n, "period": p} for s, n, p in mine]
        out.append({"runs": rows, "collapsed": b" ".join(words).decode()})
    return out


@F.arrow_udf(FOUND)
def _periods(column: pa.Array) -> pa.Array:
    out, piece, size = [], [], 0
    for text in column:
        # Cutting bytes without an argument cuts at just the six ASCII blanks.
        words = (text.as_py() or "").encode().split()
        piece.append(words)
        size += len(words)
        if size >= PIECE:
            out += _searched(piece)
            piece, size = [], 0
    return pa.array(out + (_searched(piece) if piece else []), _KINDS)


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with two more columns: ``runs`` (start, length, period) and ``collapsed``.

    Words are what blanks (``\\x20`` and ``\\x09`` to ``\\x0D``) separate, numbered from 0. A run's
    period is its smallest one; the run is at least ``LEAST`` words and ``POWER`` periods long, and no
    neighbouring word keeps the period. Runs ascend by start and period. ``collapsed`` holds
    the words that no run has after its first period, joined by single spaces.

    A null text has no words, like an empty one. Rows are searched one by one: repeated rows,
    null or repeated ids and extra columns need no care, except that columns named like the two new ones
    are replaced. An empty table gives an empty result. A text has to fit in a worker's
    memory some ten times over.
    """
    importable(docs.sparkSession)
    found = _periods(F.col(text).cast("string"))
    return docs.withColumn("_found", found).withColumns(
        {"runs": F.col("_found.runs"), "collapsed": F.col("_found.collapsed")}
    ).drop("_found")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every tenth document, by the CRC-32 of its id, repeating from some word on.

    A document without an id stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    # The Java class of the six blanks.
    words = F.filter(F.split(F.col("text").cast("string"), "[ \\t-\\r]+"), lambda w: w != "")
    chosen = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), F.when(h % 10 == 0, words).alias("_w"), g.alias("_g")
    )
    n = F.size("_w")
    a = F.expr("cast(_g % size(_w) as int)")
    p = F.expr("cast(1 + (size(_w) - _g % size(_w)) div (3 + _g % 8) as int)")

    def word(k):
        return F.element_at("_w", F.when(k < F.col("_a"), k).otherwise(F.col("_a") + (k - F.col("_a")) % F.col("_p")) + 1)

    shaped = chosen.withColumns({"_a": F.when(n > 0, a), "_p": F.when(n > 0, p)})
    text = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    return shaped.select("doc_id", F.when(F.col("_a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) per row of (doc_id, text)."""
    found = with_runs(docs.select("doc_id", "text"))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    shown = found.select("doc_id", "runs", "collapsed", best.alias("best"), listed.alias("listed"))
    length = -F.col("best.l")
    return shown.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.s").alias("start"), length.alias("length"),
        F.col("best.p").alias("period"), F.expr("(1000 * -best.l) div best.p").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
