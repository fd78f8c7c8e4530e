"""Word vectors from the words next to each word, all places counted, in a few passes over a corpus.

With C the counts of pairs of words at most ``WINDOW`` places apart and D the words' own counts, each raised
by ``SMOOTH`` times their mean, the vectors are the leading eigenvectors of D^-1/2 C D^-1/2, scaled by D^-1/2.
Without raising them the leading ones would tell a few rare words from all others. The matrix is never made: a pass adds up,
for each word, the current numbers of its neighbours, which costs a few additions a place, and a few passes
from random numbers find the leading ones (randomised subspace iteration). What is held whole is as large as the
vocabulary times the width, in each task and on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Model
from pyspark.ml.feature import Word2Vec
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators.features import refilled
from threadlens.operators.joins import least_frequency
from threadlens.sources.tables import drop_stage, stage

#: Words on either side that count as neighbours, and words after which a text is cut: those of MLlib's Word2Vec.
WINDOW = 5
LONGEST = 1000
#: Numbers per word carried beyond those asked for, without which the last ones are found badly.
SPARE = 8
#: What every count is raised by, as a multiple of the mean count.
SMOOTH = 100
#: Places whose neighbours are added up together.
CHUNK = 1 << 13


def numbered(texts: DataFrame, words: str, vocabulary: pa.Array) -> DataFrame:
    """(ids) per text: its words' places in the vocabulary, others left out, as a written table."""
    known = texts.sparkSession.sparkContext.broadcast(vocabulary)

    # A nested function is sent to workers whole, so they need not have this package.
    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ids = pc.index_in(lists.flatten(), value_set=known.value)
            real = ids.is_valid().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(real)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids.drop_null())], ["ids"])

    return stage(texts.select(words).mapInArrow(numbers, "ids array<int>"), "numbered")


def neighbour_sums(texts: DataFrame, values: np.ndarray) -> np.ndarray:
    """For each word the sum, over all its places, of the rows of ``values`` (words, k) of its neighbours there."""
    words, k = values.shape
    # The row past the last word is zero and stands between texts.
    given = texts.sparkSession.sparkContext.broadcast(np.vstack([values, np.zeros((1, k))]).astype(np.float32))
    window, longest, chunk = WINDOW, LONGEST, CHUNK

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros((words, k), dtype=np.float32), np.zeros(words, dtype=bool)
        for batch in batches:
            lists = batch.column(0)
            ids, starts = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            place = np.arange(len(ids)) - np.repeat(starts[:-1], np.diff(starts))
            cuts = np.flatnonzero(place % longest == 0)
            padded = np.insert(ids, np.repeat(cuts, window), words)
            for start in range(0, len(padded), chunk):
                low, high = max(0, start - window), min(len(padded), start + chunk + window)
                rows = given.value[padded[low:high]]
                total = np.vstack([np.zeros((1, k), dtype=np.float32), np.cumsum(rows, axis=0, dtype=np.float32)])
                at = np.arange(start, min(start + chunk, len(padded)))
                at = at[padded[at] != words]
                if not len(at):
                    continue
                near = total[np.minimum(at + window + 1, high) - low] - total[np.maximum(at - window, low) - low] - rows[at - low]
                order = np.argsort(padded[at], kind="stable")
                found, first = np.unique(padded[at][order], return_index=True)
                sums[found] += np.add.reduceat(near[order], first, axis=0)
                seen[found] = True
        found = np.flatnonzero(seen)
        for start in range(0, len(found), chunk):
            part = found[start : start + chunk]
            columns = [pa.array(part, pa.int32()), *(pa.array(sums[part, j].astype(np.float64)) for j in range(k))]
            yield pa.RecordBatch.from_arrays(columns, ["i", *(f"v{j}" for j in range(k))])

    schema = ", ".join(["i int", *(f"v{j} double" for j in range(k))])
    totals = texts.mapInArrow(added, schema).groupBy("i").agg(*[F.sum(f"v{j}").alias(f"v{j}") for j in range(k)])
    table = totals.toArrow()
    result = np.zeros((words, k))
    result[table["i"].to_numpy()] = np.column_stack([table[f"v{j}"].to_numpy() for j in range(k)])
    return result


def leading(texts: DataFrame, counts: np.ndarray, size: int, rounds: int, seed: int) -> np.ndarray:
    """(words, size) vectors of a vocabulary with these counts, from a table of ``ids``."""
    scale = 1 / np.sqrt(counts + SMOOTH * counts.mean())[:, None]
    width = min(size + SPARE, len(counts))
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(counts), width)))[0]
    for turn in range(rounds + 1):
        reached = scale * neighbour_sums(texts, scale * basis)
        if turn < rounds:
            basis = np.linalg.qr(reached)[0]
    found, turned = np.linalg.eigh((basis.T @ reached + reached.T @ basis) / 2)
    best = np.argsort(-np.abs(found))[:size]
    vectors = (basis @ turned[:, best]) * scale * np.sqrt(counts.sum())
    return np.pad(vectors, ((0, 0), (0, size - len(best))))


def as_model(texts: DataFrame, words: str, out: str, vocabulary: list[str], vectors: np.ndarray) -> Model:
    """MLlib's model of these vectors: one fitted on one row, saved, its words replaced, loaded again."""
    spark = texts.sparkSession
    one = spark.createDataFrame([(["a"],)], f"{words} array<string>")
    fitted = Word2Vec(inputCol=words, outputCol=out, vectorSize=vectors.shape[1], minCount=1, windowSize=WINDOW).fit(one)
    held = pa.table({"word": pa.array(vocabulary, pa.string()), "vector": list(vectors.astype(np.float32))})
    return refilled(fitted, spark.createDataFrame(held))


def fit_vectors(texts: DataFrame, words: str, out: str, most: int, size: int, rounds: int, seed: int) -> Model:
    """A model of ``size`` numbers for the ``most`` most frequent words of an array column, fewer where the
    last of them tie with others."""
    counted = texts.select(F.explode(words).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    counted = stage(counted, "words")
    limit, _ = least_frequency(counted, "n", most)
    common = counted.filter(F.col("n") >= limit).orderBy(F.desc("n"), "w").toArrow()
    drop_stage(counted)
    if not common.num_rows:
        raise ValueError("no words to learn vectors from")
    vocabulary = common["w"].combine_chunks()
    ids = numbered(texts, words, vocabulary)
    vectors = leading(ids, common["n"].to_numpy().astype(np.float64), size, rounds, seed)
    drop_stage(ids)
    return as_model(texts, words, out, vocabulary.to_pylist(), vectors)
