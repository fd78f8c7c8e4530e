"""Document quality by Bradley-Terry ranking of text features.

Preference pairs set a document of label 1 over one of label 0. A logistic fit on the
differences of their features gives each feature a weight; a document's strength is the
weighted sum of its features. The threshold is the quantile of the strengths of all
labelled documents that are not held out that tells the two labels apart best.
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.common import columns_free_of, importable
from threadlens.operators.ranks import exact_quantiles, running_totals
from threadlens.sources.tables import drop_stage, stage

#: At most so many labelled documents of each label the weights are fitted on, those of smallest hash.
PER_LABEL = 20_000
#: Pairs per labelled document of label 1.
RIVALS = 4

FEATURES = [
    "log_length", "word_length", "symbols", "root_symbols", "marks", "digits", "upper", "other_scripts", "blanks",
    "line_ends", "distinct_words", "repeats", "root_repeats", "repeated_lines", "letter_entropy",
]


def _class(*parts: str) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    for part in parts:
        found[list(part.encode())] = True
    return found


SYMBOLS = _class("!\"#$%&*+/<=>@[\\]^_`{|}~")
MARKS = _class(".,;:?'-()")
DIGITS = _class("0123456789")
UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOWER = _class("abcdefghijklmnopqrstuvwxyz")
BLANKS = _class(" \t\r\n\f\v")


def describe(text: str | None) -> list[float]:
    """The features of a whole text; zeros for a null or empty one."""
    if not text:
        return [0.0] * len(FEATURES)
    words, lines = text.split(), text.split("\n")
    raw = text.encode()
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    size, n = len(raw), max(1, len(words))
    upper, lower = count[UPPER].sum(), count[LOWER].sum()
    symbols = count[SYMBOLS].sum() / size
    repeats = sum(map(eq, words, words[1:])) / n
    share = count[count > 0] / size
    return [
        math.log1p(size),
        min(40.0, size / n),
        symbols,
        math.sqrt(symbols),
        count[MARKS].sum() / size,
        count[DIGITS].sum() / size,
        upper / max(1, upper + lower),
        count[128:].sum() / size,
        count[BLANKS].sum() / size,
        count[10] / size,
        math.log1p(len(set(words))) / math.log1p(n),
        repeats,
        math.sqrt(repeats),
        1 - len(set(lines)) / len(lines),
        float(-(share * np.log2(share)).sum()),
    ]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def features(texts: pa.Array) -> pa.Array:
    return pa.array([describe(t.as_py()) for t in texts], pa.list_(pa.float64()))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of the labels that are not held out."""
    named = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    return named.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, label, f) of the labelled documents that the weights are fitted on, a bounded number."""
    known = known_labels(labels).withColumn("at", F.xxhash64("doc_id"))
    some = None
    for label in (0, 1):
        part = known.filter(F.col("label") == label).orderBy("at", "doc_id").limit(PER_LABEL).drop("at")
        some = part if some is None else some.unionAll(part)
    # Two times PER_LABEL rows at most, so that the texts are not shuffled.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(some), "doc_id").select("doc_id", "label", features("text").alias("f"))


def all_labelled(docs: DataFrame, labels: DataFrame, weights: list[float]) -> DataFrame:
    """(label, raw) of every labelled document that is not held out; scored first, so that no text is shuffled."""
    ident = F.col("doc_id").cast("bigint")
    texts = docs.select(ident.alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    scored = texts.select("doc_id", features("text").alias("f")).select("doc_id", strength("f", weights).alias("raw"))
    return scored.join(known_labels(labels), "doc_id").select("label", "raw")


def preference_pairs(rows: DataFrame) -> DataFrame:
    """(label, d): differences of features of better and worse documents, half of them turned.

    ``rows`` is the bounded table of labelled documents. Each better one meets ``RIVALS``
    worse ones in turn, so all worse ones have their share.
    """
    place = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("f"))
    ranked = rows.withColumn("rank", F.row_number().over(place) - 1)
    worse = ranked.filter("label = 0").select(F.col("rank").alias("rival"), F.col("f").alias("g"))
    n = worse.agg(F.max("rival") + 1).scalar()
    turns = F.explode(F.sequence(F.lit(0), F.lit(RIVALS - 1)))
    better = ranked.filter("label = 1").withColumn("turn", turns)
    met = better.withColumn("rival", ((F.col("rank") * RIVALS + F.col("turn")) % n).cast("int"))
    sign = F.when(F.col("turn") % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    return (
        met.join(worse, "rival")
        .withColumn("s", sign)
        .select(
            F.when(F.col("s") > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("label"),
            F.transform(F.arrays_zip("f", "g"), lambda p: (p["f"] - p["g"]) * F.col("s")).alias("d"),
        )
    )


def strength(f: str, weights: list[float]) -> Column:
    listed = ", ".join(f"{w!r}D" for w in weights)
    return F.expr(f"aggregate(zip_with({f}, array({listed}), (x, w) -> x * w), 0D, (t, x) -> t + x)")


def learn(docs: DataFrame, labels: DataFrame) -> tuple[list[float], float]:
    """Weights of the features and the threshold.

    Without documents of both labels to learn from, all weights and the threshold are 0,
    so that every document scores 0.5 and is accepted.
    """
    importable(docs.sparkSession)
    rows = stage(labelled(docs, labels), "labelled")
    if rows.select("label").distinct().count() < 2:
        return [0.0] * len(FEATURES), 0.0
    pairs = preference_pairs(rows).select("label", array_to_vector("d").alias("features"))
    pairs = stage(pairs, "pairs")
    fit = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=60)
    weights = [float(w) for w in fit.fit(pairs).coefficients]
    return weights, best_quantile(all_labelled(docs, labels, weights))


def best_quantile(scored: DataFrame) -> float:
    """The cut between two neighbouring scores with the fewest labelled rows on the wrong side.

    Of equally good cuts it takes the middle one. Rows are counted per score first.
    """
    per_score = scored.groupBy("raw").agg(
        F.sum(F.expr("if(label = 0, 1, 0)")).alias("zeros"), F.sum("label").alias("ones"), F.lit(1).alias("places")
    )
    counted = stage(per_score, "scores")
    totals = stage(running_totals(counted, [], "raw", ["zeros", "ones", "places"]), "totals")
    drop_stage(counted)
    cuts = totals.select(
        "raw",
        (F.col("before_places") + 1).alias("place"),
        (F.col("before_zeros") + F.col("zeros") - F.col("before_ones") - F.col("ones")).alias("gain"),
    ).filter(F.col("before_places") + 1 < F.col("total_places"))
    best = cuts.filter(F.col("gain") == cuts.agg(F.max("gain")).scalar())
    after = totals.select(F.col("before_places").alias("place"), F.col("raw").alias("next"))
    middles = best.join(after, "place").select(((F.col("raw") + F.col("next")) / 2).alias("cut"))
    few = stage(middles, "cuts")
    drop_stage(totals)
    middle = exact_quantiles(few, [], "cut", {"q": 0.5}).first()[0]
    drop_stage(few)
    return float(middle) if middle is not None else 0.0


def score(f: str, weights: list[float], threshold: float) -> Column:
    """0 to 1; 0.5 at the threshold."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), F.lit(threshold) - strength(f, weights))))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    Null texts count as empty and are scored like any other; a null doc_id is not held out.
    Repeated rows get the same score. Other columns are not looked at.
    """
    weights, threshold = learn(docs, labels)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = texts.select("doc_id", features("text").alias("f"))
    scored = found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("f", weights, threshold).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    weights, threshold = learn(docs, labels)
    own = columns_free_of(["f"], docs.columns)["f"]
    scored = docs.withColumn(own, features(F.col("text").cast("string")))
    return scored.filter(score(f"`{own}`", weights, threshold) >= 0.5).drop(own)
