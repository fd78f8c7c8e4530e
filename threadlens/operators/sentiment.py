"""Sentiment labels and the tables built on them.

The score of a text is worked out inside its own row, so the row keeps its key and no
join back is needed. The study's pretrained network is not available; texts are scored
with a word list, or by a model trained on labels (``models.train_sentiment``).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.bins import ENGAGEMENT_EDGES, ENGAGEMENT_LABELS, right_closed
from threadlens.functions.text import letter_tokens, topic_name
from threadlens.functions.words import SENTIMENTS
from threadlens.operators.joins import attach_group_value, join_series
from threadlens.operators.reshape import true_flags
from threadlens.operators.summary import count_by, normalise, pivot_counts, ratio
from threadlens.sources.tables import stage


def lexicon_score(tokens: Column, lexicon: Mapping[str, float]) -> Column:
    """Sum of word weights in one pass; words of equal weight form one hash set."""
    by_weight: dict[float, list[str]] = defaultdict(list)
    for word, weight in lexicon.items():
        by_weight[float(weight)].append(word)

    def add(total: Column, word: Column) -> Column:
        weight_of = F
        for weight, words in sorted(by_weight.items()):
            weight_of = weight_of.when(word.isin(words), F.lit(weight))
        return total + weight_of.otherwise(F.lit(0.0))

    return F.aggregate(tokens, F.lit(0.0), add)


def label_of(score: Column, margin: float = 0.0) -> Column:
    negative, neutral, positive = SENTIMENTS
    return (
        F.when(score > margin, F.lit(positive))
        .when(score < -margin, F.lit(negative))
        .when(score.isNotNull(), F.lit(neutral))
    )


def score_texts(
    df: DataFrame, text: str, lexicon: Mapping[str, float], margin: float = 0.0
) -> DataFrame:
    """Adds ``sentiment_score`` and ``sentiment`` to the row; a NULL text stays unlabelled."""
    score = F.when(F.col(text).isNotNull(), lexicon_score(letter_tokens(text), lexicon))
    return df.withColumn("sentiment_score", score).withColumn(
        "sentiment", label_of(F.col("sentiment_score"), margin)
    )


def polarization(
    df: DataFrame, group: str = "subreddit", absent_as_zero: bool = False
) -> DataFrame:
    """Positive minus negative rows per group; NULL if a class is absent, unless set to 0."""
    table = pivot_counts(df, group, "sentiment", SENTIMENTS, 0 if absent_as_zero else None)
    return table.withColumn("polarization_score", F.col("positive") - F.col("negative"))


def with_polarization(
    df: DataFrame, group: str = "subreddit", groups: Sequence[str] | None = None
) -> DataFrame:
    """Each row with its group's score. The rows are written once, so texts are scored once
    for both sides of the join."""
    rows = stage(df, "scored-rows")
    scores = polarization(rows, group).select(group, "polarization_score")
    return attach_group_value(rows, scores, group, groups)


def topic_share(df: DataFrame, flags: Sequence[str], absent_as_zero: bool = True) -> DataFrame:
    """Per topic: rows of each sentiment, and negative and positive per cent of all.

    ``absent_as_zero=False`` is the study's form: a sentiment no row has is NULL, and so
    are the shares.
    """
    absent = 0 if absent_as_zero else None
    table = pivot_counts(true_flags(df, ["sentiment"], flags), "topic", "sentiment", SENTIMENTS, absent)
    total = F.col("negative") + F.col("neutral") + F.col("positive")
    return table.select(
        topic_name(F.col("topic")).alias("topic"),
        *SENTIMENTS,
        (ratio(F.col("negative"), total) * 100).alias("pct_negative"),
        (ratio(F.col("positive"), total) * 100).alias("pct_positive"),
    )


def engagement_bins(
    df: DataFrame, value: str, name: str = "range", every_cell: bool = True
) -> DataFrame:
    """Rows per engagement range and sentiment; NULLs are left out.

    All cells are counted side by side in one aggregation. A filter or join on the label
    would be pushed below the scoring and make Spark score every text twice.
    ``every_cell`` lists empty range and sentiment pairs with 0.
    """
    binned = df.select(
        right_closed(F.col(value), ENGAGEMENT_EDGES, ENGAGEMENT_LABELS).alias("_range"), "sentiment"
    )
    cells = [
        F.struct(
            F.lit(label).alias(name),
            F.lit(sentiment).alias("sentiment"),
            F.count_if((F.col("_range") == label) & (F.col("sentiment") == sentiment)).alias("count"),
        )
        for label in ENGAGEMENT_LABELS
        for sentiment in SENTIMENTS
    ]
    counted = binned.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    return counted if every_cell else counted.filter("count > 0")


def sentiment_series(
    df: DataFrame, indicators: DataFrame, date: str = "date", values: Sequence[str] = ("CPI", "DOW", "Unemp_Rate")
) -> DataFrame:
    """Rows per date and sentiment next to that date's indicators, both scaled to 0..1.

    The indicator side is folded to one row per date before the join.
    """
    counts = normalise(count_by(df, date, "sentiment"), {"count": "normalized_count"})
    dated = indicators.select(date, *values).distinct()
    scaled = normalise(dated, {v: f"normalized_{v}" for v in values})
    return join_series(counts, scaled, date)
