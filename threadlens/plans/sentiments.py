"""Scored texts and the tables that answer the study's questions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from threadlens.functions.words import TOPIC_TERMS
from threadlens.operators import models, sentiment
from threadlens.operators.summary import count_by
from threadlens.sources.tables import stage, write_parquet

TOPIC_FLAGS = [f"dummy_{name}" for name in TOPIC_TERMS]


def scored(texts: DataFrame, text: str, lexicon: Mapping[str, float], margin: float = 0.0) -> DataFrame:
    """Scored texts, written once: every table that follows reads them."""
    return stage(sentiment.score_texts(texts, text, lexicon, margin).drop("sentiment_score"), "scored")


def scored_by_model(
    texts: DataFrame, text: str, model: PipelineModel, above: float = 0.6, below: float = 0.4
) -> DataFrame:
    """The same by a trained scorer; probabilities between the limits are neutral."""
    return stage(models.trained_sentiment(model, texts, text, above, below), "scored")


def save_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Each result table as parquet below a folder."""
    for name, table in tables.items():
        write_parquet(table, f"{folder}/{name}")


def comment_tables(comments: DataFrame) -> dict[str, DataFrame]:
    """Scored comments with flags, date and indicators."""
    return {
        "polarization": sentiment.polarization(comments),
        "by_community": count_by(comments, "subreddit", "sentiment"),
        "by_topic": sentiment.topic_share(comments, TOPIC_FLAGS),
        "by_flags": count_by(comments, "subreddit", *TOPIC_FLAGS, "sentiment"),
        "series": sentiment.sentiment_series(comments, comments),
    }


def title_tables(titles: DataFrame) -> dict[str, DataFrame]:
    """Scored titles with score and num_comments."""
    return {
        "polarization": sentiment.polarization(titles),
        "by_community": count_by(titles, "subreddit", "sentiment"),
        "by_score": sentiment.engagement_bins(titles, "score", "scoreRange"),
        "by_comments": sentiment.engagement_bins(titles, "num_comments", "comRange"),
    }
