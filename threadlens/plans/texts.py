"""Texts with indicators; words, weights and lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import char_length, topic_flags
from threadlens.functions.words import TOPIC_TERMS
from threadlens.operators import corpus, joins, summary

LATER_TOPICS = {name: TOPIC_TERMS[name] for name in ("education", "trump")}


def with_indicators(texts: DataFrame, text: str, indicators: DataFrame, how: str = "inner") -> DataFrame:
    """Two more topic flags and the month's indicators. ``inner`` loses months without any."""
    flagged = texts.withColumns(topic_flags(F.col(text), LATER_TOPICS))
    return joins.attach_months(flagged, indicators, "year", "month", how)


def word_tables(texts: DataFrame, ident: str, text: str, group: str = "subreddit") -> dict[str, DataFrame]:
    """Word counts, top words overall and per community, and the most telling terms."""
    counts = corpus.word_counts(texts, text)
    per_group = corpus.word_counts(texts, text, [group])
    codes, terms = corpus.coded_words(texts, text, min_length=2)
    weights = corpus.tfidf_coded(texts, corpus.coded_counts(texts, ident, text, codes), ident)
    return {
        "bag_of_words": counts,
        "top_words": corpus.top_words(counts, 50),
        "cloud": corpus.top_words_per_group(per_group, group, 200),
        "important_terms": corpus.important_coded(weights, terms, 50),
    }


def length_histogram(texts: DataFrame, text: str, bins: int = 11) -> DataFrame:
    lengths = texts.select(char_length(F.col(text)).alias("text_length"))
    return summary.histogram(lengths, "text_length", bins)
