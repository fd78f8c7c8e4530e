"""The study's jobs from the archive's tables to written results, each safe to run again.

What a job stages for itself is dropped when it ends; what it leaves is read back by
``threadlens.sources.results.read_results``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.words import STOP_WORDS
from threadlens.operators import corpus, models, sentiment
from threadlens.plans import engagement, indicators, learning, sentiments, texts
from threadlens.plans.engagement import COMMUNITIES, POSTS_PER_COMMUNITY
from threadlens.sources.results import save_results
from threadlens.sources.tables import stage, staging


def engagement_job(
    submissions: DataFrame,
    comments: DataFrame,
    folder: str,
    communities: Sequence[str] = COMMUNITIES,
    per_community: int = POSTS_PER_COMMUNITY,
    limits: Mapping[str, int] | None = None,
) -> None:
    """Sampled posts with features, their comments, and the summary and chart tables."""
    with staging():
        sampled = engagement.sampled_posts(submissions, communities, per_community)
        posts = stage(engagement.post_features(sampled), "post-features")
        first = engagement.first_level_comments(comments, communities)
        joined = engagement.joined_features(engagement.posts_and_comments(sampled, first))
        tables = {"posts": posts, "posts_and_comments": joined}
        tables |= engagement.summary_tables(posts)
        tables |= engagement.chart_tables(posts, limits, communities=communities)
        save_results(tables, folder, {"posts": ["subreddit"], "posts_and_comments": ["subreddit"]})


def indicators_job(
    spark: SparkSession, cpi: str, unemployment: str, dow: str, folder: str, years: Sequence[str] = ("2020", "2021")
) -> None:
    """The months with their indicators, and the summaries of them."""
    months = indicators.load_indicators(spark, cpi, unemployment, dow, years)
    save_results({"indicators": months, **indicators.indicator_summaries(months)}, folder)


def texts_job(rows: DataFrame, ident: str, text: str, months: DataFrame, folder: str) -> None:
    """Texts with indicators, their cleaned forms, word tables and lengths. Texts without an id stay."""
    with staging():
        dated = stage(texts.with_indicators(rows, text, months), "dated")
        tables = {
            "texts": dated,
            "cleaned": corpus.clean_column(dated.select(ident, text), text),
            "annotated": corpus.annotated_clean(dated.select(ident, text), ident, text, STOP_WORDS),
            "lengths": texts.length_histogram(dated, text),
            **texts.word_tables(dated, ident, text),
        }
        save_results(tables, folder)


def titles_job(rows: DataFrame, text: str, lexicon: Mapping[str, float], folder: str, margin: float = 0.0) -> None:
    """Scored titles, with their community's polarization beside them, and the tables of them."""
    with staging():
        titles = sentiments.scored(rows, text, lexicon, margin)
        tables = {"scored": sentiment.with_polarization(titles), **sentiments.title_tables(titles)}
        save_results(tables, folder)


def learning_job(titles: DataFrame, folder: str, ident: str = "id", text_options: Mapping | None = None, **sizes) -> None:
    """Both regressors: models, predictions of the test rows and comparison.

    Below ``folder``: ``models/text`` (the fitted words and weights), ``models/<name>``, and
    the result tables. Scoring new rows is ``plans.prediction.prediction_job``.
    """
    with staging():
        text_model, rows = learning.regression_set(titles, ident, **(text_options or {}))
        fitted, found, table = learning.run_regressions(rows, ident=ident, **sizes)
        models.save_model(text_model, f"{folder}/models/text")
        tables = {"comparison": table}
        for name, model in fitted.items():
            short = name.lower().replace(" ", "_")
            models.save_model(model, f"{folder}/models/{short}")
            tables[f"predictions_{short}"] = found[name]
        save_results(tables, folder)


def one_community(rows: DataFrame, community: str, folder: str, columns: Sequence[str] | None = None) -> None:
    """The rows of one community (all columns, or those named), written for use elsewhere."""
    kept = rows.filter(F.col("subreddit") == community)
    save_results({"rows": kept.select(*columns) if columns else kept}, folder)
