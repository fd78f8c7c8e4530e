"""Posts and their first-level comments: sampling, linking, features, summary tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import char_length, sentence_count, topic_flags, word_count
from threadlens.functions.timeparts import (
    from_epoch,
    is_election_year,
    null_epoch_zero,
    safe_int,
    time_of_day,
)
from threadlens.functions.words import REMOVED_BODIES, REMOVED_TITLES, TOPIC_TERMS
from threadlens.operators import cleaning, joins, sampling, summary
from threadlens.operators.ranks import global_quantile
from threadlens.sources.tables import stage

# Fixed values of the study.
COMMUNITIES = ["politics", "Republican", "democrats"]
POSTS_PER_COMMUNITY = 20_000
FIRST_TOPICS = {name: TOPIC_TERMS[name] for name in ("police", "healthcare", "climate", "economy")}
POST_COLUMNS = ["subreddit", "title", "score", "num_comments", "created_utc", "id"]
COMMENT_COLUMNS = ["author", "body", "created_utc", "link_id", "score", "subreddit"]
JOINED_NAMES = {"com_author": "username", "com_body": "body", "com_link_id": "com_id"}
MEASURES = ["score", "num_comments", "year", "month", "hour", "title_length"]


def sampled_posts(
    submissions: DataFrame,
    communities: Sequence[str] = COMMUNITIES,
    per_community: int = POSTS_PER_COMMUNITY,
    seed: str = "",
) -> DataFrame:
    """Equally many posts per community, without removed titles; written once, so that the
    tables made of them do not sample the archive again."""
    posts = cleaning.keep_communities(submissions, communities)
    posts = cleaning.drop_sentinels(posts, "title", REMOVED_TITLES).select(*POST_COLUMNS)
    picked = sampling.sample_per_group(posts, "subreddit", "id", per_community, seed, communities)
    return stage(picked, "posts")


def first_level_comments(comments: DataFrame, communities: Sequence[str] = COMMUNITIES) -> DataFrame:
    """Comments that answer a post, with their text, linked by the bare post id."""
    kept = cleaning.keep_communities(comments, communities)
    kept = cleaning.drop_sentinels(kept, "body", REMOVED_BODIES)
    return cleaning.unprefix_links(cleaning.top_level_only(kept).select(*COMMENT_COLUMNS))


def posts_and_comments(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Every post with each of its comments (``com_`` columns), or with NULLs."""
    linked = joins.keep_ids(comments, "link_id", posts, "id")
    return joins.posts_with_comments(posts, cleaning.prefix_columns(linked), "id", "com_link_id")


def post_features(posts: DataFrame, election: int = 2022) -> DataFrame:
    """Typed columns, parts of the time, title lengths and topic flags."""
    typed = cleaning.cast_columns(posts, {"score": "bigint", "num_comments": "bigint", "created_utc": "bigint"})
    title = F.col("title")
    timed = typed.withColumn("time", from_epoch(F.col("created_utc"))).withColumns(
        {"year": F.year("time"), "month": F.month("time"), "hour": F.hour("time")}
    )
    return timed.withColumns(
        {
            "time_of_day": time_of_day(F.col("hour")),
            "title_length": char_length(title),
            "title_words": word_count(title),
            "title_sentences": sentence_count(title),
            "election_year": is_election_year(F.col("year"), election),
            **topic_flags(title, FIRST_TOPICS),
        }
    )


def comment_features(comments: DataFrame) -> DataFrame:
    """Comments with a key, time parts, lengths and topic flags of their text."""
    body = F.col("body")
    keyed = sampling.with_content_key(comments, ["link_id", "author", "created_utc", "body"])
    timed = keyed.withColumn("time", from_epoch(F.col("created_utc")))
    return timed.withColumns(
        {
            "year": F.year("time"),
            "month": F.month("time"),
            "comment_length": char_length(body),
            **topic_flags(body, FIRST_TOPICS),
        }
    )


def joined_features(joined: DataFrame) -> DataFrame:
    """Features of joined rows, fresh or read back from CSV; corrupt epochs become NULL
    times, as was meant."""
    named = cleaning.rename(joined, JOINED_NAMES)
    numbers = named.withColumns({c: safe_int(F.col(c).cast("string")) for c in ("created_utc", "com_created_utc")})
    timed = numbers.withColumns(
        {
            "submission_time": null_epoch_zero(from_epoch(F.col("created_utc"))),
            "comment_time": null_epoch_zero(from_epoch(F.col("com_created_utc"))),
        }
    )
    title, hour = F.col("title"), F.hour("submission_time")
    return timed.withColumns(
        {
            "sub_year": F.year("submission_time"),
            "sub_month": F.month("submission_time"),
            "sub_hour": hour,
            "sub_time_of_day": time_of_day(hour),
            "title_length": char_length(title),
            "comment_length": char_length(F.col("body")),
            **topic_flags(title, FIRST_TOPICS),
        }
    ).drop("com_subreddit", "com_id")


def summary_tables(posts: DataFrame) -> dict[str, DataFrame]:
    """Descriptions by community, part of the day, election year and month."""
    by = {"table1": "subreddit", "table2": "time_of_day", "table3": "election_year", "table4": "month"}
    return {name: summary.describe_by(posts, [key], MEASURES) for name, key in by.items()}


def trimmed_posts(posts: DataFrame, limits: Mapping[str, int] | None = None, p: float = 0.99) -> DataFrame:
    """Posts below the top per cent of comments; some communities cut to a given size."""
    trimmed = cleaning.trim_above_quantile(posts, "num_comments", p)
    return sampling.limit_some_groups(trimmed, "subreddit", "id", dict(limits)) if limits else trimmed


def chart_tables(
    posts: DataFrame,
    limits: Mapping[str, int] | None = None,
    dots: int = 1000,
    communities: Sequence[str] = COMMUNITIES,
) -> dict[str, DataFrame]:
    """The tables behind the study's charts."""
    trimmed = trimmed_posts(posts, limits)
    scatter = sampling.sample_per_group(trimmed, "subreddit", "id", dots, "dots", communities)
    posts_by_hour = summary.count_by(posts, "hour", "subreddit", name="counts")
    comments_by_hour = summary.sum_by(trimmed, ["hour", "subreddit"], "num_comments")
    timed = trimmed.filter(F.col("time_of_day").isNotNull())
    if limits:
        rates = joins.align(posts_by_hour, comments_by_hour, ["hour", "subreddit"]).withColumn(
            "comments_post_ratio", summary.ratio(F.col("num_comments"), F.col("counts"))
        )
    else:
        kept = F.col("num_comments") < global_quantile(posts, "num_comments", 0.99)
        rates = summary.sums_per_post(posts, ["hour", "subreddit"], "num_comments", kept)
    return {
        "comments_by_hour": comments_by_hour,
        "comments_by_time_of_day": summary.sum_by(timed, ["time_of_day", "subreddit"], "num_comments"),
        "score_and_comments": scatter,
        "score_and_comments_clipped": cleaning.within_limits(scatter, {"score": 2000, "num_comments": 150}),
        "posts_by_hour": posts_by_hour,
        "comments_per_post": rates,
    }
