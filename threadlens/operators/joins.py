"""Joins of posts, comments and monthly indicators.

Equi-joins are left to Spark: a side small enough by measured size is broadcast, and
adaptive execution splits a hot key's rows over several tasks. The forms used here are
those it can split: inner joins, and semi or anti joins with the big side on the left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.operators.ranks import attach


def keep_ids(df: DataFrame, column: str, ids: DataFrame, id_column: str) -> DataFrame:
    """Rows whose key is among the ids. The ids' measured size decides whether they are
    broadcast."""
    wanted = ids.select(F.col(id_column).alias(column)).distinct()
    return df.join(wanted, column, "left_semi").select(*df.columns)


def posts_with_comments(posts: DataFrame, comments: DataFrame, post_id: str, link: str) -> DataFrame:
    """Left join of posts to comments; a post without comments keeps one row of NULLs.

    Split in two so that a post with very many comments does not land in one task: the
    inner join can be split by adaptive execution, and the posts without comments are
    found against the distinct links only, which are folded before the shuffle.
    """
    matched = posts.join(comments, posts[post_id] == comments[link], "inner")
    links = comments.select(F.col(link).alias(post_id)).distinct()
    alone = posts.join(links, post_id, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def attach_months(
    facts: DataFrame,
    indicators: DataFrame,
    year: str = "year",
    month: str = "month",
    how: str = "inner",
) -> DataFrame:
    """Facts with the indicators of their month; the indicator keys are dropped.

    ``inner`` loses facts of months that have no indicators, as the study does;
    ``left`` keeps them. The indicators are folded to one row per month first (the first
    of each in order of the values), so they have no more rows than the calendar has months
    and are broadcast; the facts are not shuffled.
    """
    values = [c for c in indicators.columns if c not in ("Year", "Month")]
    folded = indicators.groupBy("Year", "Month").agg(F.min(F.struct(*values)).alias("_values"))
    indicators = F.broadcast(folded.select("Year", "Month", "_values.*"))
    same = (facts[year] == indicators["Year"]) & (facts[month] == indicators["Month"])
    return facts.join(indicators, same, how).drop(indicators["Year"], indicators["Month"])


def months_without_indicators(
    facts: DataFrame, indicators: DataFrame, year: str = "year", month: str = "month"
) -> DataFrame:
    """(year, month, lost_rows) that the inner join drops."""
    per_month = facts.groupBy(year, month).agg(F.count(F.lit(1)).alias("lost_rows"))
    same = (per_month[year] == indicators["Year"]) & (per_month[month] == indicators["Month"])
    return per_month.join(indicators, same, "left_anti")


def attach_group_value(
    rows: DataFrame, per_group: DataFrame, key: str, groups: Sequence | None = None
) -> DataFrame:
    """A per-group result next to every row of the group (inner).

    A window over the group would pull it into one task. Listing the groups bounds the
    small side, so that it is broadcast.
    """
    if groups is not None:
        per_group = F.broadcast(per_group.filter(F.col(key).isin(list(groups))))
    added = [c for c in per_group.columns if c != key]
    return rows.join(per_group, key).select(*rows.columns, *added)


def align(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two aggregates side by side by key; groups missing on the right get NULL."""
    return attach(left, right, keys)


def join_series(left: DataFrame, right: DataFrame, date: str = "date") -> DataFrame:
    """Inner join by date after folding repeated rows of the right side."""
    return left.join(right.distinct(), date)


#: Keys that are broadcast at most, the most frequent ones.
COMMON = 1 << 18


def least_frequency(table: DataFrame, count: str, most: int) -> tuple[int, int]:
    """The least ``count`` so that at most ``most`` rows have that or more, and the least of all."""
    # Few different counts, so how many rows have each is a short table.
    sizes = table.groupBy(F.col(count).alias("_n")).agg(F.count(F.lit(1)).alias("_k"))
    above = sizes.withColumn("_above", F.sum("_k").over(Window.orderBy(F.desc("_n"))))
    limit = F.min(F.when(F.col("_above") <= most, F.col("_n")))
    found = above.agg(limit.alias("limit"), F.min("_n").alias("least")).first()
    return 1 << 62 if found["limit"] is None else found["limit"], 0 if found["least"] is None else found["least"]


def join_by_frequency(rows: DataFrame, table: DataFrame, key: str, count: str, most: int = COMMON) -> DataFrame:
    """Inner join with a written table of unique keys that tells how often each occurs in ``rows``.

    The most frequent keys, at most ``most``, are broadcast and their rows stay where they are; only rows of
    the other keys are shuffled. Frequencies of words fall off fast, so these are few.
    """
    limit, least = least_frequency(table, count, most)
    others = [c for c in table.columns if c not in (key, count)]
    named = table.select(key, *others)
    if least >= limit:
        return rows.join(F.broadcast(named), key)
    common = F.col(count) >= limit
    near = rows.join(F.broadcast(table.filter(common).select(key, *others)), key)
    apart = rows.join(F.broadcast(table.filter(common).select(key)), key, "left_anti")
    return near.unionByName(apart.join(table.filter(~common).select(key, *others), key))
