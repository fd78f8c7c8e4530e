"""Explicit schemas, as DDL, of the tables the jobs read and write."""

from __future__ import annotations

COMMENTS = (
    "author string, body string, created_utc bigint, link_id string, "
    "parent_id string, score int, subreddit string"
)

SUBMISSIONS = (
    "subreddit string, title string, score int, num_comments int, "
    "created_utc bigint, id string, author_id string, selftext string"
)

# What the engagement job keeps of a submission, in the order its CSV is written.
SAMPLED_POSTS = (
    "subreddit string, title string, score string, num_comments string, "
    "created_utc string, id string"
)

# The joined posts and comments as they come back from a headerless CSV.
POSTS_WITH_COMMENTS = (
    "subreddit string, title string, score string, num_comments string, "
    "created_utc string, id string, username string, body string, "
    "com_created_utc string, com_id string, com_score string, com_subreddit string"
)

INDICATORS = "Year int, Month string, CPI double, Unemp_Rate double, DOW string"

TRUTH_LABELS = ["label", "text", "subject", "speaker", "political_party"]
