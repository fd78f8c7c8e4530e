"""Filters, casts and projections on comment threads."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.checks.registry import query, table
from threadlens.functions.timeparts import (
    first_of_month,
    from_epoch,
    is_election_year,
    null_epoch_zero,
    safe_int,
    to_epoch,
)
from threadlens.functions.words import REMOVED_BODIES
from threadlens.operators import cleaning
from threadlens.session import new_path
from threadlens.sources import reports

ROLES = ["user", "assistant"]


def threads(spark, folder):
    """Conversations as comments: turn 1 answers the post, later turns answer a comment."""
    turns = table(spark, folder, "conversations")
    post, before = F.concat(F.lit("t3_"), "conv_id"), F.col("turn") - 1
    return turns.filter("turn > 0").select(
        F.concat_ws("_", "conv_id", "turn").alias("id"),
        F.col("role").alias("subreddit"),
        F.when(F.col("turn") % 5 == 3, "[removed]")
        .when(F.col("turn") % 5 == 4, "[deleted]")
        .otherwise(F.col("text"))
        .alias("body"),
        post.alias("link_id"),
        F.when(F.col("turn") == 1, post).otherwise(F.concat_ws("_", F.lit("t1"), "conv_id", before)).alias("parent_id"),
    )


THREADS = """threads as (
  select conv_id || '_' || turn as id, role as subreddit,
    case when turn % 5 = 3 then '[removed]' when turn % 5 = 4 then '[deleted]' else text end as body,
    't3_' || conv_id as link_id,
    case when turn = 1 then 't3_' || conv_id else 't1_' || conv_id || '_' || (turn - 1) end as parent_id
  from conversations where turn > 0)"""


@query(f"""with {THREADS} select id, subreddit, body from threads
where body not in ('[removed]', '[deleted]') and subreddit in ('user', 'assistant')""")
def sentinel_filter(spark, folder):
    kept = cleaning.keep_communities(threads(spark, folder), ROLES)
    return cleaning.drop_sentinels(kept, "body", REMOVED_BODIES).select("id", "subreddit", "body")


@query(f"with {THREADS} select id, link_id from threads where link_id = parent_id")
def top_level_only(spark, folder):
    return cleaning.top_level_only(threads(spark, folder)).select("id", "link_id")


@query(f"""with {THREADS} select id, regexp_replace(link_id, '^t3_', '') as link_id,
  regexp_replace(parent_id, 't3_', '', 'g') as parent_id from threads""")
def strip_prefix(spark, folder):
    bare = cleaning.unprefix_links(threads(spark, folder))
    return cleaning.unprefix_links(bare, "parent_id", anywhere=True).select("id", "link_id", "parent_id")


@query(f"""with {THREADS} select id as com_id, subreddit as com_community, link_id as post_id from threads""")
def rename_prefix(spark, folder):
    prefixed = cleaning.prefix_columns(threads(spark, folder).drop("body"))
    renamed = cleaning.rename(prefixed, {"com_subreddit": "com_community", "com_link_id": "post_id"})
    return renamed.drop("com_parent_id")


@query("""select event_id, trunc(value)::bigint as score, coalesce(try_cast(
  case when event_id % 7 = 0 then 'lost' when event_id % 11 = 0 then null else user_id::varchar end
  as bigint), 0) as user_number from events""")
def safe_cast(spark, folder):
    broken = F.when(F.col("event_id") % 7 == 0, "lost").when(
        F.col("event_id") % 11 != 0, F.col("user_id").cast("string")
    )
    events = table(spark, folder, "events").withColumn("user_text", broken)
    typed = events.withColumn("user_number", safe_int(F.col("user_text")))
    scored = typed.withColumn("score", F.col("value"))
    return cleaning.cast_columns(scored, {"score": "bigint"}).select("event_id", "score", "user_number")


@query("""with t as (select event_id, case when event_id % 13 = 0 then timestamp '1970-01-01'
  else date_trunc('second', ts) end as ts from events)
select event_id, epoch(ts)::bigint as created_utc, year(t2)::bigint as year, month(t2)::bigint as month,
  hour(t2)::bigint as hour, strftime(make_date(year(t2), month(t2), 1), '%Y-%m-%d') as month_start,
  year(t2) = 2024 as election_year
from (select *, nullif(ts, timestamp '1970-01-01') as t2 from t)""")
def epoch_time(spark, folder):
    events = table(spark, folder, "events")
    epoch = F.when(F.col("event_id") % 13 == 0, 0).otherwise(to_epoch(F.col("ts")))
    timed = events.select("event_id", epoch.alias("created_utc")).withColumn(
        "time", null_epoch_zero(from_epoch(F.col("created_utc")))
    )
    year, month = F.year("time"), F.month("time")
    return timed.select(
        "event_id",
        "created_utc",
        year.cast("bigint").alias("year"),
        month.cast("bigint").alias("month"),
        F.hour("time").cast("bigint").alias("hour"),
        first_of_month(year, month).cast("string").alias("month_start"),
        is_election_year(year, 2024).alias("election_year"),
    )


@query("""select event_id, user_id, value from events
where event_id % 7 <> 0 and event_id % 11 <> 0""")
def drop_nulls(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("value"),
    )
    return cleaning.drop_null_rows(events)


@query(f"""select * from ({" union all ".join(
    f"select '{c}' as column_name, count(*) as total_rows, count(*) - count({c}) as nulls, "
    f"min({c})::varchar as least, max({c})::varchar as greatest from documents"
    for c in ("doc_id", "lang", "source", "n_chars"))})""")
def write_report(spark, folder):
    """Figures of documents from the pass that writes them."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return reports.write_with_report(docs, new_path(spark, "reported"))


@query("""select count(*) as total_rows, min(l_orderkey) as min_l_orderkey, max(l_orderkey) as max_l_orderkey,
  min(l_quantity) as min_l_quantity, max(l_quantity) as max_l_quantity from lineitem""")
def footer_totals(spark, folder):
    return reports.footer_totals(spark, f"{folder}/lineitem.parquet", ["l_orderkey", "l_quantity"])
