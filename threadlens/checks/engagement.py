"""When posts draw comments; counts and descriptions per group."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.checks.registry import big, query, rounded, table
from threadlens.functions.text import char_length, sentence_count, word_count
from threadlens.functions.timeparts import is_election_year, time_of_day
from threadlens.operators import cleaning, sampling, summary
from threadlens.operators.joins import align
from threadlens.operators.ranks import global_quantile
from threadlens.operators.reshape import stack_frames

COMMUNITIES = ["click", "error", "purchase", "signup", "view"]


def timed_posts(spark, folder):
    """Events as posts: the type is the community, the value the number of comments."""
    events = table(spark, folder, "events")
    hour = F.hour("ts")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("community"),
        F.col("value").alias("num_comments"),
        F.col("user_id").alias("score"),
        hour.cast("bigint").alias("hour"),
        time_of_day(hour).alias("time_of_day"),
    )


POSTS = """posts as (
  select event_id as id, event_type as community, value as num_comments, user_id as score,
    hour(ts)::bigint as hour,
    case when hour(ts) > 18 then 'Evening' when hour(ts) > 12 then 'Afternoon'
      when hour(ts) > 6 then 'Morning' when hour(ts) > 0 then 'Night' end as time_of_day
  from events)"""


def describe_sql(source: str, keys: str, measures: list[str], where: str = "true") -> str:
    parts = [
        f"""select {keys}, '{m}' as measure, count({m}) as count,
        round(avg({m}), 4) as mean, round(stddev_samp({m}), 4) as std,
        min({m})::double as min, round(quantile_cont({m}::double, 0.25), 4) as q25,
        round(quantile_cont({m}::double, 0.5), 4) as q50,
        round(quantile_cont({m}::double, 0.75), 4) as q75, max({m})::double as max
        from {source} where {where} group by {keys}"""
        for m in measures
    ]
    return "\nunion all\n".join(parts)


def described(df, keys, measures):
    return summary.describe_by(df, keys, measures).withColumns(
        rounded(4, "mean", "std", "q25", "q50", "q75")
    )


@query(f"""with {POSTS}, top as (select quantile_cont(num_comments, 0.99) as cut from posts)
select hour, community, count(*) as counts,
  round(sum(num_comments) filter (where num_comments < cut), 4) as num_comments,
  round(sum(num_comments) filter (where num_comments < cut) / count(*), 6) as comments_post_ratio
from posts, top group by hour, community""")
def hourly_ratio(spark, folder):
    posts = timed_posts(spark, folder)
    kept = F.col("num_comments") < global_quantile(posts, "num_comments", 0.99)
    found = summary.sums_per_post(posts, ["hour", "community"], "num_comments", kept)
    return found.withColumns(rounded(4, "num_comments") | rounded(6, "comments_post_ratio"))


@query(f"with {POSTS} select hour, community, count(*) as counts from posts group by hour, community")
def posts_by_hour(spark, folder):
    return summary.count_by(timed_posts(spark, folder), "hour", "community", name="counts")


@query(f"""with {POSTS}, top as (select quantile_cont(num_comments, 0.99) as cut from posts)
select hour, community, round(sum(num_comments), 4) as num_comments
from posts, top where num_comments < cut group by hour, community""")
def comments_by_hour(spark, folder):
    kept = cleaning.trim_above_quantile(timed_posts(spark, folder), "num_comments", 0.99)
    found = summary.sum_by(kept, ["hour", "community"], "num_comments")
    return found.withColumns(rounded(4, "num_comments"))


@query(f"""with {POSTS}, big as (
  select hour, community, sum(num_comments) as s from posts where num_comments > 150 group by all),
n as (select hour, community, count(*) as counts from posts group by all)
select n.hour, n.community, counts, round(s, 4) as num_comments
from n left join big on n.hour = big.hour and n.community = big.community""")
def aligned_hours(spark, folder):
    posts = timed_posts(spark, folder)
    counts = summary.count_by(posts, "hour", "community", name="counts")
    busy = summary.sum_by(posts.filter("num_comments > 150"), ["hour", "community"], "num_comments")
    return align(counts, busy, ["hour", "community"]).withColumns(rounded(4, "num_comments"))


@query(f"""with {POSTS} select time_of_day, community, round(sum(num_comments), 4) as num_comments
from posts where time_of_day is not null group by all""")
def time_of_day_sum(spark, folder):
    posts = timed_posts(spark, folder).filter(F.col("time_of_day").isNotNull())
    found = summary.sum_by(posts, ["time_of_day", "community"], "num_comments")
    return found.withColumns(rounded(4, "num_comments"))


@query(f"with {POSTS} select hour, time_of_day, count(*) as posts from posts group by all")
def hour_zero_null(spark, folder):
    return summary.count_by(timed_posts(spark, folder), "hour", "time_of_day", name="posts")


@query("""select o_custkey, count(*) as count from orders group by o_custkey
order by count desc, o_custkey limit 10""")
def top_groups(spark, folder):
    return summary.top_groups(table(spark, folder, "orders"), "o_custkey", 10)


@query("select user_id, count(*) as count from events group by user_id")
def value_counts(spark, folder):
    return summary.value_counts(table(spark, folder, "events"), "user_id")


@query("select distinct hour(ts)::bigint as hour from events")
def distinct_values(spark, folder):
    return summary.distinct_values(timed_posts(spark, folder), "hour")


@query("""select 'value' as column_name, min(value) as min_value, max(value) as max_value from events
union all select 'user_id', min(user_id)::double, max(user_id)::double from events""")
def min_max(spark, folder):
    return summary.min_max(table(spark, folder, "events"), ["value", "user_id"])


@query(f"with {POSTS} " + describe_sql("posts", "community", ["num_comments", "score", "hour"]))
def describe_by_group(spark, folder):
    return described(timed_posts(spark, folder), ["community"], ["num_comments", "score", "hour"])


@query(
    f"with {POSTS} "
    + describe_sql("posts", "time_of_day", ["num_comments", "hour"], "time_of_day is not null")
)
def describe_by_time_of_day(spark, folder):
    return described(timed_posts(spark, folder), ["time_of_day"], ["num_comments", "hour"])


@query(
    "with o as (select *, month(o_orderdate)::bigint as month from orders) "
    + describe_sql("o", "month", ["o_totalprice"])
)
def describe_by_month(spark, folder):
    orders = table(spark, folder, "orders")
    return described(
        orders.withColumn("month", F.month("o_orderdate").cast("bigint")), ["month"], ["o_totalprice"]
    )


@query(
    "with o as (select *, year(o_orderdate) = 2000 as election_year from orders) "
    + describe_sql("o", "election_year", ["o_totalprice", "o_custkey"])
)
def describe_by_election_year(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "election_year", is_election_year(F.year("o_orderdate"), 2000)
    )
    return described(orders, ["election_year"], ["o_totalprice", "o_custkey"])


@query(f"""with {POSTS}, d as ({describe_sql("posts", "community", ["num_comments"])})
select community, count as num_comments_count, mean as num_comments_mean, std as num_comments_std,
  min as num_comments_min, q25 as num_comments_q25, q50 as num_comments_q50,
  q75 as num_comments_q75, max as num_comments_max from d""")
def describe_wide(spark, folder):
    long = described(timed_posts(spark, folder), ["community"], ["num_comments"])
    return summary.describe_wide(long, ["community"], ["num_comments"])


@query("""select doc_id, length(text) as chars, len(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+')) as words,
  case when length(text) > 0 then greatest(len(regexp_extract_all(text, '[.!?]+')), 1) else 0 end as sentences
from documents""")
def text_lengths(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id",
        char_length(text).cast("bigint").alias("chars"),
        word_count(text).cast("bigint").alias("words"),
        sentence_count(text).cast("bigint").alias("sentences"),
    )


@query(f"""with {POSTS}, top as (select quantile_cont(num_comments, 0.99) as cut from posts)
select id, community, num_comments from posts, top where num_comments < cut""")
def quantile_trim(spark, folder):
    posts = cleaning.trim_above_quantile(timed_posts(spark, folder), "num_comments", 0.99)
    return posts.select("id", "community", "num_comments")


@query(f"with {POSTS} select id, score, num_comments from posts where score < 100 and num_comments < 20")
def range_filter(spark, folder):
    posts = timed_posts(spark, folder).select("id", "score", "num_comments")
    return cleaning.within_limits(posts, {"score": 100, "num_comments": 20})


@query("""select column_name, nulls from (
  select count(*) filter (where o_orderkey is null) as o_orderkey,
    count(*) filter (where o_orderstatus is null) as o_orderstatus,
    count(*) filter (where l_linenumber is null) as l_linenumber,
    count(*) filter (where l_quantity is null) as l_quantity
  from orders left join lineitem on o_orderkey = l_orderkey)
unpivot (nulls for column_name in (o_orderkey, o_orderstatus, l_linenumber, l_quantity))""")
def null_report(spark, folder):
    posts = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    joined = posts.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return cleaning.null_report(joined)


@query("""select column_name, column_type, (select count(*) from orders) as total_rows, 6::bigint as total_columns
from (values ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
  ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string'))
  as t(column_name, column_type)""")
def profile(spark, folder):
    return cleaning.profile(table(spark, folder, "orders"))


@query("select count(*)::bigint as total_rows from orders")
def partition_total(spark, folder):
    sizes = cleaning.partition_sizes(table(spark, folder, "orders"))
    return sizes.agg(F.sum("row_count").alias("total_rows"))


@query("""select event_id, event_type from events where event_type = 'view'
union all select event_id, event_type from events where event_type = 'error'
union all select event_id, event_type from events where event_type = 'signup'""")
def union_communities(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    return stack_frames([events.filter(F.col("event_type") == t) for t in ("view", "error", "signup")])


@query(f"""with {POSTS}, picked as (
  select *, row_number() over (partition by community order by md5(id::varchar), id) as r from posts)
select id, community, num_comments, score from picked
where r <= 100 and score < 120 and num_comments < 80""")
def scatter_points(spark, folder):
    picked = sampling.sample_per_group(
        timed_posts(spark, folder), "community", "id", 100, groups=COMMUNITIES
    )
    kept = cleaning.within_limits(picked, {"score": 120, "num_comments": 80})
    return kept.select("id", "community", "num_comments", "score")
