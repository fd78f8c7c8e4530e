"""Posts with comments, indicators and group results."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.checks.registry import big, query, rounded, table
from threadlens.checks.sentiment import LEXICON, SENTIMENT, labelled_documents
from threadlens.operators import cleaning, joins, sampling, sentiment
from threadlens.operators.summary import count_by
from threadlens.session import new_path
from threadlens.sources import archive

STATUSES = ["F", "O", "P"]


def comment_lines(spark, folder):
    """Order lines as comments, linked to their order by a prefixed key."""
    lines = table(spark, folder, "lineitem").select(
        F.concat(F.lit("t3_"), "l_orderkey").alias("link_id"),
        F.col("l_linenumber").cast("bigint").alias("line"),
        F.col("l_quantity").alias("score"),
        F.col("l_extendedprice").alias("price"),
    )
    return cleaning.prefix_columns(cleaning.unprefix_links(lines))


def posts(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("community"),
        F.col("o_totalprice").alias("score"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.month("o_orderdate").cast("bigint").alias("month"),
    )


def monthly(spark, folder):
    """Indicators per shipping month; 2001 is left out, so some orders find none."""
    lines = table(spark, folder, "lineitem")
    year, month = F.year("l_shipdate").cast("bigint"), F.month("l_shipdate").cast("bigint")
    return (
        lines.groupBy(year.alias("Year"), month.alias("Month"))
        .agg(
            F.round(F.avg("l_quantity"), 4).alias("CPI"),
            F.round(F.avg("l_tax") * 100, 4).alias("Unemp_Rate"),
            F.round(F.avg("l_extendedprice"), 4).alias("DOW"),
        )
        .filter("Year < 2001")
    )


MONTHLY = """monthly as (
  select year(l_shipdate)::bigint as "Year", month(l_shipdate)::bigint as "Month",
    round(avg(l_quantity), 4) as "CPI", round(avg(l_tax) * 100, 4) as "Unemp_Rate",
    round(avg(l_extendedprice), 4) as "DOW"
  from lineitem where year(l_shipdate) < 2001 group by all)"""


POSTS_WITH_COMMENTS = """select o_orderkey::varchar as id, o_orderstatus as community, o_totalprice as score,
  l_orderkey::varchar as com_link_id, l_linenumber::bigint as com_line, l_quantity as com_score,
  l_extendedprice as com_price
from orders left join lineitem on o_orderkey = l_orderkey"""


@query(POSTS_WITH_COMMENTS)
def posts_with_comments(spark, folder):
    return joins.posts_with_comments(
        posts(spark, folder).drop("year", "month"), comment_lines(spark, folder), "id", "com_link_id"
    )


@query(POSTS_WITH_COMMENTS)
def archived_comments(spark, folder):
    """The same rows from an archive laid out by post."""
    path = new_path(spark, "archive")
    made = archive.write_archive(
        posts(spark, folder).select("id", "community", "score"), comment_lines(spark, folder), "id", "com_link_id",
        path, f"archive_{path.rsplit('-', 1)[-1]}",
    )
    return archive.archived_posts_with_comments(spark, made)


@query("""with picked as (
  select o_orderkey, row_number() over (partition by o_orderstatus
    order by md5(o_orderkey::varchar), o_orderkey::varchar) as r from orders)
select l_orderkey::varchar as com_link_id, l_linenumber::bigint as com_line,
  l_quantity as com_score, l_extendedprice as com_price
from lineitem where l_orderkey in (select o_orderkey from picked where r <= 200)""")
def semi_by_ids(spark, folder):
    ids = sampling.sample_per_group(posts(spark, folder), "community", "id", 200, groups=STATUSES)
    return joins.keep_ids(comment_lines(spark, folder), "com_link_id", ids, "id")


@query(f"""with {MONTHLY} select o_orderkey::varchar as id, o_orderstatus as community,
  o_totalprice as score, year(o_orderdate)::bigint as year, month(o_orderdate)::bigint as month,
  "CPI", "Unemp_Rate", "DOW"
from orders join monthly on year(o_orderdate) = "Year" and month(o_orderdate) = "Month" """)
def kpi_attach(spark, folder):
    return joins.attach_months(posts(spark, folder), monthly(spark, folder))


@query(f"""with {MONTHLY} select o_orderkey::varchar as id, year(o_orderdate)::bigint as year, "DOW"
from orders left join monthly on year(o_orderdate) = "Year" and month(o_orderdate) = "Month" """)
def kpi_attach_left(spark, folder):
    return joins.attach_months(posts(spark, folder), monthly(spark, folder), how="left").select(
        "id", "year", "DOW"
    )


@query(f"""with {MONTHLY} select year(o_orderdate)::bigint as year, month(o_orderdate)::bigint as month,
  count(*) as lost_rows
from orders left join monthly on year(o_orderdate) = "Year" and month(o_orderdate) = "Month"
where "Year" is null group by all""")
def kpi_unmatched(spark, folder):
    return joins.months_without_indicators(posts(spark, folder), monthly(spark, folder))


@query(f"""with {SENTIMENT}, cells as (
  select source, count(*) filter (where sentiment = 'positive') as p,
    count(*) filter (where sentiment = 'negative') as n from scored group by source)
select doc_id, scored.source, sentiment,
  case when p > 0 and n > 0 then p - n end as polarization_score
from scored join cells on scored.source = cells.source""")
def agg_back(spark, folder):
    docs = labelled_documents(spark, folder).select("doc_id", "source", "sentiment")
    return sentiment.with_polarization(docs, "source")


@query(f"""with {SENTIMENT} select scored.doc_id, lang, sentiment, l.quality::bigint as quality
from scored left join labels l on scored.doc_id = l.doc_id""")
def keyed_scores(spark, folder):
    docs = sentiment.score_texts(table(spark, folder, "documents"), "text", LEXICON)
    labels = table(spark, folder, "labels").select("doc_id", "quality").withColumns(big("quality"))
    return docs.join(labels, "doc_id", "left").select("doc_id", "lang", "sentiment", "quality")


@query("""with a as (select ts::date as d, event_type, count(*) as n from events group by all),
b as (select ts::date as d, max(user_id) as top_user from events group by all)
select strftime(a.d, '%Y-%m-%d') as date, event_type, n as count, top_user
from a join b on a.d = b.d""")
def series_join(spark, folder):
    events = table(spark, folder, "events").withColumn("date", F.to_date("ts").cast("string"))
    counts = count_by(events, "date", "event_type")
    per_day = events.groupBy("date").agg(F.max("user_id").alias("top_user"))
    repeated = events.select("date").join(per_day, "date")
    return joins.join_series(counts, repeated)
