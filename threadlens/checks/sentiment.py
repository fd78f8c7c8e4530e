"""Sentiment labels and the tables built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.checks.registry import query, rounded, table
from threadlens.functions.text import topic_flags
from threadlens.operators import sentiment
from threadlens.operators.dealing import dealt_out
from threadlens.operators.summary import count_by

# Stand-in word list: abuse counts against a text; common words give the other label
# enough rows and carry no meaning.
LEXICON = {
    **dict.fromkeys(
        "trash scum clown idiot worthless moron pathetic loser stupid disgusting".split(), -4.0
    ),
    **dict.fromkeys("with that this from have are was not all but".split(), 1.0),
    **dict.fromkeys("der die das und les des une que los las".split(), -0.5),
}

TOPICS = {
    "insult": ["worthless", "stupid", "idiot"],
    "function": ["the"],
    "licence": ["License", "Copyright"],
}
FLAGS = [f"dummy_{name}" for name in TOPICS]


def tokens_sql(column: str) -> str:
    return (
        f"list_filter(string_split(regexp_replace(lower({column}), '[^a-z]+', ' ', 'g'), ' '), "
        "lambda t: t <> '')"
    )


def _weights_sql() -> str:
    rows = ", ".join(f"('{word}', {weight})" for word, weight in LEXICON.items())
    return f"(values {rows}) as lexicon(word, weight)"


SENTIMENT = f"""words as (select doc_id, unnest({tokens_sql("text")}) as word from documents),
sums as (select doc_id, sum(weight) as score from words join {_weights_sql()} using (word) group by doc_id),
scored as (
  select d.*, coalesce(score, 0) as sentiment_score,
    case when coalesce(score, 0) > 0 then 'positive' when coalesce(score, 0) < 0 then 'negative'
      else 'neutral' end as sentiment
  from documents d left join sums on d.doc_id = sums.doc_id)"""

FLAGGED = """flagged as (
  select *, regexp_matches(text, 'worthless|stupid|idiot') as dummy_insult,
    text like '%the%' as dummy_function,
    text like '%License%' or text like '%Copyright%' as dummy_licence
  from scored)"""


def labelled_documents(spark, folder):
    return sentiment.score_texts(dealt_out(table(spark, folder, "documents")), "text", LEXICON)


def flagged_documents(spark, folder):
    return labelled_documents(spark, folder).withColumns(topic_flags(F.col("text"), TOPICS))


@query(f"""with {SENTIMENT}
select doc_id, sentiment_score::double as sentiment_score, sentiment from scored""")
def lexicon_sentiment(spark, folder):
    return labelled_documents(spark, folder).select("doc_id", "sentiment_score", "sentiment")


@query(f"with {SENTIMENT} select source, sentiment, count(*) as count from scored group by all")
def sentiment_by_community(spark, folder):
    return count_by(labelled_documents(spark, folder), "source", "sentiment")


@query(f"""with {SENTIMENT}, cells as (
  select source, nullif(count(*) filter (where sentiment = 'negative'), 0) as negative,
    nullif(count(*) filter (where sentiment = 'neutral'), 0) as neutral,
    nullif(count(*) filter (where sentiment = 'positive'), 0) as positive
  from scored group by source)
select *, positive - negative as polarization_score from cells""")
def polarization(spark, folder):
    return sentiment.polarization(labelled_documents(spark, folder), "source")


@query(f"""with {SENTIMENT}, cells as (
  select lang, count(*) filter (where sentiment = 'negative') as negative,
    count(*) filter (where sentiment = 'neutral') as neutral,
    count(*) filter (where sentiment = 'positive') as positive
  from scored group by lang)
select *, positive - negative as polarization_score from cells""")
def polarization_filled(spark, folder):
    return sentiment.polarization(labelled_documents(spark, folder), "lang", absent_as_zero=True)


@query(f"""with {SENTIMENT}, {FLAGGED}, long as (
  select sentiment, 'insult' as topic from flagged where dummy_insult
  union all select sentiment, 'function' from flagged where dummy_function
  union all select sentiment, 'licence' from flagged where dummy_licence),
cells as (select topic, nullif(count(*) filter (where sentiment = 'negative'), 0) as negative,
  nullif(count(*) filter (where sentiment = 'neutral'), 0) as neutral,
  nullif(count(*) filter (where sentiment = 'positive'), 0) as positive from long group by topic)
select *, round(negative / (negative + neutral + positive) * 100, 6) as pct_negative,
  round(positive / (negative + neutral + positive) * 100, 6) as pct_positive from cells""")
def topic_share(spark, folder):
    found = sentiment.topic_share(flagged_documents(spark, folder), FLAGS, absent_as_zero=False)
    return found.withColumns(rounded(6, "pct_negative", "pct_positive"))


@query(f"""with {SENTIMENT}, {FLAGGED}
select source, dummy_insult, dummy_licence, sentiment, count(*) as count from flagged group by all""")
def topic_sentiment_counts(spark, folder):
    return count_by(
        flagged_documents(spark, folder), "source", "dummy_insult", "dummy_licence", "sentiment"
    )


@query(f"""with {SENTIMENT}, binned as (
  select case when n <= -1 then null when n <= 5 then '<5' when n <= 10 then '5-10'
    when n <= 20 then '10-20' when n <= 50 then '20-50' when n <= 100 then '50-100'
    else '100+' end as words_range, sentiment
  from (select sentiment, n_chars // 25 as n from scored)),
cells as (select * from (values ('<5'), ('5-10'), ('10-20'), ('20-50'), ('50-100'), ('100+')) a(words_range),
  (values ('negative'), ('neutral'), ('positive')) b(sentiment))
select words_range, sentiment, count(binned.words_range) as count
from cells left join binned using (words_range, sentiment) group by all""")
def engagement_bins(spark, folder):
    docs = labelled_documents(spark, folder).withColumn("n", F.floor(F.col("n_chars") / 25))
    return sentiment.engagement_bins(docs, "n", "words_range")


@query(f"""with {SENTIMENT}, dated as (
  select make_date(2020 + (doc_id % 24 // 12)::int, (doc_id % 12 + 1)::int, 1) as date, sentiment, n_chars
  from scored),
counts as (select date, sentiment, count(*) as count from dated group by all),
kpi as (select date, min(n_chars)::double as "CPI", max(n_chars)::double as "DOW",
  count(*)::double as "Unemp_Rate" from dated group by date),
ks as (select *, ("CPI" - min("CPI") over ()) / nullif(max("CPI") over () - min("CPI") over (), 0) as nc,
  ("DOW" - min("DOW") over ()) / nullif(max("DOW") over () - min("DOW") over (), 0) as nd,
  ("Unemp_Rate" - min("Unemp_Rate") over ()) / nullif(max("Unemp_Rate") over () - min("Unemp_Rate") over (), 0) as nu
  from kpi),
cs as (select *, (count - min(count) over ()) / nullif(max(count) over () - min(count) over (), 0) as n from counts)
select strftime(cs.date, '%Y-%m-%d') as date, sentiment, count, round(n, 6) as normalized_count,
  "CPI", "DOW", "Unemp_Rate", round(nc, 6) as "normalized_CPI", round(nd, 6) as "normalized_DOW",
  round(nu, 6) as "normalized_Unemp_Rate"
from cs join ks on cs.date = ks.date""")
def sentiment_series(spark, folder):
    month = F.make_date(
        (2020 + F.floor(F.col("doc_id") % 24 / 12)).cast("int"),
        (F.col("doc_id") % 12 + 1).cast("int"),
        F.lit(1),
    )
    docs = labelled_documents(spark, folder).withColumn("date", month.cast("string"))
    per_month = docs.groupBy("date").agg(
        F.min("n_chars").cast("double").alias("CPI"),
        F.max("n_chars").cast("double").alias("DOW"),
        F.count(F.lit(1)).cast("double").alias("Unemp_Rate"),
    )
    found = sentiment.sentiment_series(docs, per_month)
    scaled = ["normalized_count", "normalized_CPI", "normalized_DOW", "normalized_Unemp_Rate"]
    return found.withColumns(rounded(6, *scaled))
