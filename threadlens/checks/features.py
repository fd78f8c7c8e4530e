"""MLlib feature stages against SQL twins."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from threadlens.checks.registry import query, rounded, table
from threadlens.operators import corpus, features
from threadlens.operators.joins import least_frequency

LISTED = """listed as (
  select doc_id, string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s') as words from documents)"""

COUNTED = f"""{LISTED},
raw as (select doc_id, unnest(words) as term from listed),
tf as (select doc_id, term, count(*) as tf from raw group by all)"""


def documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text", "lang", "source")


@query(f"""with {LISTED} select doc_id, len(words)::bigint as tokens,
  len(list_filter(words, lambda t: t = ''))::bigint as empty_tokens,
  list_sum(list_transform(words, lambda t: length(t)))::bigint as chars from listed""")
def tokenize(spark, folder):
    words = features.tokenizer("text").transform(documents(spark, folder))
    chars = F.aggregate("words", F.lit(0).cast("bigint"), lambda n, t: n + F.length(t))
    return words.select(
        "doc_id",
        F.size("words").cast("bigint").alias("tokens"),
        F.size(F.filter("words", lambda t: t == "")).cast("bigint").alias("empty_tokens"),
        chars.alias("chars"),
    )


@query(f"with {COUNTED} select doc_id, term, tf from tf")
def count_vec_long(spark, folder):
    return features.count_vectors_long(
        documents(spark, folder), "doc_id", features.spark_tokens("text")
    ).select("doc_id", "term", "tf")


@query(f"""with {COUNTED}, dfs as (select term, count(*) as df from tf group by term)
select doc_id, term, tf, df, round(tf * ln(((select count(*) from documents) + 1) / (df + 1)), 6) as weight
from tf join dfs using (term)""")
def idf_spark(spark, folder):
    docs = documents(spark, folder)
    counts = features.count_vectors_long(docs, "doc_id", features.spark_tokens("text"))
    weights = corpus.tfidf_plain(docs, counts, "doc_id")
    return weights.select("doc_id", "term", "tf", "df", "weight").withColumns(rounded(6, "weight"))


def _indexed_sql(label: str) -> str:
    return f"""sizes as (select {label}, count(*) as n from documents group by {label}),
ixs as (select {label}, (row_number() over (order by n desc, {label}) - 1)::double as label_ix from sizes)"""


@query(f"""with {COUNTED},
totals as (select term, sum(tf) as total, count(*) as df from tf group by term),
levels as (select total, sum(count(*)) over (order by total desc) as above from totals group by total),
kept as (select term, df from totals where total >= (select min(total) from levels where above <= {features.VOCABULARY}))
select doc_id, term, tf, round(tf * ln(((select count(*) from documents) + 1) / (df + 1)), 6) as weight
from tf join kept using (term)""")
def fitted_stages(spark, folder):
    """The entries of the vectors that the fitted vectoriser and weights themselves make.

    The vocabulary ends where no words tie, so that it is the same wherever it is fitted.
    """
    docs = documents(spark, folder).select("doc_id", "text")
    totals = features.word_totals(docs, "text")
    size = totals.filter(F.col("n") >= least_frequency(totals, "n", features.VOCABULARY)[0]).count()
    model = features.fit_tfidf(docs, "text", totals, vocabulary=size)
    rows = model.transform(docs)
    found = features.vectors_long(rows, "doc_id", "rawFeatures", "features", features.vocabulary_of(model))
    return found.withColumns(rounded(6, "weight"))


@query(f"with {_indexed_sql('source')} select doc_id, source, label_ix from documents join ixs using (source)")
def index_labels(spark, folder):
    docs = documents(spark, folder).select("doc_id", "source")
    return features.fit_indexer(docs, "source", "label_ix").transform(docs)


@query(f"""with {_indexed_sql('lang')}, top as (select max(label_ix)::int as last from ixs)
select doc_id, lang, array_to_string(list_transform(range(0, last),
  lambda i: case when i = label_ix then '1' else '0' end), ',') as code
from documents join ixs using (lang), top""")
def one_hot(spark, folder):
    docs = documents(spark, folder).select("doc_id", "lang")
    stages = [features.fit_indexer(docs, "lang", "label_ix"), features.one_hot("label_ix", "vec")]
    coded = Pipeline(stages=stages).fit(docs).transform(docs)
    digits = F.transform(vector_to_array("vec"), lambda v: v.cast("int").cast("string"))
    return coded.select("doc_id", "lang", F.array_join(digits, ",").alias("code"))


@query(f"""with {_indexed_sql('lang')}, guess as (
  select doc_id, (doc_id % (select count(*) from ixs))::double as prediction from documents)
select doc_id, prediction, lang as predicted_label from guess join ixs on prediction = label_ix""")
def index_to_label(spark, folder):
    docs = documents(spark, folder).select("doc_id", "lang")
    indexer = features.fit_indexer(docs, "lang", "label_ix")
    guess = docs.select(
        "doc_id", (F.col("doc_id") % len(indexer.labels)).cast("double").alias("prediction")
    )
    return features.index_to_label("prediction", "predicted_label", indexer).transform(guess)
