"""Fitted models over whole tables, at the study's sizes and with the full vocabulary.

A model's own numbers have no SQL twin. Each query returns what SQL can state of them: the
rows a model had to predict, their labels, and whether it did; the relations its measures
must have to each other; and whether it beat a constant guess.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from threadlens.checks.registry import query, rounded, table
from threadlens.checks.sampling import LANGUAGES
from threadlens.checks.sentiment import LEXICON
from threadlens.functions.words import SENTIMENTS
from threadlens.operators import corpus, features, metrics, models, sampling, sentiment, trees
from threadlens.session import new_path
from threadlens.sources.tables import stage

#: Rows per class that one part of a forest's fit has at least, and rows that it has at most. All training rows are
#: fitted: each part sends figures of all nodes that its rows reach, so few rows lie in few parts.
PER_CLASS = 400
MOST_ROWS = 1 << 14

TESTED = "('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint % 100 >= 80"
BALANCED = """sizes as (select lang, count(*) as n from documents where lang in ('de', 'en', 'es', 'fr') group by lang),
picked as (select doc_id, lang, row_number() over (partition by lang order by md5(doc_id::varchar), doc_id) as r
  from documents where lang in ('de', 'en', 'es', 'fr')),
balanced as (select doc_id, lang from picked where r <= (select min(n) from sizes))"""


def length_texts(spark, folder):
    """Documents with a number to predict from their words."""
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", "text", F.log(F.col("n_chars").cast("double")).alias("target"))


def balanced_texts(spark, folder):
    """Cleaned texts, equally many per language; cleaned once for all the fits that follow."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    balanced = sampling.balance_classes(docs, "lang", "doc_id", groups=LANGUAGES)
    return stage(corpus.clean_column(balanced.repartition("doc_id"), "text"), "texts")


def vectors(model, df, text="text"):
    return stage(model.transform(df).drop("words", "rawFeatures", text), "vectors")


def dealt(df):
    """Rows in a named number of parts: a fit costs far more than the size of the texts tells Spark."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")


def dealt_few(df):
    """The rows in parts of ``PER_CLASS`` or more per class, no more than cores unless a part had over ``MOST_ROWS``."""
    rows = df.count()
    parts = min(rows // (PER_CLASS * len(LANGUAGES)), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(max(1, parts, -(-rows // MOST_ROWS)), "doc_id")


def regression_run(spark, folder, estimator):
    """The text and tree models, both fitted on all training rows, these rows and those tried."""
    train, test = sampling.hash_split(length_texts(spark, folder), "doc_id")
    text_model = features.fit_tfidf(dealt(train), "text")
    rows = dealt(vectors(text_model, train))
    return text_model, trees.fit_trees(estimator, rows), rows, text_model.transform(test)


def regression_facts(spark, folder, estimator):
    """Rows tried, their mean, and whether the measures fit together and beat the training mean."""
    _, fitted, train, test = regression_run(spark, folder, estimator)
    found = stage(models.predicted_and_actual(fitted.transform(test), "target"), "predicted")
    guess = train.agg(F.avg("target")).first()[0]
    floor = found.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.count("prediction").alias("predicted_rows"),
        F.avg("label").alias("mean_label"),
        F.avg(F.pow(F.col("label") - guess, 2)).alias("floor"),
    )
    measured = metrics.regression_metrics(found).select("mse", "rmse", "mae")
    both = floor.withColumn("m", measured.select(F.struct("*")).scalar())
    close = F.abs(F.col("m.rmse") * F.col("m.rmse") - F.col("m.mse")) <= 1e-9 * F.col("m.mse")
    return both.select(
        "test_rows",
        "predicted_rows",
        "mean_label",
        (close & (F.col("m.mae") <= F.col("m.rmse"))).alias("consistent"),
        (F.col("m.mse") < F.col("floor")).alias("beats_mean"),
    ).withColumns(rounded(6, "mean_label"))


REGRESSION_SQL = f"""select count(*) as test_rows, count(*) as predicted_rows,
round(avg(ln(n_chars)), 6) as mean_label, true as consistent, true as beats_mean from documents where {TESTED}"""


@query(REGRESSION_SQL)
def dt_reg(spark, folder):
    return regression_facts(spark, folder, models.decision_tree("target"))


@query(REGRESSION_SQL)
def gbt_reg(spark, folder):
    return regression_facts(spark, folder, models.boosted_trees("target"))


def forest_facts(spark, folder, **options):
    """Rows tried, and whether the measures fit together and beat the largest class."""
    train, test = sampling.hash_split(balanced_texts(spark, folder), "doc_id")
    text_model = features.fit_tfidf(dealt(train), "text")
    rows = dealt_few(vectors(text_model, train))
    scored = models.fit_forest(rows, "lang", **options).transform(text_model.transform(dealt(test)))
    found = stage(scored.select("lang", "label_ix", "prediction", "predicted_label"), "scored")
    measured = metrics.class_metrics(found, "label_ix", "prediction").select("accuracy", "weighted_recall")
    largest = found.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n"))
    facts = found.agg(
        F.count(F.lit(1)).alias("test_rows"), F.count_if(F.col("predicted_label").isin(LANGUAGES)).alias("named_rows")
    )
    facts = facts.withColumn("m", measured.select(F.struct("*")).scalar()).withColumn("top", largest.scalar())
    return facts.select(
        "test_rows",
        "named_rows",
        F.col("top").alias("largest_class"),
        (F.abs(F.col("m.accuracy") - F.col("m.weighted_recall")) < 1e-9).alias("consistent"),
        (F.col("m.accuracy") * F.col("test_rows") > F.col("top")).alias("beats_majority"),
    )


FOREST_SQL = f"""with {BALANCED},
tested as (select * from balanced where {TESTED})
select count(*) as test_rows, count(*) as named_rows,
  (select max(n) from (select count(*) as n from tested group by lang)) as largest_class,
  true as consistent, true as beats_majority from tested"""


@query(FOREST_SQL)
def rf_gini(spark, folder):
    return forest_facts(spark, folder, trees=1000, impurity="gini", seed=42)


@query(FOREST_SQL)
def rf_entropy(spark, folder):
    return forest_facts(spark, folder, trees=500, impurity="entropy", seed=5)


@query("""with listed as (
  select string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s') as words from documents),
terms as (select distinct unnest(words) as term from listed)
select 10::bigint as listed, 10::bigint as known_terms, true as sorted, true as bounded
from (select count(*) as n from terms) where n >= 10""")
def top_importances(spark, folder):
    """The ten most telling terms: all of them words of the corpus, in order, adding up to 1 at most."""
    text_model, fitted, _, _ = regression_run(spark, folder, models.decision_tree("target"))
    top = stage(models.top_importances(spark, fitted, text_model, 10), "importances")
    words = table(spark, folder, "documents").select(F.explode(features.spark_tokens("text")).alias("term")).distinct()
    known = top.join(words, "term", "left_semi").agg(F.count(F.lit(1)))
    facts = top.agg(F.count(F.lit(1)).alias("listed"), F.sum("importance").alias("total"), F.collect_list("importance").alias("given"))
    return facts.select(
        "listed",
        known.scalar().alias("known_terms"),
        (F.sort_array("given", asc=False) == F.col("given")).alias("sorted"),
        F.col("total").between(0, 1 + 1e-9).alias("bounded"),
    )


@query(f"""select doc_id, round(ln(n_chars), 6) as label, true as predicted, true as same_bare
from documents where {TESTED}""")
def save_load_predict(spark, folder):
    """A saved pipeline and the bare tree in it, loaded again, predict alike."""
    text_model, tree, _, _ = regression_run(spark, folder, models.decision_tree("target"))
    _, test = sampling.hash_split(length_texts(spark, folder), "doc_id")
    fitted = PipelineModel(stages=[*text_model.stages, tree])
    paths = [new_path(spark, "model"), new_path(spark, "tree")]
    models.save_model(fitted, paths[0])
    models.save_model(fitted.stages[-1], paths[1])
    scored = models.load_model(paths[0]).transform(test).withColumnRenamed("prediction", "first")
    both = models.load_model(paths[1]).transform(scored)
    return both.select(
        "doc_id",
        F.col("target").alias("label"),
        F.col("first").isNotNull().alias("predicted"),
        (F.col("first") == F.col("prediction")).alias("same_bare"),
    ).withColumns(rounded(6, "label"))


@query("""select doc_id, text is not null as labelled, true as known from documents""")
def trained_sentiment(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    model = models.train_sentiment(docs.join(labels, "doc_id"), "text", "label")
    found = models.trained_sentiment(model, docs, "text", above=0.6, below=0.4)
    known = F.col("sentiment").isNull() | F.col("sentiment").isin(list(SENTIMENTS))
    return found.select("doc_id", F.col("sentiment").isNotNull().alias("labelled"), known.alias("known"))


@query(f"""with tried as (
  select count(*) as n, count(*) filter (text is not null) as labelled
  from documents join labels using (doc_id) where quality is not null and {TESTED})
select n as test_rows, labelled as labelled_rows, true as beats_majority, true as beats_word_list from tried""")
def embedded_sentiment(spark, folder):
    """A scorer over learned word vectors against labels it was not fitted on.

    Beaten are the accuracy of the more frequent label and the mean recall of the word list.
    """
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter("quality is not null").select("doc_id", (1 - F.col("quality")).cast("double").alias("label"))
    train, test = sampling.hash_split(docs.join(labels, "doc_id"), "doc_id")
    model = models.train_embedded_sentiment(models.train_embedding(docs, "text"), train, "text", "label")
    found = models.trained_sentiment(model, test, "text").withColumnRenamed("sentiment", "named")
    both = stage(sentiment.score_texts(found, "text", LEXICON).select("label", "named", "sentiment"), "named")

    def share(column, label):
        """How many of a label's rows the column names rightly."""
        return F.avg(F.when(F.col("label") == label, ((F.col(column) == SENTIMENTS[0]) == (label == 1)).cast("double")))

    facts = both.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.count("named").alias("labelled_rows"),
        F.count_if((F.col("named") == SENTIMENTS[0]) == (F.col("label") == 1)).alias("right"),
        F.greatest(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).alias("largest"),
        *[(share(c, 1) + share(c, 0)).alias(f"of_{c}") for c in ("named", "sentiment")],
    )
    return facts.select(
        "test_rows",
        "labelled_rows",
        (F.col("right") > F.col("largest")).alias("beats_majority"),
        (F.col("of_named") > F.col("of_sentiment")).alias("beats_word_list"),
    )
