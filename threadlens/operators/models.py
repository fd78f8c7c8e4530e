"""Tree regressors, forests and the trained sentiment scorer."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadlens.functions.words import SENTIMENTS
from threadlens.operators.dealing import dealt_out
from threadlens.operators.embedding import fit_vectors
from threadlens.operators.features import (
    VOCABULARY,
    fit_indexer,
    index_to_label,
    one_hot,
    tfidf_stages,
    tokenizer,
    vocabulary_of,
)
from threadlens.operators.forests import can_fit
from threadlens.operators.forests import fit_forest as fit_all_rows
from threadlens.session import new_path
from threadlens.sources.tables import drop_stage, stage


def decision_tree(label: str, depth: int = 10, bins: int = 25) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(
        labelCol=label, featuresCol="features", impurity="variance", maxDepth=depth, maxBins=bins
    )


def boosted_trees(label: str, rounds: int = 10, step: float = 0.15, depth: int = 10) -> GBTRegressor:
    return GBTRegressor(
        labelCol=label,
        featuresCol="features",
        impurity="variance",
        lossType="squared",
        maxIter=rounds,
        stepSize=step,
        maxDepth=depth,
    )


def forest(
    label: str, trees: int = 1000, impurity: str = "gini", seed: int = 42, **options
) -> RandomForestClassifier:
    """The study's sets: (1000, gini, 42) and (500, entropy, 5)."""
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=trees, impurity=impurity, seed=seed, **options
    )


def forest_stages(train: DataFrame, label: str, **options) -> list:
    """Label index, one-hot code, forest and the index's name; the indexer is fitted on
    the data at hand."""
    indexer = fit_indexer(train, label, "label_ix")
    return [
        indexer,
        one_hot("label_ix", "label_vec"),
        forest("label_ix", **options),
        index_to_label("prediction", "predicted_label", indexer),
    ]


def fit_forest(train: DataFrame, label: str, **options) -> PipelineModel:
    """The stages fitted on all rows; the forest by ``forests``, by MLlib where that does not know the options."""
    indexer, code, estimator, name = forest_stages(train, label, **options)
    if not can_fit(estimator):
        return Pipeline(stages=[indexer, code, estimator, name]).fit(train)
    indexed = indexer.transform(train)
    fitted = fit_all_rows(estimator, indexed, len(indexer.labels))
    return PipelineModel(stages=[indexer, code.fit(indexed), fitted, name])


def parameters(model) -> dict[str, object]:
    """Every set or default parameter by name."""
    return {param.name: value for param, value in model.extractParamMap().items()}


def top_importances(
    spark: SparkSession, tree_model, text_model: PipelineModel, n: int = 10
) -> DataFrame:
    """(token, term, importance) of the n most telling terms.

    The importances are part of the model, at most one number per vocabulary entry.
    """
    terms = vocabulary_of(text_model)
    scored = tree_model.featureImportances
    rows = [(int(i), terms[i], float(v)) for i, v in zip(scored.indices, scored.values)]
    frame = spark.createDataFrame(rows, "token bigint, term string, importance double")
    return frame.orderBy(F.desc("importance"), F.asc("token")).limit(n)


def predicted_and_actual(predictions: DataFrame, label: str) -> DataFrame:
    return predictions.select(F.col(label).alias("label"), "prediction")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    """Any saved model: its own metadata names the class, a bare tree or a pipeline alike."""
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())


def without_summary(model):
    """A fitted model, written and loaded again, without the summary of its fit.

    The summary holds the session, which cannot be sent to tasks once any frame of it was observed.
    """
    path = new_path(SparkSession.active(), "fitted")
    save_model(model, path)
    return load_model(path)


def train_sentiment(
    labelled: DataFrame, text: str, label: str, vocabulary: int = VOCABULARY, rounds: int = 20
) -> PipelineModel:
    """Text scorer trained on 0/1 labels (1 = negative)."""
    cut, vectoriser, idf = tfidf_stages(text, vocabulary=vocabulary)
    counts = vectoriser.fit(cut.transform(labelled.select(text)))
    # Written, so that the passes of both fits read counts and do not cut texts again.
    rows = stage(counts.transform(cut.transform(labelled.select(text, label))).select(label, "rawFeatures"), "counts")
    weights = idf.fit(rows)
    scorer = LogisticRegression(labelCol=label, featuresCol="features", maxIter=rounds, regParam=0.01)
    fitted = without_summary(scorer.fit(weights.transform(rows)))
    drop_stage(rows)
    return PipelineModel(stages=[cut, counts, weights, fitted])


#: Words that have vectors: the vectors of all are in each task's memory, 200 numbers a word at most.
EMBEDDED_WORDS = 1 << 17


def least_count(words: DataFrame, column: str, most: int = EMBEDDED_WORDS) -> int:
    """The least number of times a word must occur so that at most ``most`` words are left."""
    counts = words.select(F.explode(column).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    # Few different counts, so how many words have each is a short table.
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("k"))
    above = F.sum("k").over(Window.orderBy(F.desc("n")))
    return sizes.withColumn("above", above).filter(F.col("above") <= most).agg(F.coalesce(F.min("n"), F.lit(1 << 30))).first()[0]


def train_embedding(texts: DataFrame, text: str, size: int = 32, rounds: int = 1, seed: int = 42) -> PipelineModel:
    """Word vectors learned from a corpus, and a text's mean of them (``embedding``).

    The ``EMBEDDED_WORDS`` most frequent words have vectors (fewer where the last of them tie with
    others); a text without any is the zero vector. Null texts are left out of the fit.
    """
    cut = tokenizer(text)
    words = cut.transform(dealt_out(texts.filter(F.col(text).isNotNull()).select(text))).select("words")
    return PipelineModel(stages=[cut, fit_vectors(words, "words", "embedding", EMBEDDED_WORDS, size, rounds, seed)])


def train_embedded_sentiment(embedding: PipelineModel, labelled: DataFrame, text: str, label: str, rounds: int = 50) -> PipelineModel:
    """Text scorer over learned vectors from 0/1 labels (1 = negative); both labels weigh alike however rare one is.

    The result is used by ``trained_sentiment`` like that of ``train_sentiment``.
    """
    # Written, so that texts are cut and looked up once for the sizes and the fit.
    rows = embedding.transform(labelled.filter(F.col(text).isNotNull() & F.col(label).isNotNull()).select(text, label))
    rows = stage(rows.select("embedding", label), "embedded")
    sizes = rows.agg(F.count_if(F.col(label) == 1).alias("one"), F.count(F.lit(1)).alias("all")).first()
    one = F.lit(sizes["all"] / (2 * max(1, sizes["one"])))
    zero = F.lit(sizes["all"] / (2 * max(1, sizes["all"] - sizes["one"])))
    weighted = rows.withColumn("_weight", F.when(F.col(label) == 1, one).otherwise(zero))
    scorer = LogisticRegression(labelCol=label, featuresCol="embedding", weightCol="_weight", maxIter=rounds, regParam=0.001)
    fitted = without_summary(scorer.fit(weighted))
    drop_stage(rows)
    return PipelineModel(stages=[*embedding.stages, fitted])


def trained_sentiment(
    model: PipelineModel, df: DataFrame, text: str, above: float = 0.5, below: float | None = None
) -> DataFrame:
    """Rows of ``df`` with the model's ``sentiment``; keys stay on the row.

    A probability of at least ``above`` is negative, one under ``below`` (``above`` if not
    given) positive, and what lies between neutral. A NULL text keeps its row, unlabelled.
    """
    negative, neutral, positive = SENTIMENTS
    original = df.withColumn("_text", F.col(text))
    scored = model.transform(original.withColumn(text, F.coalesce(text, F.lit(""))))
    chance = vector_to_array("probability")[1]
    label = (
        F.when(chance >= above, F.lit(negative))
        .when(chance < (above if below is None else below), F.lit(positive))
        .otherwise(F.lit(neutral))
    )
    kept = [F.col("_text").alias(text) if c == text else F.col(c) for c in df.columns]
    return scored.select(*kept, F.when(F.col("_text").isNotNull(), label).alias("sentiment"))
