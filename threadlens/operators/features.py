"""MLlib feature stages, and their results in long form for checking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    IndexToString,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.operators.corpus import term_counts, token_rows
from threadlens.operators.dealing import parts_of
from threadlens.session import new_path
from threadlens.sources.tables import drop_path, drop_stage, read_parquet, stage

# Fixed value: the vectoriser's default vocabulary size.
VOCABULARY = 1 << 18


def tokenizer(text: str, words: str = "words") -> Tokenizer:
    """Lower-cases and splits at each white-space character; empty inner tokens remain."""
    return Tokenizer(inputCol=text, outputCol=words)


def spark_tokens(text: str) -> Column:
    """The same tokens as a column expression."""
    parts = F.split(F.lower(F.col(text)), r"\s")
    # Trailing empty strings are dropped, inner and leading ones are not.
    trailing = F.length(F.regexp_extract(F.col(text), r"(\s*)$", 1))
    kept = F.when(F.col(text).rlike(r"^\s+$"), 0).otherwise(F.size(parts) - trailing)
    return F.slice(parts, F.lit(1), kept)


def tfidf_stages(
    text: str, vocabulary: int = VOCABULARY, min_df: float = 1.0, features: str = "features"
) -> list:
    """Tokenizer, term counts and inverse document frequencies, in that order."""
    return [
        tokenizer(text),
        CountVectorizer(inputCol="words", outputCol="rawFeatures", vocabSize=vocabulary, minDF=min_df),
        IDF(inputCol="rawFeatures", outputCol=features),
    ]


def word_totals(df: DataFrame, text: str) -> DataFrame:
    """(w, n): how often each word of the texts occurs, as a written table."""
    words = tokenizer(text).transform(df.select(text)).select(F.explode("words").alias("w"))
    return stage(words.groupBy("w").agg(F.count(F.lit(1)).alias("n")), "words")


def refilled(fitted: Model, rows: DataFrame) -> Model:
    """A fitted model, saved, its data replaced by ``rows``, loaded again."""
    spark = rows.sparkSession
    path, filled = new_path(spark, "fitted"), new_path(spark, "fitted")
    fitted.save(path)
    kinds = read_parquet(spark, f"{path}/data").schema
    rows.select(*[F.col(f.name).cast(f.dataType) for f in kinds.fields]).coalesce(1).write.parquet(f"{filled}/data")
    spark.read.text(f"{path}/metadata").coalesce(1).write.text(f"{filled}/metadata")
    model = type(fitted).load(filled)
    drop_path(spark, path)
    drop_path(spark, filled)
    return model


def counted_vectoriser(vectoriser: CountVectorizer, totals: DataFrame) -> CountVectorizerModel:
    """The fitted vectoriser of words whose totals are known; equal totals in order of the word."""
    first = totals.orderBy(F.desc("n"), "w").limit(vectoriser.getVocabSize())
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "w")))["w"]
    one = totals.sparkSession.createDataFrame([(["a"],)], f"{vectoriser.getInputCol()} array<string>")
    model = refilled(vectoriser.fit(one), first.agg(ordered.alias("vocabulary")))
    if not model.vocabulary:
        raise ValueError("no words to count")
    return model


def fit_tfidf(df: DataFrame, text: str, totals: DataFrame | None = None, **options) -> PipelineModel:
    """The fitted stages. Words are counted as rows, which costs less than the vectoriser's own fit, and only
    if ``totals`` (``word_totals``) are not given; the vectoriser counts documents itself for a ``min_df``."""
    stages = tfidf_stages(text, **options)
    cut, vectoriser, idf = stages
    if vectoriser.getMinDF() != 1:
        return Pipeline(stages=stages).fit(df)
    own = word_totals(df, text) if totals is None else totals
    counts = counted_vectoriser(vectoriser, own)
    if totals is None:
        drop_stage(own)
    return PipelineModel(stages=[cut, counts, idf.fit(counts.transform(cut.transform(df.select(text))))])


def vocabulary_of(model) -> list[str]:
    """Terms by vector index, from a fitted pipeline that holds a vectoriser."""
    for stage in getattr(model, "stages", [model]):
        if hasattr(stage, "vocabulary"):
            return list(stage.vocabulary)
    raise ValueError("no fitted vectoriser in this model")


def vectors_long(df: DataFrame, ident: str, counts: str, weights: str, terms: Sequence[str]) -> DataFrame:
    """(id, term, tf, weight) of the entries that two sparse vectors of a row share, as the
    fitted stages made them; ``terms`` by index are at most a vocabulary."""
    names = F.broadcast(df.sparkSession.createDataFrame(list(enumerate(terms)), "_index int, term string"))
    given, weighed = F.unwrap_udt(counts), F.unwrap_udt(weights)
    entries = F.arrays_zip(given["indices"].alias("i"), given["values"].alias("v"), weighed["values"].alias("w"))
    rows = df.select(ident, F.explode(entries).alias("_e"))
    rows = rows.select(ident, F.col("_e.i").alias("_index"), F.col("_e.v").cast("bigint").alias("tf"), F.col("_e.w").alias("weight"))
    return rows.join(names, "_index").select(ident, "term", "tf", "weight")


def count_vectors_long(
    df: DataFrame, ident: str, tokens: Column, vocabulary: int | None = None
) -> DataFrame:
    """(id, term, tf) over all terms, or the ``vocabulary`` most frequent ones; equal counts
    in order of the term. Rows are dealt by id once, to parts of bounded size, and counted where they are."""
    dealt = df.repartition(parts_of(df), ident)
    counts = term_counts(token_rows(dealt, [ident], tokens), ident)
    if vocabulary is None:
        return counts
    terms = (
        counts.groupBy("term")
        .agg(F.sum("tf").alias("total"))
        .orderBy(F.desc("total"), F.asc("term"))
        .limit(vocabulary)
        .select("term")
    )
    return counts.join(terms, "term", "left_semi").select(ident, "term", "tf")


def fit_indexer(df: DataFrame, label: str, index: str) -> StringIndexerModel:
    """Most frequent label first, equal counts in alphabetical order."""
    return StringIndexer(inputCol=label, outputCol=index).fit(df)


def one_hot(index: str, vector: str) -> OneHotEncoder:
    return OneHotEncoder(inputCol=index, outputCol=vector)


def index_to_label(prediction: str, name: str, indexer: StringIndexerModel) -> IndexToString:
    return IndexToString(inputCol=prediction, outputCol=name, labels=list(indexer.labels))
