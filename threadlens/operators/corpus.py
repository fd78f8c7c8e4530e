"""Word counts, TF-IDF in long form, and the two cleaning jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions.stem import stem_word
from threadlens.functions.text import kept_tokens, letter_tokens
from threadlens.functions.words import STOP_WORDS
from threadlens.operators.dealing import dealt_out
from threadlens.operators.joins import COMMON, join_by_frequency, least_frequency
from threadlens.operators.ranks import attach
from threadlens.sources.tables import stage


#: Words that one task puts back into their rows, about.
PART_WORDS = 1 << 20


def by_word(df: DataFrame, words: Column, change: Callable[[str], Column], out: str) -> DataFrame:
    """The rows with ``out``, the array ``words`` with every word changed; a column of that name is replaced.

    ``change`` is given the name of a column. It is worked out once per distinct word for the most frequent
    words, at most ``COMMON``, which are broadcast; other words, so rare that few rows share them, are changed where
    they are. Rows are dealt once, before they are cut into words, so that a row's words stay in one task:
    besides rows, only counts of words are shuffled. A null array stays null.
    """
    each = dealt_out(df).select(F.explode(words).alias("_word"))
    counted = stage(each.groupBy("_word").agg(F.count(F.lit(1)).alias("_n")), "words")
    limit, least = least_frequency(counted, "_n", COMMON)
    common = counted.filter(F.col("_n") >= limit).select("_word").distinct()
    dictionary = F.broadcast(common.select("_word", change("_word").alias("_new")))
    own = [c for c in df.columns if c != out]
    # A name longer than any other is free.
    row = "_" * (5 + max(map(len, [*df.columns, out])))
    # By the words counted: what Spark expects of a join's size can be far off.
    least_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least_parts, -(-(counted.agg(F.sum("_n")).first()[0] or 0) // PART_WORDS))
    dealt = df.withColumn(row, F.monotonically_increasing_id()).repartition(parts, row)
    rows = dealt.select(F.col(row).alias("_row"), (F.struct(*own) if own else F.lit(True)).alias("_own"), words.alias("_words"))
    placed = rows.select("_row", "_own", F.col("_words").isNull().alias("_none"), F.posexplode_outer("_words").alias("_pos", "_word"))
    # The other columns travel with the first word alone.
    first = F.when(F.coalesce("_pos", F.lit(0)) == 0, F.struct("_own", "_none"))
    changed = placed.select("_row", "_pos", "_word", first.alias("_first")).join(dictionary, "_word", "left")
    new = F.col("_new") if least >= limit else F.coalesce("_new", change("_word"))
    at = F.when(F.col("_pos").isNotNull(), F.struct("_pos", new.alias("_new")))
    together = changed.groupBy("_row").agg(
        F.sort_array(F.collect_list(at)).alias("_all"), F.first("_first", ignorenulls=True).alias("_first")
    )
    result = F.when(~F.col("_first._none"), F.col("_all._new"))
    kept = {name: F.col(f"_first._own.`{name}`") for name in own}
    return together.select(*[kept.get(name, result).alias(name) for name in dict.fromkeys([*df.columns, out])])


def clean_column(df: DataFrame, column: str, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """The column's texts cleaned in place: letters, no stop words, stems; a null text stays null."""
    found = by_word(df, kept_tokens(column, stop_words), stem_word, column)
    return found.withColumn(column, F.array_join(column, " "))


def annotated_clean(
    df: DataFrame, ident: str, text: str, stop_words: Sequence[str] | None = None
) -> DataFrame:
    """Second cleaning job: tokens, stop words, stems, then characters other than
    ``[A-Za-z0-9_]`` removed; one row per id and element of the result array.

    A NULL text gives a NULL result. Without a list, Spark's own English stop words are used, case-insensitively.
    """
    tokenizer = RegexTokenizer(
        inputCol=text, outputCol="_tokens", gaps=False, pattern=r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]+"
    )
    remover = StopWordsRemover(inputCol="_tokens", outputCol="_kept", caseSensitive=False)
    if stop_words is not None:
        remover.setStopWords(list(stop_words))
    stages = Pipeline(stages=[tokenizer, remover])
    texts = dealt_out(df.select(ident, F.coalesce(F.col(text), F.lit("")).alias(text), F.col(text).isNull().alias("_none")))
    # Written, so that texts are cut once for the dictionary and the words.
    found = stage(stages.fit(texts).transform(texts).select(ident, F.when(~F.col("_none"), F.col("_kept")).alias("_kept")), "tokens")
    normal = by_word(found, F.col("_kept"), lambda word: F.regexp_replace(stem_word(word), r"[^\w\d\s]", ""), "_kept")
    joined = F.array_join(F.filter("_kept", lambda w: w != ""), " ")
    return normal.select(ident, F.array(joined).alias("result")).select(
        ident, F.explode("result").alias("clean_text")
    )


def word_counts(
    df: DataFrame,
    text: str,
    groups: Sequence[str] = (),
    stop_words: Iterable[str] = STOP_WORDS,
) -> DataFrame:
    """(groups, word, count) of stems. Raw words are counted first, so every distinct word
    is stemmed once and only counts are shuffled."""
    words = dealt_out(df.select(*groups, text)).select(
        *groups, F.explode(kept_tokens(text, stop_words)).alias("raw")
    )
    raw = words.groupBy(*groups, "raw").agg(F.count(F.lit(1)).alias("n"))
    stems = raw.select(*groups, stem_word("raw").alias("word"), "n")
    return stems.groupBy(*groups, "word").agg(F.sum("n").alias("count"))


def stem_table(df: DataFrame, text: str) -> DataFrame:
    """(word, stem, count) for the whole vocabulary of the corpus."""
    raw = (
        dealt_out(df.select(text)).select(F.explode(letter_tokens(text)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return raw.select("word", stem_word("word").alias("stem"), "count")


def sorted_by_count(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("count"), F.asc("word"))


def top_words(counts: DataFrame, n: int = 50) -> DataFrame:
    return sorted_by_count(counts).limit(n)


def top_words_per_group(counts: DataFrame, group: str, n: int = 50) -> DataFrame:
    """The n most frequent words of each group, with their rank.

    Spark keeps only n rows per group and task before the shuffle (group limit).
    """
    order = Window.partitionBy(group).orderBy(F.desc("count"), F.asc("word"))
    ranked = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def token_rows(df: DataFrame, keep: Sequence[str], tokens: Column) -> DataFrame:
    """One row per token: the kept columns and ``term``."""
    return df.select(*keep, F.explode(tokens).alias("term"))


def stem_counts(
    df: DataFrame, ident: str, text: str, stop_words: Iterable[str] = STOP_WORDS
) -> DataFrame:
    """(id, term, tf) over cleaned tokens. Texts are dealt by id once; a document's words are
    then counted, stemmed once each and added up by stem where they are. The number of parts
    is named, since stemming costs far more than the size of the texts tells Spark."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(ident, text).repartition(parts, ident)
    raw = dealt.select(ident, F.explode(kept_tokens(text, stop_words)).alias("_raw"))
    counts = raw.groupBy(ident, "_raw").agg(F.count(F.lit(1)).alias("_n"))
    stems = counts.select(ident, stem_word("_raw").alias("term"), "_n")
    return stems.groupBy(ident, "term").agg(F.sum("_n").alias("tf"))


def coded_words(
    df: DataFrame, text: str, stop_words: Iterable[str] = STOP_WORDS, min_length: int = 1
) -> tuple[DataFrame, DataFrame]:
    """(raw, code, n) and (code, term, n): the dictionary of a corpus, as written tables; n counts occurrences.

    Every distinct word is stemmed once and every distinct stem of at least ``min_length``
    letters has a number; raw words of other stems are left out.
    """
    raw = dealt_out(df.select(text)).select(F.explode(kept_tokens(text, stop_words)).alias("raw"))
    raw = raw.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    stems = stage(raw.select("raw", stem_word("raw").alias("term"), "n"), "stems")
    long = stems.filter(F.length("term") >= min_length)
    totals = long.groupBy("term").agg(F.sum("n").alias("n"))
    terms = stage(totals.select("term", F.monotonically_increasing_id().alias("code"), "n"), "terms")
    return stage(long.join(terms.drop("n"), "term").select("raw", "code", "n"), "codes"), terms


def coded_counts(
    df: DataFrame, ident: str, text: str, codes: DataFrame, stop_words: Iterable[str] = STOP_WORDS
) -> DataFrame:
    """(id, code, tf) of cleaned texts, as a written table; words without a code are left out.

    Frequent words meet their codes where they are; besides rows of numbers, only rare words are shuffled.
    """
    words = dealt_out(df.select(ident, text)).select(ident, F.explode(kept_tokens(text, stop_words)).alias("raw"))
    counts = join_by_frequency(words, codes, "raw", "n").groupBy(ident, "code").agg(F.count(F.lit(1)).alias("tf"))
    return stage(counts, "counts")


def term_counts(rows: DataFrame, ident: str) -> DataFrame:
    """(id, term, tf)."""
    return rows.groupBy(ident, "term").agg(F.count(F.lit(1)).alias("tf")).filter("tf > 0")


def document_frequencies(counts: DataFrame, key: str = "term") -> DataFrame:
    """(term, df); rows of ``counts`` are unique by id and term."""
    return counts.groupBy(key).agg(F.count(F.lit(1)).alias("df"))


def _weighted(documents: DataFrame, counts: DataFrame, idf: Column, key: str = "term") -> DataFrame:
    """Counts with ``df`` and ``idf`` of their terms; ``counts`` is a written table."""
    frequencies = attach(document_frequencies(counts, key), documents.agg(F.count(F.lit(1)).alias("docs")), [])
    table = stage(frequencies.select(key, "df", idf.alias("idf"), F.col("df").alias("_often")), "frequencies")
    return join_by_frequency(counts, table, key, "_often")


def tfidf_normalised(
    documents: DataFrame, counts: DataFrame, ident: str, min_length: int = 2
) -> DataFrame:
    """(id, term, tf, df, idf, weight) of term counts, with idf = ln((1+n)/(1+df)) + 1 and the weights of
    a document of Euclidean length 1. Shorter terms than ``min_length`` are left out."""
    counts = counts.filter(F.length("term") >= min_length)
    idf = F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1
    weighted = _weighted(documents, stage(counts, "counts"), idf).withColumn("raw", F.col("tf") * F.col("idf"))
    # A window over one document's terms: a group no larger than a document.
    row = Window.partitionBy(ident)
    return weighted.withColumn(
        "weight", F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(row))
    ).select(ident, "term", "tf", "df", "idf", "weight")


def tfidf_coded(documents: DataFrame, counts: DataFrame, ident: str) -> DataFrame:
    """(id, code, tf, df, weight): the weights of ``tfidf_normalised`` over numbers instead of terms.

    ``counts`` is a written table of (id, code, tf); names are joined to what is left in the end.
    """
    idf = F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1
    raw = _weighted(documents, counts, idf, "code").withColumn("raw", F.col("tf") * F.col("idf"))
    # A window over one document's terms: a group no larger than a document.
    row = Window.partitionBy(ident)
    return raw.withColumn("weight", F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(row))).select(
        ident, "code", "tf", "df", "weight"
    )


def tfidf_plain(documents: DataFrame, counts: DataFrame, ident: str) -> DataFrame:
    """(id, term, tf, df, idf, weight) of term counts, with idf = ln((n+1)/(df+1)), weights not scaled."""
    idf = F.log((F.col("docs") + 1) / (F.col("df") + 1))
    weighted = _weighted(documents, stage(counts, "counts"), idf)
    return weighted.withColumn("weight", F.col("tf") * F.col("idf")).select(
        ident, "term", "tf", "df", "idf", "weight"
    )


def important_terms(weights: DataFrame, n: int = 50) -> DataFrame:
    """Terms by their summed weight."""
    return (
        weights.groupBy("term")
        .agg(F.sum("weight").alias("weight"))
        .orderBy(F.desc("weight"), F.asc("term"))
        .limit(n)
    )


def important_coded(weights: DataFrame, terms: DataFrame, n: int = 50) -> DataFrame:
    """``important_terms`` of coded weights: summed over numbers, named last."""
    return important_terms(weights.groupBy("code").agg(F.sum("weight").alias("weight")).join(terms.select("code", "term"), "code"), n)
