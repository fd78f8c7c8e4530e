import math
from collections import Counter

from pyspark.ml.feature import CountVectorizer, Tokenizer
from pyspark.sql import functions as F

from threadlens.operators import corpus, features, joins
from threadlens.operators import dealing
from threadlens.operators.dealing import dealt_out
from threadlens.sources import tables
from threadlens.sources.tables import stage

TEXTS = ["the cat  sat on a mat", "Cat and dog", "dog dog bird\n", "", "   ", "a b"]


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")


def test_tokens_as_a_column_match_the_tokenizer(spark):
    df = texts(spark)
    both = Tokenizer(inputCol="text", outputCol="a").transform(df).withColumn("b", features.spark_tokens("text"))
    for r in both.collect():
        assert r.a == r.b, r.text


def test_long_counts_match_the_vectoriser(spark):
    df = texts(spark)
    words = Tokenizer(inputCol="text", outputCol="words").transform(df)
    model = CountVectorizer(inputCol="words", outputCol="v").fit(words)
    want = {
        (r.id, model.vocabulary[i], int(n))
        for r in model.transform(words).collect()
        for i, n in zip(r.v.indices, r.v.values)
    }
    got = {(r.id, r.term, r.tf) for r in features.count_vectors_long(df, "id", features.spark_tokens("text")).collect()}
    assert got == want


def test_small_vocabulary_keeps_the_most_frequent(spark):
    got = features.count_vectors_long(texts(spark), "id", F.split("text", " "), vocabulary=1)
    assert {r.term for r in got.collect()} == {""}


def test_normalised_rows_have_length_one(spark):
    tokens = F.filter(F.split(F.lower("text"), r"\s+"), lambda t: t != "")
    df = texts(spark)
    rows = corpus.tfidf_normalised(df, corpus.term_counts(corpus.token_rows(df, ["id"], tokens), "id"), "id").collect()
    lengths = Counter()
    for r in rows:
        lengths[r.id] += r.weight**2
    assert set(lengths) == {0, 1, 2} and all(math.isclose(v, 1.0) for v in lengths.values())
    cat = next(r for r in rows if r.term == "cat")
    assert math.isclose(cat.idf, math.log((1 + 6) / (1 + 2)) + 1)


def test_plain_weights(spark):
    df = texts(spark)
    rows = corpus.tfidf_plain(df, corpus.term_counts(corpus.token_rows(df, ["id"], F.split("text", " ")), "id"), "id").collect()
    dog = next(r for r in rows if r.term == "dog" and r.id == 2)
    assert (dog.tf, dog.df) == (2, 2) and math.isclose(dog.weight, 2 * math.log(7 / 3))


def test_annotated_clean_keeps_the_id(spark):
    df = spark.createDataFrame([(1, "Running, RUNNING! the dogs"), (2, None), (3, "!!")], "id bigint, text string")
    got = {r.id: r.clean_text for r in corpus.annotated_clean(df, "id", "text").collect()}
    assert got == {1: "run run dog", 2: None, 3: ""}


def test_word_counts_fold_stems(spark):
    df = spark.createDataFrame([("run running runs the",), ("dog",)], "text string")
    counts = {r.word: r["count"] for r in corpus.word_counts(df, "text").collect()}
    assert counts == {"run": 3, "dog": 1}


def test_group_limit_is_applied_before_the_shuffle(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counts = corpus.word_counts(docs, "text", ["lang"])
    plan = corpus.top_words_per_group(counts, "lang", 50)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_words_as_json_lines(spark, tmp_path):
    df = spark.createDataFrame([("a", 2), ("b", 1)], "word string, count bigint")
    tables.write_word_counts_json(df, str(tmp_path / "bow"))
    back = spark.read.schema("word string, count bigint").json(str(tmp_path / "bow"))
    assert sorted(map(tuple, back.collect())) == [("a", 2), ("b", 1)]


def test_words_are_counted_by_stem_where_the_text_is(spark):
    rows = [(1, "running runs dogs"), (2, "running the running"), (3, None), (4, "")]
    counts = corpus.stem_counts(spark.createDataFrame(rows, "id bigint, text string"), "id", "text")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, counts.collect())) == [(1, "dog", 1), (1, "run", 2), (2, "run", 2)]


def test_null_texts_keep_their_row(spark):
    df = spark.createDataFrame([(1, "Dogs running!"), (2, None), (3, "")], "id bigint, text string")
    found = {r.id: r.clean_text for r in corpus.annotated_clean(df, "id", "text").collect()}
    assert found == {1: "dog run", 2: None, 3: ""}


def test_library_idf_matches_the_long_form(spark):
    df = texts(spark)
    model = features.fit_tfidf(df, "text")
    terms = features.vocabulary_of(model)
    want = {
        (r.id, terms[i]): w
        for r in model.transform(df).collect()
        for i, w in zip(r.features.indices, r.features.values)
    }
    rows = features.count_vectors_long(df, "id", features.spark_tokens("text"))
    got = {(r.id, r.term): r.weight for r in corpus.tfidf_plain(df, rows, "id").collect()}
    assert set(got) == set(want) and all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in got)


ODD = [(1, "Running dogs", "a"), (2, None, "b"), (3, "", None), (4, "the of", "c"), (4, "the of", "c"), (5, "dogs " * 3000, "d")]


def test_words_are_changed_in_place(spark):
    df = spark.createDataFrame(ODD, "_row int, text string, _word string")
    want = [(1, "run dog", "a"), (2, None, "b"), (3, "", None), (4, "", "c"), (4, "", "c"), (5, " ".join(["dog"] * 3000), "d")]
    found = corpus.clean_column(df, "text")
    assert found.columns == df.columns and sorted(map(tuple, found.collect())) == sorted(want, key=lambda r: r[0])
    alone = corpus.clean_column(df.select("text"), "text")
    assert alone.columns == ["text"] and alone.count() == len(ODD)
    assert corpus.clean_column(df.limit(0), "text").collect() == []


def test_each_distinct_word_is_changed_once(spark):
    df = spark.createDataFrame(ODD, "id int, text string, x string")
    plan = corpus.clean_column(df, "text")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    stems = next(i for i, line in enumerate(lines) if "AS _new" in line)
    assert sum("AS _new" in line for line in lines) == 1 and "Aggregate [_word" in lines[stems]


def test_coded_weights_equal_those_by_name(spark):
    rows = [(1, "running runs dogs x"), (2, "running the running"), (3, None), (4, ""), (5, "dogs ate")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    codes, terms = corpus.coded_words(df, "text", min_length=2)
    weights = corpus.tfidf_coded(df, corpus.coded_counts(df, "id", "text", codes), "id")
    got = {(r.id, r.term): (r.tf, r.df, round(r.weight, 12)) for r in weights.join(terms, "code").collect()}
    plain = corpus.tfidf_normalised(df, corpus.stem_counts(df, "id", "text"), "id")
    assert got == {(r.id, r.term): (r.tf, r.df, round(r.weight, 12)) for r in plain.collect()}
    assert terms.select("code").distinct().count() == terms.count() == 3
    top = [tuple(r) for r in corpus.important_coded(weights, terms, 2).collect()]
    assert [t for t, _ in top] == [r.term for r in corpus.important_terms(plain, 2).collect()]


def test_only_small_inputs_are_dealt_out(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert dealt_out(docs).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert "Repartition" not in dealt_out(docs)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rare_words_meet_their_values_like_frequent_ones(spark):
    rows = spark.createDataFrame([(k, w) for k in range(30) for w in ["a", "b" if k % 2 else "a", f"r{k}"]], "id int, w string")
    table = stage(rows.groupBy("w").agg(F.count(F.lit(1)).alias("n")).withColumn("size", F.col("n") * 10), "table")
    whole = sorted(map(tuple, joins.join_by_frequency(rows, table, "w", "n").collect()))
    for most in (0, 1, 2, 5):
        found = joins.join_by_frequency(rows, table, "w", "n", most)
        assert found.columns == ["w", "id", "size"] and sorted(map(tuple, found.collect())) == whole
    near = joins.join_by_frequency(rows, table, "w", "n", 2)
    assert "BroadcastHashJoin" in near._jdf.queryExecution().executedPlan().toString()


def test_parts_of_word_counts_grow_with_the_input(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealing.parts_of(docs) == least == dealing.parts_of(texts(spark))
    monkeypatch.setattr(dealing, "PART_BYTES", 100)
    counted = features.count_vectors_long(docs, "doc_id", features.spark_tokens("text"))
    assert dealing.parts_of(docs) > 2 * least and counted.rdd.getNumPartitions() == dealing.parts_of(docs)


def test_words_are_counted_once_for_the_vectoriser(spark, monkeypatch):
    df, fitted, fit = texts(spark), [], CountVectorizer.fit
    monkeypatch.setattr(CountVectorizer, "fit", lambda self, given, *rest: fitted.append(given.count()) or fit(self, given, *rest))
    totals = features.word_totals(df, "text")
    model = features.fit_tfidf(df, "text", totals, vocabulary=3)
    assert fitted == [1] and features.vocabulary_of(model) == ["dog", "", "a"] and model.stages[-1].numDocs == len(TEXTS)
    assert features.vocabulary_of(features.fit_tfidf(df, "text", min_df=2)) and fitted == [1, len(TEXTS)]
    plan = features.vectors_long(model.transform(df), "id", "rawFeatures", "features", ["dog", "", "a"])._jdf.queryExecution()
    assert "hashpartitioning" not in plan.executedPlan().toString()


def test_rare_words_are_changed_in_their_rows(spark, monkeypatch):
    df = spark.createDataFrame(ODD, "_row int, text string, _word string")
    whole = sorted(map(tuple, corpus.clean_column(df, "text").collect()), key=repr)
    for most in (0, 1):
        monkeypatch.setattr(corpus, "COMMON", most)
        found = corpus.clean_column(df, "text")
        assert found.columns == df.columns and sorted(map(tuple, found.collect()), key=repr) == whole
    notes = spark.createDataFrame([(1, "Running, RUNNING! the dogs"), (2, None), (3, "!!")], "id bigint, text string")
    assert {r.id: r.clean_text for r in corpus.annotated_clean(notes, "id", "text").collect()} == {1: "run run dog", 2: None, 3: ""}


def test_no_word_of_a_cleaned_text_is_shuffled(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    plan = corpus.clean_column(docs, "text")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    # One for the words of the dictionary, one for the rows before they are cut.
    assert plan.count("Exchange hashpartitioning") == 2


def test_parts_of_cleaned_rows_follow_the_words_counted(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    few = docs.join(docs.select(F.col("doc_id").alias("other"), F.col("text").alias("again")), F.col("doc_id") == F.col("other")).select("doc_id", "text")
    assert dealing.parts_of(few) > 1000
    cleaned = corpus.clean_column(few, "text")
    assert "hashpartitioning" in cleaned._jdf.queryExecution().executedPlan().toString()
    assert cleaned.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
