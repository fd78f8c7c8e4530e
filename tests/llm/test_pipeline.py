import corpus_pipeline
import public_tokenizers
import pytest
from helpers_llm import DOCUMENTS, documents, odd_rows, sentences
from tokenizers import Tokenizer

import __spark_entry__
from threadlens.llm import queries


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of small tables: odd rows, junk, near copies and benchmark passages."""
    folder = str(tmp_path_factory.mktemp("tables"))
    texts = sentences(50, 90)
    rows = [(100 + k, t, f"s{k % 4 if k < 60 else 0}") for k, t in enumerate(texts)]
    rows += [(300 + k, " | ".join(t.split()), "s1") for k, t in enumerate(sentences(51, 40))]
    rows += [(400, "Before this. " + texts[5] * 1, "s2"), (401, texts[6] + " and " + sentences(52, 1)[0], "s3")]
    rows += [r for r in odd_rows() if r[0] not in (29,)]
    docs = documents(spark, rows)
    docs.select("doc_id", "text", "lang", "source", "n_chars").coalesce(2).write.parquet(f"{folder}/documents.parquet")
    labels = [(100 + k, 1, 0) for k in range(60)] + [(300 + k, 0, 0) for k in range(40)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, sentences(52, 1)[0])], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_one_after_the_other(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names, sizes = [], []
    for name, step in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, step(spark, docs, tables).cache()
        assert docs.columns == before.columns and docs.dtypes == before.dtypes
        names.append(name)
        sizes.append(docs.count())
        ids = {r.doc_id for r in docs.collect()}
        if name == "quality":
            assert not any(i is not None and 300 <= i < 340 for i in ids) and sum(100 <= i < 190 for i in ids if i) >= 88
        if name == "near_copies":
            assert {20, 21, 400} & ids == {20, 21, 400} - {20, 21, 400} or 0 in ids
            assert 20 not in ids and 105 in ids
        if name == "benchmark":
            assert 401 not in ids and 106 in ids
    final = corpus_pipeline.STAGES[-1][1](spark, docs, tables).collect()
    assert names == ["quality", "near_copies", "benchmark", "mixing"] and sizes[0] > sizes[1] > sizes[2] < sizes[3] == len(final)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    count = {}
    for r in docs.collect():
        count.setdefault(r.doc_id, set()).add(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1)
    assert all(r.n_tokens in count[r.doc_id] for r in final)
    starts = sorted((r.start, r.n_tokens) for r in final)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    whole = corpus_pipeline.run(spark, tables).collect()
    assert sorted(map(str, whole)) == sorted(map(str, final))


@pytest.mark.parametrize("name, step", corpus_pipeline.STAGES)
def test_empty_documents(spark, tables, name, step):
    empty = spark.createDataFrame([], DOCUMENTS)
    found = step(spark, empty, tables)
    assert found.count() == 0 and (name == "tokens" or found.columns == empty.columns)


def test_every_query_is_registered():
    named = __spark_entry__.queries()
    assert "pipeline" in named and len([n for n in named if n.startswith("op")]) == 13
    assert set(queries.ORACLES) <= set(queries.QUERIES) and set(queries.ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, folder, name):
    import compare

    found, _ = compare.compare(spark, compare.connect(folder), folder, name)
    assert found.startswith("ok"), found
