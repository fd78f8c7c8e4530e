import random
import zlib

from helpers_llm import documents, odd_rows, sentences

from threadlens.llm import quality

LABELS = "doc_id bigint, quality int, toxic int, label int, f string"


def corpus(n=240):
    rng = random.Random(6)
    rows, labels = [], []
    for k, text in enumerate(sentences(5, n)):
        good = k % 3 > 0
        if not good:
            words = text.split()
            text = rng.choice([" | ".join(words), " ".join(w + "!!" for w in words).upper(), " ".join([words[0]] * 30 + [words[1]] * 30)])
        rows.append((k, text, "s"))
        labels.append((k, int(good), 0, 9, "x"))
    return rows, labels


def table(spark, labels):
    return spark.createDataFrame(labels, LABELS)


def test_held_out_documents_are_told_apart(spark):
    rows, labels = corpus()
    rows += [(None, None, "s"), (1000, "", "s"), (1001, "word", "s"), (5, rows[5][1], "s")]
    found = quality.quality_scores(documents(spark, rows), table(spark, labels)).collect()
    assert len(found) == len(rows)
    truth = {i: q for i, q, *_ in labels}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    assert len({r.score for r in found if r.doc_id == 5}) == 1


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows, labels = corpus(120)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, *rest) for i, q, *rest in labels]
    docs = documents(spark, rows)
    first = quality.quality_scores(docs, table(spark, labels)).collect()
    second = quality.quality_scores(docs, table(spark, turned)).collect()
    assert {r.doc_id: round(r.score, 9) for r in first} == {r.doc_id: round(r.score, 9) for r in second}


def test_null_repeated_and_other_labels_are_passed_over(spark):
    rows, labels = corpus(120)
    odd = labels + [(None, 1, 0, 0, ""), (3, None, 0, 0, ""), (4, 7, 0, 0, ""), labels[0], (99999, 1, 0, 0, "")]
    docs = documents(spark, rows)
    first = quality.learn(docs, table(spark, labels))
    second = quality.learn(docs, table(spark, odd))
    assert [round(w, 9) for w in first[0]] == [round(w, 9) for w in second[0]] and round(first[1] - second[1], 9) == 0


def test_without_both_labels_everything_stays(spark):
    docs = documents(spark, odd_rows())
    for labels in ([], [(k, 1, 0, 0, "") for k in range(12)]):
        found = quality.quality_scores(docs, table(spark, labels)).collect()
        assert {(r.score, r.predicted) for r in found} == {(0.5, 1)}
        assert quality.keep_good(docs, table(spark, labels)).count() == docs.count()


def test_stage_keeps_columns_and_good_rows(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    kept = quality.keep_good(docs, table(spark, labels))
    assert kept.columns == docs.columns
    predicted = {r.doc_id for r in quality.quality_scores(docs, table(spark, labels)).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == predicted
    assert quality.keep_good(documents(spark, []), table(spark, labels)).count() == 0


def test_features_of_odd_texts():
    for text in (None, "", " ", "\n\n", "a", "日本語" * 1000, "x" * 100_000, "\x00\x01"):
        found = quality.describe(text)
        assert len(found) == len(quality.FEATURES) and all(abs(v) < 1e6 for v in found)


def test_the_threshold_covers_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "PER_LABEL", 25)
    rng = random.Random(8)
    rows, labels = [], []
    for k, text in enumerate(sentences(9, 900)):
        words = text.split()
        good = k % 7 > 0
        marked = rng.random() < (0.35 if good else 0.75)
        share = rng.random() * (0.3 if marked else 0.1)
        rows.append((k, " ".join(w + "!" if rng.random() < share else w for w in words), "s"))
        labels.append((k, int(good), 0, 9, "x"))
    weights, threshold = quality.learn(documents(spark, rows), table(spark, labels))
    learned = [
        (sum(w * x for w, x in zip(weights, quality.describe(t))), labels[i][1])
        for i, t, _ in rows
        if zlib.crc32(str(i).encode()) % 3 != 1
    ]

    def wrong(cut):
        return sum((s > cut) != bool(q) for s, q in learned)

    scores = sorted({s for s, _ in learned})
    assert wrong(threshold) == min(wrong((a + b) / 2) for a, b in zip(scores, scores[1:]))
