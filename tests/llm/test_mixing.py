import hashlib
import math

import pytest
from helpers_llm import documents, odd_rows, sentences

from threadlens.llm import mixing


def corpus():
    texts = sentences(4, 120)
    sizes = {"a": 80, "b": 20, "c": 12, "d": 8}
    names = [s for s, n in sizes.items() for _ in range(n)]
    return [(k, t, s) for k, (t, s) in enumerate(zip(texts, names))]


def weight(share, e):
    raised = [s**e for s in share]
    return [r / sum(raised) for r in raised]


def entropy(weights):
    return -sum(w * math.log(w) for w in weights)


def shares(rows):
    total = {}
    for _, t, s in rows:
        total[s] = total.get(s, 0) + len((t or "").split())
    return {s: n / sum(total.values()) for s, n in total.items() if n}, total


def test_exponent_meets_each_limit(spark):
    share, _ = shares(corpus())
    totals = spark.createDataFrame([(s,) for s in share.values()], "share double")
    for limit in (1.5, 2.0, 4.0):
        e = mixing.exponent_for(totals, repeats=limit)
        raised = [s ** (e - 1) for s in share.values()]
        assert math.isclose(max(raised) / min(raised), limit, rel_tol=1e-6)
    assert mixing.exponent_for(totals, repeats=1000.0) == 0.0
    assert math.isclose(mixing.exponent_for(totals, repeats=1.0), 1.0)
    for aim in (1.1, 1.3):
        e = mixing.exponent_for(totals, entropy=aim)
        assert math.isclose(entropy(weight(share.values(), e)), aim, rel_tol=1e-6)
    assert mixing.exponent_for(totals, entropy=99.0) == pytest.approx(0.0, abs=1e-9)
    assert mixing.exponent_for(totals, entropy=0.0) == 1.0
    with pytest.raises(ValueError):
        mixing.exponent_for(totals)


def block(i):
    return int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:8], 16) % mixing.BLOCKS


def test_budgets_are_spent_in_block_passes(spark):
    rows = corpus()
    docs = documents(spark, rows)
    found = mixing.mixed(docs, repeats=2.0)
    assert found.columns == [*docs.columns, "_mix_pass", "mix_place", "mix_budget"]
    share, total = shares(rows)
    e = 1 - math.log(2.0) / math.log(max(share.values()) / min(share.values()))
    factor = min(s ** (e - 1) for s in share.values())
    rows_found = found.collect()
    for s in share:
        budget = round(total[s] * share[s] ** (e - 1) / factor)
        mine = [r for r in rows_found if r.source == s]
        assert {r.mix_budget for r in mine} == {budget}
        taken = sum(len(r.text.split()) for r in mine)
        largest = max(
            sum(len(t.split()) for i, t, x in rows if x == s and block(i) == b) for b in {block(i) for i, _, x in rows if x == s}
        )
        assert abs(taken - budget) <= largest / 2 + 1
        passes = {p: [r for r in mine if r._mix_pass == p] for p in {r._mix_pass for r in mine}}
        whole = {i for i, _, x in rows if x == s}
        assert {r.doc_id for r in passes[0]} == whole
        orders = []
        for p, some in passes.items():
            places = sorted({(r.mix_place, block(r.doc_id)) for r in some})
            assert [k for k, _ in places] == list(range(len(places)))
            orders.append([b for _, b in places])
            digest = [hashlib.md5(f"s:{s}:{b}:{p}".encode()).hexdigest() for _, b in places]
            assert digest == sorted(digest)


def test_nothing_is_lost(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    found = mixing.remixed(docs, repeats=3.0)
    assert found.columns == docs.columns
    got = [(r.doc_id, r.text, r.source) for r in found.collect()]
    assert set(got) == {tuple(r) for r in rows}
    assert all(got.count(r) >= rows.count(r) for r in set(rows))


def test_null_source_is_one_of_its_own(spark):
    rows = [(1, "a b c", None), (2, "a b c", "n"), (3, "a", "s:n"), (4, "", "empty"), (5, None, "empty")]
    found = mixing.mixed(documents(spark, rows), repeats=1.0).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 3, 4, 5]
    assert {r.doc_id: r.mix_budget for r in found} == {1: 3, 2: 3, 3: 1, 4: None, 5: None}


def test_empty_table(spark):
    assert mixing.mixed(documents(spark, []), repeats=2.0).count() == 0
    assert mixing.remixed(documents(spark, [(1, "", "s")]), entropy=0.5).count() == 1
