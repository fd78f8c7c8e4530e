import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadlens.operators import sampling


def smallest(rows, n):
    groups = {}
    for ident, group in rows:
        groups.setdefault(group, []).append((hashlib.md5(str(ident).encode()).hexdigest(), ident))
    return {(i, g) for g, found in groups.items() for _, i in sorted(found)[:n]}


@pytest.fixture(scope="module")
def rows():
    return [(i, "hot" if i % 10 else f"g{i % 7}") for i in range(20_000)]


@pytest.mark.parametrize("n", [1, 17, 300, 5000, 50_000])
def test_sample_is_the_n_smallest_hashes(spark, rows, n):
    df = spark.createDataFrame(rows, "id bigint, g string")
    got = {tuple(r) for r in sampling.sample_per_group(df, "g", "id", n).collect()}
    assert got == smallest(rows, n)


def test_sample_does_not_depend_on_the_partitioning(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, g string")
    picks = [
        {tuple(r) for r in sampling.sample_per_group(d, "g", "id", 40, groups=["hot", "g1"]).collect()}
        for d in (df.repartition(2), df.repartition(13, "g"))
    ]
    assert picks[0] == picks[1] and len(picks[0]) == 80


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 10_000), st.sampled_from("ab")), max_size=60, unique_by=lambda r: r[0]),
    st.integers(1, 30),
    st.integers(1, 4),
)
def test_any_digits_give_the_same_sample(spark, rows, n, digits):
    df = spark.createDataFrame(rows, "id bigint, g string")
    got = {tuple(r) for r in sampling.sample_per_group(df, "g", "id", n, digits=digits).collect()}
    assert got == smallest(rows, n)


def test_seed_changes_the_sample(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, g string")
    a, b = ({r.id for r in sampling.sample_per_group(df, "g", "id", 50, seed).collect()} for seed in ("x", "y"))
    assert a != b


def test_balance_takes_the_smallest_class(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, g string")
    counts = {r.g: r["count"] for r in sampling.balance_classes(df, "g", "id").groupBy("g").count().collect()}
    least = min(sum(1 for _, g in rows if g == name) for name in counts)
    assert set(counts.values()) == {least} and len(counts) == 8


def test_only_listed_groups_are_cut(spark, rows):
    df = spark.createDataFrame(rows + [(99_999, None)], "id bigint, g string")
    got = sampling.limit_some_groups(df, "g", "id", {"hot": 5, "g1": 3}).groupBy("g").count().collect()
    counts = {r.g: r["count"] for r in got}
    assert counts["hot"] == 5 and counts["g1"] == 3 and counts[None] == 1
    assert counts["g2"] == sum(1 for _, g in rows if g == "g2")


def test_split_keeps_every_row_once(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, g string")
    train, test = sampling.hash_split(df, "id")
    a, b = ({r.id for r in part.collect()} for part in (train, test))
    assert not a & b and len(a) + len(b) == len(rows) and 0.78 < len(a) / len(rows) < 0.82


def test_no_rows_for_a_size_of_zero(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, g string")
    assert sampling.sample_per_group(df, "g", "id", 0).count() == 0
    counts = {r.g for r in sampling.limit_some_groups(df, "g", "id", {"hot": 0}).select("g").distinct().collect()}
    assert "hot" not in counts and "g2" in counts
    for call in (lambda: sampling.sample_per_group(df, "g", "id", -1), lambda: sampling.limit_some_groups(df, "g", "id", {"hot": -1})):
        with pytest.raises(ValueError):
            call()


def test_rows_that_share_an_id_stay_together(spark):
    df = spark.createDataFrame([(7, "a")] * 500 + [(k, "a") for k in range(20)], "id bigint, g string")
    kept = sampling.sample_per_group(df, "g", "id", 10).groupBy("id").count().collect()
    counts = {r.id: r["count"] for r in kept}
    assert counts.get(7, 501) == 501 and sum(counts.values()) >= 10


def test_content_keys_tell_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x string, y string")
    assert sampling.with_content_key(df, ["x", "y"]).select("id").distinct().count() == 2


def test_fraction_by_hash_is_about_right_and_the_same_again(spark):
    df = spark.range(20_000)
    picks = [{r.id for r in sampling.hash_fraction(d, "id", 0.05).collect()} for d in (df, df.repartition(7))]
    assert picks[0] == picks[1] and 800 < len(picks[0]) < 1200
