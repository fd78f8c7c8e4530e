import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadlens.functions import bins, text, timeparts
from threadlens.functions.stem import stem_word


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def named(function):
    """The function of a column name, for ``column``."""
    return lambda _: function("v")


def test_parts_of_the_day_match_pandas_cut(spark):
    hours = list(range(24)) + [None]
    cut = pd.cut(pd.Series(hours), bins=timeparts.DAY_EDGES, labels=timeparts.DAY_PARTS)
    want = [None if pd.isna(x) else x for x in cut]
    assert column(spark, hours, "int", timeparts.time_of_day) == want
    filled = column(spark, hours, "int", lambda c: timeparts.time_of_day(c, include_midnight=True))
    assert filled[0] == "Night" and filled[1:] == want[1:]


def test_engagement_edges(spark):
    got = column(
        spark, [-1, 0, 5, 6, 100, 101, None], "int",
        lambda c: bins.right_closed(c, bins.ENGAGEMENT_EDGES, bins.ENGAGEMENT_LABELS),
    )
    assert got == [None, "<5", "<5", "5-10", "50-100", "100+", None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 200), min_size=1, max_size=40))
def test_right_closed_matches_pandas(spark, values):
    edges = [-1, 5, 10, 20, 50, 100, float("inf")]
    cut = pd.cut(pd.Series(values), bins=edges, labels=bins.ENGAGEMENT_LABELS)
    got = column(
        spark, values, "int",
        lambda c: bins.right_closed(c, bins.ENGAGEMENT_EDGES, bins.ENGAGEMENT_LABELS),
    )
    assert got == [None if pd.isna(x) else x for x in cut]


def test_thread_prefix(spark):
    values = ["t3_abc", "t1_t3_x", None]
    assert column(spark, values, "string", text.strip_thread_prefix) == ["abc", "t1_t3_x", None]
    anywhere = column(spark, values, "string", lambda c: text.strip_thread_prefix(c, anywhere=True))
    assert anywhere == ["abc", "t1_x", None]


def test_topics_are_case_sensitive_substrings(spark):
    flags = text.topic_flags(F.col("v"))
    rows = ["border wall", "Police", "a vaccine", "Trump", "global warming", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, v string")
    got = df.withColumns(flags).orderBy("i").collect()
    assert [r.dummy_police for r in got] == [True, False, False, False, False, None]
    assert got[2].dummy_healthcare and got[3].dummy_trump and got[4].dummy_climate


def test_single_cleaning_steps(spark):
    assert column(spark, ["  A  b "], "string", text.lower_trim) == ["a  b"]
    assert column(spark, ["a   b  c"], "string", text.squeeze_spaces) == ["a b c"]
    assert column(spark, ["café, 24x"], "string", text.letters_only) == ["caf     x"]
    assert column(spark, ["The café's Running!", "42"], "string", named(text.letter_tokens)) == [
        ["the", "caf", "s", "running"],
        [],
    ]


def test_clean_text_drops_stop_words_and_stems(spark):
    got = column(spark, ["The politicians were debating taxes, and you don't agree!"], "string", named(text.clean_text))
    assert got == ["politician debat tax agre"]


def test_lengths(spark):
    rows = ["One two. Three!", "", "no end", None]
    assert column(spark, rows, "string", text.char_length) == [15, 0, 6, None]
    assert column(spark, rows, "string", text.word_count) == [3, 0, 2, None]
    assert column(spark, rows, "string", text.sentence_count) == [2, 0, 1, None]


def test_epochs(spark):
    got = column(spark, ["1609459200", "x", None, "12.7", "1e3"], "string", timeparts.safe_int)
    assert got == [1609459200, 0, 0, 12, 1000]
    assert column(spark, [10**17, -(10**17)], "bigint", timeparts.from_epoch) == [None, None]
    times = column(spark, [1609459200, 0], "bigint", lambda c: timeparts.null_epoch_zero(timeparts.from_epoch(c)))
    assert str(times[0]) == "2021-01-01 00:00:00" and times[1] is None
    back = column(spark, [1609459261], "bigint", lambda c: timeparts.to_epoch(timeparts.from_epoch(c)))
    assert back == [1609459261]


def test_epoch_hours_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        hour = column(spark, [1609459200], "bigint", lambda c: F.hour(timeparts.from_epoch(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert hour == [0]


def test_months(spark):
    assert column(spark, ["January", "December"], "string", timeparts.month_number) == [1, 12]
    got = column(spark, ["Nov 13", "Jan 95"], "string", timeparts.short_month)
    assert [str(d) for d in got] == ["2013-11-01", "1995-01-01"]


STEMS = """
consigned consign|consistency consist|consolatory consolatori|conspiracy conspiraci
knightly knight|knives knive|running run|happily happili|generously generous
generation generat|communication communic|national nation|ties tie|cries cri|gas gas|this this
hopping hop|hoping hope|bed bed|agreed agre|feed feed|luxuriated luxuri|by by|say say|enjoy enjoy
hopefulness hope|psychology psycholog|quickly quick|hopeless hopeless|replacement replac
adoption adopt|controlling control|roll roll|rate rate|cease ceas|yesterday yesterday|skies sky
early earli|news news|proceeding proceed|inflation inflat|economy economi|police polic|fluently fluentli
"""


def test_stems(spark):
    pairs = [p.split() for line in STEMS.split("\n") for p in line.split("|") if p.strip()]
    got = column(spark, [word for word, _ in pairs], "string", named(stem_word))
    assert [(w, g) for (w, want), g in zip(pairs, got) if g != want] == []


def test_bins_need_one_label_each():
    with pytest.raises(ValueError):
        bins.right_closed(None, [0, 1, 2], ["a"])
