"""Time columns. Epochs become zone-free UTC timestamps, so no session zone matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.bins import right_closed

# Right-closed edges of the parts of the day and their names.
DAY_EDGES = [0, 6, 12, 18, 23]
DAY_PARTS = ["Night", "Morning", "Afternoon", "Evening"]

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


# The epochs of the years 1 and 9999.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def from_epoch(seconds: Column) -> Column:
    """UTC time of whole seconds since 1970; numbers that are no date become NULL."""
    sound = F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds)
    return F.expr(EPOCH) + F.make_dt_interval(secs=sound)


def to_epoch(ts: Column) -> Column:
    """Whole seconds since 1970, rounded down, of a zone-free timestamp."""
    return F.timestamp_diff("SECOND", F.expr(EPOCH), ts)


def null_epoch_zero(ts: Column) -> Column:
    """1970-01-01 00:00 stands for a corrupt epoch and becomes NULL."""
    return F.nullif(ts, F.expr(EPOCH))


def safe_int(text: Column) -> Column:
    """Whole part of the number in a string; anything else, NULL included, becomes 0."""
    return F.coalesce(
        text.try_cast("bigint"),
        text.try_cast("double").try_cast("bigint"),
        F.lit(0).cast("bigint"),
    )


def time_of_day(hour: Column, include_midnight: bool = False) -> Column:
    """(0,6] Night, (6,12] Morning, (12,18] Afternoon, (18,23] Evening.

    Hour 0 lies outside the first interval and is NULL, as in the study;
    ``include_midnight`` counts it as Night.
    """
    return right_closed(hour, DAY_EDGES, DAY_PARTS, include_lowest=include_midnight)


def is_election_year(year: Column, election: int = 2022) -> Column:
    return year == election


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def month_number(name: Column) -> Column:
    """``January`` -> 1."""
    return F.month(F.to_date(F.concat(name, F.lit(" 01 2000")), "MMMM dd yyyy"))


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMMM")


def short_month(text: Column) -> Column:
    """``Nov 13`` -> 2013-11-01. Two-digit years from 69 up are 19xx."""
    month, short = F.split_part(text, F.lit(" "), F.lit(1)), F.split_part(text, F.lit(" "), F.lit(2))
    century = F.when(short >= "69", "19").otherwise("20")
    return F.to_date(F.concat_ws(" ", F.lit("01"), month, F.concat(century, short)), "dd MMM yyyy")
