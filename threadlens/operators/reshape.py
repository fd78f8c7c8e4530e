"""Wide to long and back, unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Month column names of the wide indicator tables and their full names.
MONTHS = {
    "Jan": "January", "Feb": "February", "Mar": "March", "Apr": "April", "May": "May",
    "Jun": "June", "Jul": "July", "Aug": "August", "Sep": "September",
    "Oct": "October", "Nov": "November", "Dec": "December",
}


def stack_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def months_to_rows(df: DataFrame, value: str, year: str = "Year", months: Sequence[str] | None = None) -> DataFrame:
    """Wide month columns -> (Year, Month, value)."""
    months = list(months) if months else list(MONTHS.values())
    return df.unpivot([year], months, "Month", value)


def rows_to_months(df: DataFrame, value: str, year: str = "Year") -> DataFrame:
    """(Year, Month, value) -> one row per year; month names are given, so no extra scan."""
    return df.groupBy(year).pivot("Month", list(MONTHS.values())).agg(F.max(value))


def metrics_to_rows(df: DataFrame, ident: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Metric columns -> (ident, variable, value)."""
    return df.unpivot(list(ident), list(metrics), "variable", "value")


def true_flags(df: DataFrame, ident: Sequence[str], flags: Sequence[str], name: str = "topic") -> DataFrame:
    """One row per flag that is true; a row with two true flags appears twice."""
    long = df.unpivot(list(ident), list(flags), name, "flag")
    return long.filter("flag").drop("flag")
