"""Monthly economic indicators from files with title lines above the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.timeparts import first_of_month, month_name, month_number, short_month
from threadlens.operators.cleaning import strip_thousands
from threadlens.operators.reshape import MONTHS, months_to_rows
from threadlens.schemas import INDICATORS
from threadlens.sources.tables import read_summary_csv

YEAR_ROW = r"^\d{4}$"
MONTH_ROW = r"^[A-Z][a-z]{2} \d{2}$"


def read_below_title(
    spark: SparkSession, path: str, columns: Sequence[str], first_cell: str
) -> DataFrame:
    """All-string CSV rows whose first cell looks like data; title lines do not."""
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.read.csv(path, schema=schema, header=False, escape='"').filter(
        F.col(columns[0]).rlike(first_cell)
    )


def read_wide_indicator(
    spark: SparkSession, path: str, value: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Year x month table -> (Year, Month, value); extra trailing columns are dropped."""
    months = list(MONTHS.values())
    wide = read_below_title(spark, path, ["Year", *months, *extra], YEAR_ROW)
    return months_to_rows(wide.drop(*extra), value)


def read_long_indicator(spark: SparkSession, path: str, value: str) -> DataFrame:
    """``Nov 13, "16,576.66"`` rows -> (Year, Month, value)."""
    rows = read_below_title(spark, path, ["Date", value], MONTH_ROW)
    day = short_month(F.col("Date"))
    return rows.select(
        F.date_format(day, "yyyy").alias("Year"), month_name(day).alias("Month"), value
    )


def join_indicators(
    cpi: DataFrame, unemployment: DataFrame, dow: DataFrame, years: Sequence[str] = ("2020", "2021")
) -> DataFrame:
    """One row per month found in all three, still as text."""
    chosen = dow.filter(F.col("Year").isin(list(years)))
    return cpi.join(unemployment, ["Year", "Month"]).join(chosen, ["Year", "Month"])


def typed_indicators(indicators: DataFrame) -> DataFrame:
    """Commas off, months as numbers, values as doubles; a figure that is no number is NULL."""
    plain = strip_thousands(indicators)
    return plain.select(
        F.col("Year").try_cast("int").alias("Year"),
        month_number(F.col("Month")).alias("Month"),
        *[F.col(c).try_cast("double").alias(c) for c in ("CPI", "Unemp_Rate", "DOW")],
    )


def read_saved_indicators(spark: SparkSession, path: str) -> DataFrame:
    """The joined table as it was saved, with a row-number column in front, typed."""
    saved = read_summary_csv(spark, path, f"_c0 string, {INDICATORS}", saved_index="_c0")
    return typed_indicators(saved)


def with_date(indicators: DataFrame) -> DataFrame:
    return indicators.withColumn("date", first_of_month(F.col("Year"), F.col("Month")))
