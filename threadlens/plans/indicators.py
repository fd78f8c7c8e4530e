"""Monthly economic indicators from their published files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from threadlens.operators.reshape import metrics_to_rows
from threadlens.operators.summary import describe_by
from threadlens.sources import indicators as files


def load_indicators(
    spark: SparkSession, cpi: str, unemployment: str, dow: str, years: Sequence[str] = ("2020", "2021")
) -> DataFrame:
    """(Year, Month, CPI, Unemp_Rate, DOW, date), one row per month."""
    joined = files.join_indicators(
        files.read_wide_indicator(spark, cpi, "CPI", ["HALF1", "HALF2"]),
        files.read_wide_indicator(spark, unemployment, "Unemp_Rate"),
        files.read_long_indicator(spark, dow, "DOW"),
        years,
    )
    return files.with_date(files.typed_indicators(joined))


def indicator_summaries(indicators: DataFrame) -> dict[str, DataFrame]:
    return {
        "summary_table1": describe_by(indicators, ["Year"], ["Month", "CPI", "Unemp_Rate", "DOW"]),
        "summary_table2": describe_by(indicators, ["Month"], ["Year", "CPI", "Unemp_Rate", "DOW"]),
        "plotting": metrics_to_rows(indicators, ["date"], ["CPI", "Unemp_Rate"]),
    }
