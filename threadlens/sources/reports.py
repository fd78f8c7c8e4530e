"""Figures of tables without a scan of their own: from the pass that writes them, or from file footers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.sources.tables import local_table, write_parquet

REPORT = "column_name string, total_rows bigint, nulls bigint, least string, greatest string"
ORDERED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def write_with_report(df: DataFrame, path: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a table (overwriting it) and give (column_name, total_rows, nulls, least, greatest) of it.

    The figures are gathered by the tasks that write, so the input is read once; each task's
    figures count when it succeeds. Columns that have no order (lists, maps, objects, bytes) have
    no least and greatest value, nor have columns without values. One row per column.
    """
    figures = [F.count(F.lit(1)).alias("rows")]
    for k, column in enumerate(df.schema.fields):
        figures.append(F.count_if(F.col(f"`{column.name}`").isNull()).alias(f"nulls_{k}"))
        if isinstance(column.dataType, ORDERED):
            for name, of in (("least", F.min), ("greatest", F.max)):
                figures.append(of(f"`{column.name}`").cast("string").alias(f"{name}_{k}"))
    seen = Observation()
    write_parquet(df.observe(seen, *figures), path, by)
    got = seen.get
    rows = [
        (c.name, got["rows"], got[f"nulls_{k}"], got.get(f"least_{k}"), got.get(f"greatest_{k}"))
        for k, c in enumerate(df.schema.fields)
    ]
    return local_table(df.sparkSession, rows, REPORT)


def footer_totals(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row: ``total_rows``, and ``min_`` and ``max_`` of number columns, from parquet footers alone.

    The frame belongs to a session of its own on the same cluster, in which parquet is read
    by the newer source, the one that answers such aggregates from the footers. Footers hold
    no sure bounds of texts and times, so those columns are refused.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = session.read.parquet(path)
    refused = [c for c in columns if not isinstance(table.schema[c].dataType, (T.NumericType, T.BooleanType, T.DateType))]
    if refused:
        raise ValueError(f"no sure bounds in footers: {refused}")
    bounds = [of(c).alias(f"{name}_{c}") for c in columns for name, of in (("min", F.min), ("max", F.max))]
    return table.agg(F.count(F.lit(1)).alias("total_rows"), *bounds)
