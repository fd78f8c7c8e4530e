"""Filters, projections and quality checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import strip_thread_prefix
from threadlens.operators.ranks import global_quantile


def keep_communities(df: DataFrame, communities: Iterable[str], column: str = "subreddit") -> DataFrame:
    """Rows of any listed community, in one scan; the filter reaches the parquet reader."""
    return df.filter(F.col(column).isin(list(communities)))


def drop_sentinels(df: DataFrame, column: str, sentinels: Iterable[str]) -> DataFrame:
    """Without rows whose text is a removal mark or NULL."""
    return df.filter(~F.col(column).isin(list(sentinels)))


def top_level_only(df: DataFrame, link: str = "link_id", parent: str = "parent_id") -> DataFrame:
    """Comments that answer the post itself."""
    return df.filter(F.col(link) == F.col(parent))


def unprefix_links(df: DataFrame, column: str = "link_id", anywhere: bool = False) -> DataFrame:
    return df.withColumn(column, strip_thread_prefix(F.col(column), anywhere))


def prefix_columns(df: DataFrame, prefix: str = "com_") -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def within_limits(df: DataFrame, below: Mapping[str, float]) -> DataFrame:
    """Rows strictly below every given limit."""
    for name, limit in below.items():
        df = df.filter(F.col(name) < limit)
    return df


def trim_above_quantile(df: DataFrame, column: str, p: float = 0.99) -> DataFrame:
    """Rows strictly below the exact quantile of the whole column."""
    return df.filter(F.col(column) < global_quantile(df, column, p))


def strip_thousands(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Remove thousands commas from string columns."""
    strings = [name for name, kind in df.dtypes if kind == "string"]
    chosen = [c for c in strings if columns is None or c in columns]
    return df.withColumns({c: F.regexp_replace(c, ",", "") for c in chosen})


def null_report(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for every column, from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "nulls")


def profile(df: DataFrame) -> DataFrame:
    """(column_name, column_type, total_rows, total_columns): shape and schema as a table."""
    described = F.array(
        *[F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("column_type")) for n, t in df.dtypes]
    )
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        F.inline(described), "total_rows", F.lit(len(df.columns)).cast("bigint").alias("total_columns")
    )


def partition_sizes(df: DataFrame) -> DataFrame:
    """(partition, row_count) of the frame as it would be read now."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
