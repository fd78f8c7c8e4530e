"""Counts, grouped descriptions, ratios, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.bins import equal_width_bin
from threadlens.operators.ranks import attach, exact_quantiles

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name or value))


def top_groups(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The n most frequent values; equal counts in order of the value."""
    return count_by(df, key).orderBy(F.desc("count"), F.asc(key)).limit(n)


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Frequency of every value, most frequent first."""
    return count_by(df.filter(F.col(key).isNotNull()), key).orderBy(F.desc("count"), F.asc(key))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, min_value, max_value) from one pass."""
    found = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"min_{c}").alias("min_value"),
            F.col(f"max_{c}").alias("max_value"),
        )
        for c in columns
    ]
    return found.select(F.inline(F.array(*rows)))


def describe_by(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], drop_null_keys: bool = True
) -> DataFrame:
    """Count, mean, std, min, quartiles and max of every measure per group, in long form.

    Columns: keys, measure, count, mean, std, min, q25, q50, q75, max. Rows with a NULL
    key are left out unless asked for.
    """
    keys = list(keys)
    measures = [m for m in measures if m not in keys]
    if drop_null_keys:
        df = df.na.drop(subset=keys)
    # NaN is no measurement; it would pass into every statistic.
    df = df.withColumns({m: F.when(~F.isnan(F.col(m).cast("double")), F.col(m)) for m in measures})
    moments = df.groupBy(*keys).agg(
        *[
            F.struct(
                F.lit(m).alias("measure"),
                F.count(m).alias("count"),
                F.avg(m).alias("mean"),
                F.stddev_samp(m).alias("std"),
                F.min(F.col(m).cast("double")).alias("min"),
                F.max(F.col(m).cast("double")).alias("max"),
            ).alias(f"_{m}")
            for m in measures
        ]
    )
    moments = moments.select(*keys, F.inline(F.array(*[f"_{m}" for m in measures])))
    long = df.select(*keys, *[F.col(m).cast("double").alias(m) for m in measures]).unpivot(
        keys, list(measures), "measure", "value"
    )
    quartiles = exact_quantiles(long, [*keys, "measure"], "value", QUARTILES)
    return attach(moments, quartiles, [*keys, "measure"]).select(
        *keys, "measure", "count", "mean", "std", "min", *QUARTILES, "max"
    )


def describe_wide(long: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per group with ``<measure>_<statistic>`` columns."""
    statistics = ["count", "mean", "std", "min", *QUARTILES, "max"]
    return long.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("measure") == m, F.col(s))).alias(f"{m}_{s}")
            for m in measures
            for s in statistics
        ]
    )


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is NULL, not an error, over zero."""
    return top / F.nullif(bottom, F.lit(0))


def sums_per_post(
    posts: DataFrame,
    keys: Sequence[str],
    value: str,
    kept: Column,
    name: str = "comments_post_ratio",
) -> DataFrame:
    """Posts and summed value per group, and their ratio.

    The sum runs over the kept (trimmed) rows and the count over all rows, as in the
    study, both in one aggregation.
    """
    grouped = posts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("counts"), F.sum(F.when(kept, F.col(value))).alias(value)
    )
    return grouped.withColumn(name, ratio(F.col(value), F.col("counts")))


def pivot_counts(df: DataFrame, key: str, pivot: str, values: Sequence, name_absent: float | None = None) -> DataFrame:
    """Counts per key with one column per listed value; NULL where there is no row."""
    table = count_by(df, key, pivot).groupBy(key).pivot(pivot, list(values)).agg(F.sum("count"))
    return table if name_absent is None else table.na.fill(name_absent)


def histogram(df: DataFrame, value: str, bins: int = 11) -> DataFrame:
    """(bin, bin_start, frequency) over equal widths; empty bins are listed with 0."""
    edges = df.agg(
        F.min(F.col(value).cast("double")).alias("low"), F.max(F.col(value).cast("double")).alias("high")
    )
    with_edges = attach(df.filter(F.col(value).isNotNull()).select(value), edges, [])
    number = equal_width_bin(F.col(value).cast("double"), F.col("low"), F.col("high"), bins)
    counted = with_edges.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("frequency"))
    every = edges.filter(F.col("low").isNotNull()).select(
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins))).alias("bin"), "low", "high"
    )
    width = (F.col("high") - F.col("low")) / bins
    return every.join(counted, "bin", "left").select(
        "bin",
        (F.col("low") + (F.col("bin") - 1) * width).alias("bin_start"),
        F.coalesce("frequency", F.lit(0)).alias("frequency"),
    )


def normalise(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Min-max scaled copies of columns, ``{column: new name}``; a constant column is NULL."""
    edges = df.agg(
        *[f(c).alias(f"_{f.__name__}_{c}") for c in names for f in (F.min, F.max)]
    )
    scaled = {
        new: ratio(F.col(c) - F.col(f"_min_{c}"), F.col(f"_max_{c}") - F.col(f"_min_{c}"))
        for c, new in names.items()
    }
    return attach(df, edges, []).withColumns(scaled).drop(*edges.columns)
