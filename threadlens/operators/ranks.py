"""Running totals and exact quantiles that never sort a whole group in one task.

A group may hold a third of all rows, so nothing here uses a window over a group's
rows. Values are first counted, which folds repeats together on the map side. Then
the values are cut into ranges at a hash-chosen sample of them; totals per group and
range are few, and only the values of one range meet in one task. The cut points depend
on the data alone, so a recomputed task sees the same ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attach(rows: DataFrame, per_group: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Put the columns of a frame with one row per key next to the rows of that key.

    Without keys the frame has one row, which is read as a scalar subquery. With keys it
    is an equi-join that matches NULL to NULL; no broadcast is forced, the size that
    Spark measures at run time decides.
    """
    added = [c for c in per_group.columns if c not in keys]
    if not keys:
        packed = per_group.select(F.struct(*added)).scalar()
        return rows.withColumn("_packed", packed).select("*", "_packed.*").drop("_packed")
    side = per_group.select(*[F.col(k).alias(f"_on_{k}") for k in keys], *added)
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(side[f"_on_{k}"]) for k in keys])
    return rows.join(side, same, how).drop(*[f"_on_{k}" for k in keys])


#: Cut points are found by halving; so many bits are enough for 10^14 values.
BITS = 24


def _place(rows: DataFrame, value: str) -> DataFrame:
    """Add ``_range``, the number of cut points that are not above the value, by halving."""
    steps = [1 << bit for bit in reversed(range(BITS))]

    def halve(passed: Column, step: Column) -> Column:
        beyond = F.get("_cuts", passed + step - 1) <= F.col(value)
        return passed + F.when(beyond, step).otherwise(0)

    return rows.withColumn("_range", F.aggregate(F.lit(steps), F.lit(0), halve))


def _cuts(rows: DataFrame, keys: Sequence[str], order: str, per_range: int | None = None) -> Column:
    """The values of a share of the rows chosen by hash, which does not change between runs."""
    if per_range is None:
        share = rows.agg(F.greatest(F.lit(1), F.ceil(F.sqrt(F.count(F.lit(1))) / 4))).scalar()
    else:
        share = F.lit(per_range)
    sample = rows.filter(F.pmod(F.xxhash64(order, *keys), share.cast("bigint")) == 0)
    return sample.agg(F.array_sort(F.collect_set(order))).scalar()


def running_totals(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    per_range: int | None = None,
) -> DataFrame:
    """Add ``before_<s>`` (sum over smaller ``order``) and ``total_<s>`` per group.

    ``rows`` holds each ``order`` value once per group, i.e. it is already aggregated.
    One range holds about ``per_range`` rows of all groups together; if it is not given,
    a quarter of the square root of their number, so that neither a range nor the list of cuts grows
    with the table.
    """
    keys, sums = list(keys), list(sums)
    rows = rows.select(*keys, order, *sums)
    placed = _place(rows.withColumn("_cuts", _cuts(rows, keys, order, per_range)), order).drop("_cuts")
    # At most one row per group and cut, whatever the group's size.
    per_range = placed.groupBy(*keys, "_range").agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(f"_sum_{s}").over(earlier), F.lit(0)).alias(f"_offset_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(group).alias(f"total_{s}") for s in sums],
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        attach(placed, offsets, [*keys, "_range"], "inner")
        .withColumns(
            {
                f"before_{s}": F.col(f"_offset_{s}") + F.coalesce(F.sum(s).over(inside), F.lit(0))
                for s in sums
            }
        )
        .select(*keys, order, *sums, *[f"{w}_{s}" for s in sums for w in ("before", "total")])
    )


def value_weights(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values of each group with their number of rows, ``n``; NULL and NaN are left out."""
    return (
        df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 0")
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    points: Mapping[str, float],
    per_range: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of ``points``."""
    ranked = running_totals(value_weights(df, keys, value), keys, value, ["n"], per_range)
    first, last = F.col("before_n"), F.col("before_n") + F.col("n")

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < last), F.col(value).cast("double")))

    picked, results = [], []
    for name, p in points.items():
        position = F.lit(float(p)) * (F.col("total_n") - 1)
        picked += [
            at(F.floor(position)).alias(f"_low_{name}"),
            at(F.ceil(position)).alias(f"_high_{name}"),
            F.max(position - F.floor(position)).alias(f"_part_{name}"),
        ]
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        results.append((low + (high - low) * F.col(f"_part_{name}")).alias(name))
    return ranked.groupBy(*keys).agg(*picked).select(*keys, *results)


def global_quantile(df: DataFrame, value: str, p: float) -> Column:
    """One exact quantile of the whole table as a scalar subquery."""
    return exact_quantiles(df, [], value, {"q": p}).scalar()
