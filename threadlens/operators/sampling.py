"""Samples that come out the same on every run.

Rows are ordered by a hash of a stable id, never by a random number, so a task that is
run again picks the same rows. To find the n-th smallest hash of a group, hashes are
counted by a short prefix; only rows that share the prefix of the n-th one are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions.bins import hash_number
from threadlens.operators.ranks import attach


def hash_key(ident: str, seed: str = "") -> Column:
    text = F.col(ident).cast("string")
    return F.md5(F.concat(F.lit(seed), text) if seed else text)


def with_content_key(df: DataFrame, columns: Sequence[str], name: str = "id") -> DataFrame:
    """A key made from a row's own content; identical rows get the same key."""
    # A present value is marked, so that NULL and the empty string differ.
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns]
    return df.withColumn(name, F.md5(F.concat_ws("\u0001", *parts)))


def _per_group(df: DataFrame, known_groups: Sequence | None) -> DataFrame:
    """Broadcast a one-row-per-group frame only when the list of groups is given."""
    return F.broadcast(df) if known_groups is not None else df


def prefix_digits(n: int) -> int:
    """Hash digits after the leading zeros that leave about sqrt(n) ids per prefix."""
    return max(2, math.ceil(math.log(max(n, 1), 16) / 2))


def sample_per_group(
    df: DataFrame,
    group: str,
    ident: str,
    n: int | Column,
    seed: str = "",
    groups: Sequence | None = None,
    digits: int | None = None,
) -> DataFrame:
    """The n rows of each group with the smallest hash; all rows of smaller groups.

    ``ident`` tells rows apart; rows that share it are kept or left out together.
    ``groups`` names the groups to keep, which bounds the per-group tables. No rows are
    taken for n = 0; a negative n is refused. ``digits`` is how many hash digits after the
    leading zeros tell prefixes apart; it grows with n, so that the ids that have to be
    sorted and the prefixes that are counted both stay near the square root of n.
    """
    if isinstance(n, int) and n < 0:
        raise ValueError("a sample cannot have fewer than no rows")
    if digits is None:
        digits = prefix_digits(n) if isinstance(n, int) else 4
    if groups is not None:
        df = df.filter(F.col(group).isin(list(groups)))
    # Prefixes sort like the hashes they start: "0a3" < "1f".
    prefix = F.regexp_extract("_hash", "^0*[1-9a-f]?.{0,%d}" % (digits - 1), 0)
    hashed = (
        df.select(group, ident)
        .withColumn("_hash", hash_key(ident, seed))
        .withColumn("_prefix", prefix)
    )
    wanted = n if isinstance(n, Column) else F.lit(n)
    per_prefix = hashed.groupBy(group, "_prefix").agg(F.count(F.lit(1)).alias("_rows"))
    up_to = Window.partitionBy(group).orderBy("_prefix").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    edge = (
        per_prefix.withColumn("_until", F.sum("_rows").over(up_to))
        .withColumn("_need", wanted - (F.col("_until") - F.col("_rows")))
        .filter((F.col("_need") > 0) & (F.col("_until") >= wanted))
        .select(group, "_prefix", "_need")
    )
    edge_rows = attach(hashed, _per_group(edge, groups), [group, "_prefix"], "inner")
    # Rows that share an id are counted first, so a repeated id is one row to sort.
    edge_ids = edge_rows.groupBy(group, "_need", "_hash", ident).agg(F.count(F.lit(1)).alias("_rows"))
    in_edge = Window.partitionBy(group).orderBy("_hash", ident)
    until = F.sum("_rows").over(in_edge.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cutoffs = (
        edge_ids.withColumn("_until", until)
        .filter((F.col("_until") >= F.col("_need")) & (F.col("_until") - F.col("_rows") < F.col("_need")))
        .select(group, F.struct(F.col("_hash").alias("h"), F.col(ident).alias("i")).alias("_last"))
    )
    mine = F.struct(hash_key(ident, seed).alias("h"), F.col(ident).alias("i"))
    return (
        attach(df, _per_group(cutoffs, groups), [group])
        .filter((wanted > 0) & (F.col("_last").isNull() | (mine <= F.col("_last"))))
        .drop("_last")
    )


def balance_classes(
    df: DataFrame,
    label: str,
    ident: str,
    seed: str = "",
    groups: Sequence | None = None,
) -> DataFrame:
    """Every class cut to the size of the smallest one."""
    if groups is not None:
        df = df.filter(F.col(label).isin(list(groups)))
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    smallest = sizes.agg(F.min("_size")).first()[0]
    return sample_per_group(df, label, ident, smallest or 0, seed, groups)


def limit_some_groups(
    df: DataFrame, group: str, ident: str, limits: dict[str, int], seed: str = ""
) -> DataFrame:
    """Listed groups cut to their own size, the other groups kept whole."""
    if min(limits.values(), default=0) < 0:
        raise ValueError("a sample cannot have fewer than no rows")
    wanted = F.coalesce(*[F.when(F.col(group) == g, F.lit(n)) for g, n in limits.items()])
    digits = prefix_digits(max(limits.values(), default=0))
    cut = sample_per_group(df, group, ident, wanted, seed, list(limits), digits)
    rest = df.filter(~F.col(group).isin(list(limits)) | F.col(group).isNull())
    return cut.unionByName(rest)


def hash_split(
    df: DataFrame, ident: str, train_percent: int = 80, seed: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the id."""
    train = F.pmod(hash_number(F.col(ident), seed), F.lit(100)) < train_percent
    return df.filter(train), df.filter(~train)


def random_split(df: DataFrame, train: float = 0.8, seed: int = 24) -> tuple[DataFrame, DataFrame]:
    """Spark's own seeded split; the same only for the same partitioning of the input."""
    first, second = df.randomSplit([train, 1 - train], seed)
    return first, second


def fraction_sample(df: DataFrame, fraction: float = 0.01, seed: int = 123) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_fraction(df: DataFrame, ident: str, fraction: float, seed: str = "") -> DataFrame:
    """The rows whose id falls into the first ``fraction`` of the hash range; the same on every run."""
    share = F.lit(round(fraction * (1 << 32)))
    return df.filter(hash_number(F.col(ident), seed) < share)
