"""Binning columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Engagement ranges; the last one has no upper edge.
ENGAGEMENT_EDGES = [-1, 5, 10, 20, 50, 100, None]
ENGAGEMENT_LABELS = ["<5", "5-10", "10-20", "20-50", "50-100", "100+"]


def right_closed(
    value: Column,
    edges: Sequence[float | None],
    labels: Sequence[str],
    include_lowest: bool = False,
) -> Column:
    """Label of the interval ``(edge[i], edge[i+1]]`` holding the value, else NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    inside = (value >= edges[0]) if include_lowest else (value > edges[0])
    chain = F.when(~inside, F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        chain = chain.when(F.lit(True) if upper is None else value <= upper, F.lit(label))
    return F.when(value.isNotNull(), chain)


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1..bins over [low, high]; the last bin is closed, so the maximum stays in it."""
    inner = F.least(F.width_bucket(value, low, high, F.lit(bins)), F.lit(bins))
    return F.when(low == high, F.lit(1)).otherwise(inner).cast("bigint")


def hash_number(ident: Column, seed: str = "") -> Column:
    """32 uniform bits that depend on the id alone, the same on every run."""
    text = F.concat(F.lit(seed), ident.cast("string")) if seed else ident.cast("string")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
