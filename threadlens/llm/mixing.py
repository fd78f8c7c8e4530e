"""Sources mixed to target weights by temperature.

Each source's share of the tokens is raised to an exponent; the exponent is bisected until
the shares so raised, normalised, meet an entropy or repeat no source too often. Sources
then get token budgets by weight. A budget is spent on whole passes over the source's
blocks, each in an order of its own, and on the first blocks of one more pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions.text import word_count
from threadlens.llm.common import columns_free_of, importable
from threadlens.sources.tables import stage

#: Blocks that each source is cut into; a budget is met to about half a block.
BLOCKS = 256
#: Exponents tried together in one pass over the sources.
TRIED = 64


def source_key(source: Column) -> Column:
    """Tells a null source from one named like anything else."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s:"), source.cast("string")))


def block_of(doc_id: Column) -> Column:
    """Documents of a source fall into blocks by a hash of their id."""
    number = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8), 16, 10)
    return (number.cast("bigint") % BLOCKS).cast("bigint")


def _spread(totals: DataFrame, exponent: Column) -> DataFrame:
    """Per exponent: the entropy of the weights, and how often the most repeated source would
    be passed over if the least repeated one is passed over once."""
    raised = F.pow("share", exponent)
    tried = totals.withColumn("exponent", exponent).groupBy("exponent").agg(
        F.sum(raised).alias("z"),
        F.sum(raised * F.log("share") * exponent).alias("l"),
        F.max(raised / F.col("share")).alias("most"),
        F.min(raised / F.col("share")).alias("least"),
    )
    return tried.select(
        "exponent", (F.log("z") - F.col("l") / F.col("z")).alias("entropy"), (F.col("most") / F.col("least")).alias("repeats")
    )


def exponent_for(totals: DataFrame, entropy: float | None = None, repeats: float | None = None) -> float:
    """The smallest exponent in [0, 1] that meets every limit given; 1 if there are no sources.

    A smaller exponent evens the sources out: entropy falls with the exponent, from equal
    weights at 0, and so do repeats. ``entropy`` is the least to be kept in nats, taken as
    that of equal weights if it is more; with ``repeats`` no source is passed over more often.
    Of both limits, ``repeats`` goes first. ``totals`` (share) has a row per source; each
    pass over it narrows the exponent by ``TRIED`` at once.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("give an entropy or a limit of repeats")
    low, high = 0.0, 1.0
    while high - low > 1e-12:
        step = (high - low) / TRIED
        tried = F.explode(F.array(*[F.lit(low + step * k) for k in range(TRIED + 1)]))
        rows = _spread(totals.withColumn("e", tried), F.col("e")).orderBy("exponent").collect()  # TRIED + 1 rows
        if not rows:
            return 1.0
        if repeats is not None:
            # Repeats fall as the exponent grows: the first that is low enough.
            k = next((k for k, r in enumerate(rows) if r.repeats <= repeats * (1 + 1e-12)), TRIED)
            if k == 0:
                return rows[0].exponent
            low, high = rows[k - 1].exponent, rows[k].exponent
        else:
            # Entropy falls as the exponent grows: the last that is high enough.
            k = max((k for k, r in enumerate(rows) if r.entropy > entropy), default=0)
            if rows[k].entropy <= entropy:
                return rows[k].exponent
            if k == TRIED:
                return rows[TRIED].exponent
            low, high = rows[k].exponent, rows[k + 1].exponent
    return high if repeats is not None else low


def block_plan(sized: DataFrame, entropy: float | None = None, repeats: float | None = None) -> DataFrame:
    """(key, block, pass, place, budget): the blocks of each source in each pass, within its budget.

    ``sized`` (key, block, tokens) are documents. The budgets are weights times a total that
    lets the source with the least repeats be passed over exactly once, so no document is
    lost. A window holds the ``BLOCKS`` blocks of one source and pass, whatever its size.
    """
    blocks = stage(sized.groupBy("key", "block").agg(F.sum("tokens").alias("tokens")), "blocks")
    totals = blocks.groupBy("key").agg(F.sum("tokens").alias("total")).filter("total > 0")
    every = totals.agg(F.sum("total")).first()[0] or 1
    shares = stage(totals.withColumn("share", F.col("total") / F.lit(float(every))), "shares")
    exponent = exponent_for(shares, entropy, repeats)
    ratio = F.pow("share", F.lit(exponent - 1.0))
    least = shares.agg(F.min(ratio)).first()[0] or 1.0
    budgets = shares.select(
        "key",
        "total",
        F.pow("share", F.lit(exponent)).alias("raised"),
        F.round(F.col("total") * ratio / F.lit(least)).cast("bigint").alias("budget"),
    )
    passes = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("budget") - 1) / F.col("total")))
    dealt = blocks.join(budgets, "key", "left").withColumn(
        "pass", F.explode(F.when(F.col("total").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(passes))
    )
    order = F.md5(F.concat_ws(":", "key", F.col("block").cast("string"), F.col("pass").cast("string")))
    window = Window.partitionBy("key", "pass").orderBy("order", "block")
    ranked = dealt.withColumn("order", order).select(
        "*",
        (F.row_number().over(window) - 1).cast("bigint").alias("place"),
        F.sum("tokens").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("until"),
    )
    # The last pass ends with the block that brings it nearest to what is left of the budget.
    left = F.col("budget") - F.col("total") * F.col("pass")
    return ranked.filter(
        F.col("total").isNull() | (left >= F.col("total")) | (2 * F.col("until") - F.col("tokens") <= 2 * left)
    ).select("key", "block", "pass", "place", "budget")


def mixed(docs: DataFrame, entropy: float | None = None, repeats: float | None = None) -> DataFrame:
    """The documents, as often as the mix takes them, with all their columns and ``mix_pass``,
    ``mix_place``, ``mix_budget`` (with underscores before them while a column has the name).

    Tokens are words between blanks. A null source is a source of its own. Sources without
    any token (null or empty texts only) are taken once. Rows that repeat a doc_id, and
    those without one, share a block. ``mix_pass`` counts passes over the source, ``mix_place``
    the block's place in the pass, ``mix_budget`` is the source's tokens to be spent.
    """
    importable(docs.sparkSession)
    own = columns_free_of(["mix_key", "mix_block", "mix_pass", "mix_place", "mix_budget"], docs.columns)
    key, block = source_key(F.col("source")), block_of(F.col("doc_id"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select(key.alias("key"), block.alias("block"), word_count(text).cast("bigint").alias("tokens"))
    plan = stage(block_plan(sized, entropy, repeats), "mix").toDF(*own.values())
    keyed = docs.withColumns({own["mix_key"]: key, own["mix_block"]: block})
    return keyed.join(plan, [own["mix_key"], own["mix_block"]]).drop(own["mix_key"], own["mix_block"]).select(
        *docs.columns, own["mix_pass"], own["mix_place"], own["mix_budget"]
    )


def remixed(docs: DataFrame, entropy: float | None = None, repeats: float | None = None) -> DataFrame:
    """The documents as often as the mix takes them, with their own columns only."""
    return mixed(docs, entropy, repeats).select(*docs.columns)
