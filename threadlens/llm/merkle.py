"""Hash trees over the rows of a table: one root, and for every row the proof that leads to it.

A group's leaves are numbered in order and cut into aligned blocks of ``BLOCK`` numbers. A
block keeps each of its levels as one string of hex digests put end to end, so that the
inputs of a parent are a substring of fixed width, and the siblings of a node are the two
substrings that flank it in its run. The digests of the blocks are the leaves of the next
round, ``BLOCK`` times fewer, until a group has one node left; the groups' roots go through
the same rounds. Proofs come back down the rounds, a block's part of them worked out once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.sources.tables import drop_stage, stage

#: Nodes under a parent.
RUN = 16
#: Nodes of a block: a parent's parents.
BLOCK = RUN * RUN
#: Characters of a digest.
WIDE = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def tampered(doc_id: Column) -> Column:
    """Whether a row is changed to try the proofs; not where there is no doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(row, source, doc_id, leaf, tried): each row's digest, and that of the row as it is tried."""
    changed = {"text": F.translate(F.col("text").cast("string"), UPPER, LOWER)}
    plain = [F.col(name) for name in FIELDS]
    forged = [changed.get(name, F.col(name)) for name in FIELDS]
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf_digest(plain).alias("leaf"),
        F.when(tampered(F.col("doc_id")), leaf_digest(forged)).alias("tried"),
    )


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add ``pos``, a row's number from 0 within its group by ``order``, and ``total``, the group's size.

    ``order`` must tell rows of a group apart. Rows are dealt by ranges of group and order,
    so a group of any size is many tasks' work; a range's row numbers come from where its
    rows lie in their task, and each group's counts per range say where the range begins.
    """
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    # The number names the task in its upper bits and counts the task's rows in the lower ones.
    placed = stage(dealt.withColumn("_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_place", 33).alias("_part")
    counts = placed.groupBy(F.col(group).alias("_group"), part).agg(
        F.min("_place").alias("_low"), F.count(F.lit(1)).alias("_n")
    )
    # A row per group and range: as many as ranges and groups together.
    of_group = Window.partitionBy("_group")
    before = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_group",
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"),
        F.sum("_n").over(of_group).alias("total"),
    )
    same = placed[group].eqNullSafe(starts["_group"]) & (F.shiftright(placed["_place"], 33) == starts["_part"])
    found = placed.join(starts, same).withColumn("pos", F.col("_place") + F.col("_shift"))
    result = found.select(*rows.columns, "pos", "total")
    result.staged_at = placed.staged_at
    return result


def _parents(level: str) -> str:
    """SQL: the next level's string, one digest per run of a level's string."""
    width = RUN * WIDE
    return (
        f"array_join(transform(sequence(0, (length({level}) - 1) div {width}), "
        f"k -> sha2(substring({level}, k * {width} + 1, {width}), 256)), '')"
    )


def _siblings(level: str, at: str) -> str:
    """SQL: what flanks the node ``at`` in its run of a level's string."""
    run, inner = f"({at} div {RUN}) * {RUN * WIDE}", f"({at} % {RUN})"
    return (
        f"named_struct('left', substring({level}, cast({run} as int) + 1, cast({inner} as int) * {WIDE}), "
        f"'right', substring({level}, cast({at} as int) * {WIDE} + {WIDE + 1}, ({RUN - 1} - cast({inner} as int)) * {WIDE}))"
    )


def blocks(nodes: DataFrame, carried: Sequence[str]) -> DataFrame:
    """(grp, block, total, given, level, above, top, left) of nodes (grp, pos, total, digest and ``carried``).

    ``level`` and ``above`` are the strings of the block's nodes and their parents, ``top``
    is the digest that stands for it, ``left`` how many nodes its group has after the round;
    ``given`` holds what the nodes carry, in their order.
    """
    member = F.struct("pos", "digest", *carried)
    one = (
        nodes.groupBy("grp", "total", F.expr(f"pos div {BLOCK}").alias("block"))
        .agg(F.array_sort(F.collect_list(member)).alias("given"))
        .withColumn("level", F.array_join("given.digest", ""))
        .withColumn("above", F.expr(f"case when total > {RUN} then {_parents('level')} end"))
    )
    top = f"case when total = 1 then level when total <= {RUN} then sha2(level, 256) else sha2(above, 256) end"
    after = f"(total + {BLOCK - 1}) div {BLOCK}"
    return one.select("grp", "block", "total", "given", "level", "above", F.expr(top).alias("top"), F.expr(after).alias("left"))


def _path(at: str) -> str:
    """SQL: the flanks of a block's node at both levels, as far as its group has them."""
    near, far = _siblings("level", at), _siblings("above", f"({at} div {RUN})")
    none = "cast(array() as array<struct<left: string, right: string>>)"
    return f"case when total = 1 then {none} when total <= {RUN} then array({near}) else array({near}, {far}) end"


def members(round_: DataFrame, upper: DataFrame) -> DataFrame:
    """(grp, given, path, root) per node of a round: its flanks up to the root, given those of its block.

    ``upper`` (grp, block, path, root) has every block of the round.
    """
    above = upper.select(F.col("grp").alias("_grp"), F.col("block").alias("_block"), F.col("path").alias("_path"), "root")
    same = round_["grp"].eqNullSafe(above["_grp"]) & (round_["block"] == above["_block"])
    each = round_.join(above, same).select(
        "grp", "total", "level", "above", "_path", "root", F.posexplode("given").alias("_at", "given")
    )
    return each.select("grp", "given", F.concat(F.expr(_path("_at")), "_path").alias("path"), "root")


def climbed(nodes: DataFrame, carried: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks, as written tables, and (grp, digest) of each group's last node."""
    rounds, tops = [], []
    while True:
        now = stage(blocks(nodes, carried), "blocks")
        rounds.append(now)
        tops.append(now.filter("left = 1").select("grp", F.col("top").alias("digest")))
        nodes = now.filter("left > 1").select(
            "grp", F.col("block").alias("pos"), F.col("left").alias("total"), F.col("top").alias("digest")
        )
        if nodes.isEmpty():
            return rounds, reduce(DataFrame.unionAll, tops)
        carried = ()


def descended(rounds: list[DataFrame], ends: DataFrame) -> DataFrame:
    """(grp, given, path, root) per node of the first round; ``ends`` (grp, path, root) per group."""
    upper = None
    ends = ends.withColumnRenamed("grp", "_grp")
    for k in reversed(range(len(rounds))):
        last = rounds[k].filter("left = 1").select("grp", "block")
        same = last["grp"].eqNullSafe(ends["_grp"])
        done = last.join(ends, same).select("grp", "block", "path", "root")
        upper = done if upper is None else done.unionByName(upper)
        found = members(rounds[k], upper)
        upper = found.select("grp", F.col("given.pos").alias("block"), "path", "root")
    return found


def folded(start: Column, path: Column) -> Column:
    """The digest that a leaf and its flanks lead to."""
    return F.aggregate(path, start, lambda node, at: F.sha2(F.concat(at["left"], node, at["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, path, tried) per row of ``docs``.

    A leaf is the digest of ``FIELDS``; a source's leaves, in ascending doc_id, lead to its
    subroot, and the subroots, in order of the source, to the root. ``path`` holds the
    digests to the left and right of each node from the leaf to the root; ``tried`` is the
    digest of the row with the capitals A-Z of its text in small letters where its doc_id
    asks for that (``tampered``), else null.

    Nulls: any field may be null, a null differs from an empty text; a null doc_id sorts
    first and is never tampered with; rows without a source are a source of their own, the
    first. Rows that repeat a doc_id of their source follow each other by their digest; equal rows
    are separate leaves. Other columns are not looked at. An empty table gives an empty result.
    """
    # Only digests and ids go further, so texts are read once and never shuffled.
    first = stage(leaves(docs), "leaves")
    placed = numbered(first, "source", ["doc_id", "leaf", "row"])
    nodes = placed.select(F.col("source").alias("grp"), "pos", "total", F.col("leaf").alias("digest"), "doc_id", "tried")
    rounds, subroots = climbed(nodes, ["doc_id", "tried"])
    drop_stage(first)
    drop_stage(placed)

    known = stage(subroots.select(F.lit(0).alias("all"), F.col("grp").alias("source"), "digest"), "subroots")
    placed = numbered(known, "all", ["source"])
    tops = placed.select(F.col("all").alias("grp"), "pos", "total", "digest", "source")
    upper_rounds, root = climbed(tops, ["source"])
    drop_stage(known)
    drop_stage(placed)

    none = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    found = descended(upper_rounds, root.select("grp", none.alias("path"), F.struct(F.col("digest").alias("root")).alias("root")))
    of_source = found.select(
        F.col("given.source").alias("grp"), "path",
        F.struct(F.col("given.digest").alias("subroot"), "root.root").alias("root"),
    )
    each = descended(rounds, of_source)
    return each.select(
        "given.doc_id", F.col("grp").alias("source"), F.col("given.digest").alias("leaf"),
        "root.subroot", "root.root", "path", "given.tried",
    )


def proofs(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``."""
    found = manifest(docs)
    joined = F.array_join(F.transform("path", lambda at: F.concat(at["left"], at["right"])), "")
    found = found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(joined, 256).alias("proof_sha256"),
        folded(F.coalesce("tried", "leaf"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
