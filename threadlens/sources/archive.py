"""Posts and comments laid out so that they join without a shuffle.

Both tables are written in as many buckets, by the id of the post and a piece number. A post
with very many comments has several pieces: its comments are dealt among them and
the post is written once per piece, so that it is several tasks' work later on. All other
posts have the one piece 0. Every piece of a post has comments, or the post has none, hence
a left join by id and piece is a left join by id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.sources.tables import read_parquet

PIECE = "_piece"
#: Comments of a post beyond which it is cut; there are at most comments / this many such posts.
PER_PIECE = 1_000_000


@dataclass(frozen=True)
class Archive:
    """Names of the two tables, and the columns that link them."""

    posts: str
    comments: str
    post_id: str
    link: str


def _names(name: str, post_id: str, link: str) -> Archive:
    return Archive(f"{name}_posts", f"{name}_comments", post_id, link)


def _write(df: DataFrame, key: str, table: str, folder: str, buckets: int) -> None:
    # One file per bucket, sorted, so that readers need not sort.
    dealt = df.repartition(buckets, key, PIECE)
    (
        dealt.write.mode("overwrite").format("parquet").option("path", folder)
        .bucketBy(buckets, key, PIECE).sortBy(key, PIECE).saveAsTable(table)
    )


def write_archive(
    posts: DataFrame,
    comments: DataFrame,
    post_id: str,
    link: str,
    folder: str,
    name: str,
    buckets: int | None = None,
    per_piece: int = PER_PIECE,
) -> Archive:
    """Write both tables below ``folder`` and register them as ``<name>_posts`` and ``<name>_comments``.

    ``post_id`` and ``link`` must be of one type. The number of buckets is that of shuffle
    partitions unless given. Comments of unknown posts are kept, they join with nothing.
    """
    spark = posts.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    archive = _names(name, post_id, link)
    sizes = comments.groupBy(link).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > per_piece)
    hot = sizes.select(F.col(link).alias("_hot"), F.ceil(F.col("_n") / per_piece).alias("_pieces"))
    # Few rows (see PER_PIECE). Row numbers deal out even comments that are all alike.
    marked = comments.join(F.broadcast(hot), F.col(link) == F.col("_hot"), "left")
    number = F.when(F.col("_pieces").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.col("_pieces"))).otherwise(0)
    _write(marked.withColumn(PIECE, number.cast("int")).drop("_hot", "_pieces"), link, archive.comments, f"{folder}/comments", buckets)
    # The pieces that were written, not those that were planned.
    cut = spark.table(archive.comments).join(F.broadcast(hot), F.col(link) == F.col("_hot"), "left_semi")
    pieces = cut.groupBy(F.col(link).alias("_hot")).agg(F.collect_set(PIECE).alias("_all"))
    placed = posts.join(F.broadcast(pieces), F.col(post_id) == F.col("_hot"), "left").drop("_hot")
    each = placed.select(*posts.columns, F.explode(F.coalesce("_all", F.array(F.lit(0)))).alias(PIECE))
    _write(each, post_id, archive.posts, f"{folder}/posts", buckets)
    return archive


def open_archive(spark: SparkSession, folder: str, name: str, post_id: str, link: str, buckets: int) -> Archive:
    """Register tables that an earlier session wrote."""
    archive = _names(name, post_id, link)
    for table, part, key in ((archive.posts, "posts", post_id), (archive.comments, "comments", link)):
        fields = read_parquet(spark, f"{folder}/{part}").schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(
            f"create table {table} ({columns}) using parquet clustered by (`{key}`, {PIECE}) "
            f"sorted by (`{key}`, {PIECE}) into {buckets} buckets location '{folder}/{part}'"
        )
    return archive


def archived_posts(spark: SparkSession, archive: Archive) -> DataFrame:
    """The posts, each once."""
    posts = spark.table(archive.posts)
    first = posts.groupBy(archive.post_id).agg(F.min(PIECE).alias("_first"))
    same = (posts[archive.post_id].eqNullSafe(first[archive.post_id])) & (posts[PIECE] == first["_first"])
    return posts.join(first, same, "left_semi").drop(PIECE)


def archived_comments(spark: SparkSession, archive: Archive) -> DataFrame:
    return spark.table(archive.comments).drop(PIECE)


def archived_posts_with_comments(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every post with each of its comments, or with NULLs: one scan of each table, no shuffle."""
    posts, comments = spark.table(archive.posts), spark.table(archive.comments)
    same = (posts[archive.post_id] == comments[archive.link]) & (posts[PIECE] == comments[PIECE])
    # Merged where they lie; a broadcast would read the smaller side into every task.
    return posts.hint("merge").join(comments, same, "left").drop(posts[PIECE]).drop(comments[PIECE])
