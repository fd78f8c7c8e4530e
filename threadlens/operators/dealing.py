"""Rows dealt out before work that costs far more than reading them."""

from __future__ import annotations

from pyspark.sql import DataFrame


def bytes_of(df: DataFrame) -> int:
    """The size Spark expects a frame to have, from the files it reads."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def dealt_out(df: DataFrame) -> DataFrame:
    """The rows, dealt to all cores if the input is less than one full reading task per core.

    Such an input may lie in a few row groups, which few tasks read, and costs next to
    nothing to shuffle. A larger one has a task for every core as it is, and stays.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    task = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df if bytes_of(df) >= cores * task else df.repartition(cores)


#: Bytes of files whose texts one task counts words of: ten to twenty times that in its tables.
PART_BYTES = 4 << 20


def parts_of(df: DataFrame) -> int:
    """A number of parts that grows with the input, where a task's tables grow with its texts.

    A number that is named is not lessened by adaptive execution, which knows the size of
    texts and not that of the words in them.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = bytes_of(df)
    # Spark takes rows of unknown size for the largest there can be.
    return least if size >= 1 << 60 else max(least, -(-size // PART_BYTES))
