"""Files of raw bytes, written and read through Spark so that any store Spark reaches will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.session import new_path


def write_blobs(blobs: DataFrame, column: str, tail: bytes, label: str) -> str:
    """Each row of a binary column becomes one file, followed by the bytes ``tail``; gives the folder.

    Spark has no writer of raw bytes, but its text writer puts a row's bytes as they are
    and then a line separator. Formats that end every file with the same bytes (a magic
    number, an empty gzip member) name those as the separator and leave them off the row.
    """
    folder = new_path(blobs.sparkSession, label)
    (
        blobs.select(F.col(column).cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", tail.decode("latin-1"))
        .option("maxRecordsPerFile", 1)
        .text(folder)
    )
    return folder


def read_blobs(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content, part, chunk): whole files; part and chunk sort files as they were written."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)

    def number(pattern: str) -> Column:
        return F.regexp_extract("path", pattern, 1).cast("bigint")

    return files.select(
        "path", "content", number(r"/part-(\d+)-").alias("part"), number(r"\.?-?c(\d+)\.[a-z.]+$").alias("chunk")
    )
