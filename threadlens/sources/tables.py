"""Parquet, CSV, TSV and JSON tables with explicit schemas."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.schemas import COMMENTS, SUBMISSIONS, TRUTH_LABELS
from threadlens.session import new_path


def read_parquet(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, COMMENTS)


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, SUBMISSIONS)


def write_parquet(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Overwrite; ``by`` lays the files out so that later filters skip folders."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


_opened: ContextVar[list[DataFrame] | None] = ContextVar("opened", default=None)


@contextmanager
def staging() -> Iterator[None]:
    """Frames staged inside are dropped at the end, also where the work fails; what is to
    stay has to be written before."""
    made: list[DataFrame] = []
    outer = _opened.set(made)
    try:
        yield
    finally:
        _opened.reset(outer)
        for staged in made:
            drop_stage(staged)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several jobs will read to the shared folder, and read it back.

    Later jobs neither repeat the work nor depend on an executor's memory.
    """
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    staged = read_parquet(df.sparkSession, path, df.schema)
    staged.staged_at = path
    made = _opened.get()
    if made is not None:
        made.append(staged)
    return staged


def drop_stage(staged: DataFrame) -> None:
    """Delete the files behind a frame of ``stage`` that nothing will read again."""
    drop_path(staged.sparkSession, staged.staged_at)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared one that nothing will read again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def forget(spark: SparkSession) -> None:
    """Let Spark drop shuffle files that no frame needs any more."""
    gc.collect()
    spark._jvm.System.gc()


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    header: bool = False,
    multiline: bool = False,
    sep: str = ",",
) -> DataFrame:
    """CSV by position into a given schema; quotes inside quotes are doubled.

    ``multiline`` is needed where texts of others' files hold line ends, and makes files
    unsplittable.
    """
    return spark.read.csv(
        path, schema=schema, header=header, sep=sep, escape='"', multiLine=multiline
    )


# What stands for characters that would end a row, and for NULL.
ESCAPES = {"\\": "\\s", "\n": "\\n", "\r": "\\r"}
NULL_MARK = "\\N"


def _replaced(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    columns = {}
    for name in texts:
        column = F.col(name)
        for old, new in pairs:
            column = F.replace(column, F.lit(old), F.lit(new))
        columns[name] = column
    return df.withColumns(columns)


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """CSV with a row per line: line ends inside texts are escaped, NULL differs from empty."""
    escaped = _replaced(df, list(ESCAPES.items()))
    escaped.write.mode("overwrite").csv(
        path,
        header=header,
        escape='"',
        nullValue=NULL_MARK,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def read_back_csv(spark: SparkSession, path: str, schema: str, header: bool = False) -> DataFrame:
    """What ``write_csv`` wrote. Files stay splittable; a malformed row is an error."""
    rows = spark.read.csv(
        path, schema=schema, header=header, escape='"', nullValue=NULL_MARK, mode="FAILFAST"
    )
    return _replaced(rows, [(new, old) for old, new in reversed(ESCAPES.items())])


def write_summary_csv(summary: DataFrame, path: str) -> None:
    """One file with a header, for summary tables of a few rows only."""
    summary.coalesce(1).write.mode("overwrite").csv(path, header=True, escape='"')


def read_summary_csv(
    spark: SparkSession, path: str, schema: str, saved_index: str | None = None
) -> DataFrame:
    """A CSV with a header; the saved row-number column is dropped if there is one."""
    df = spark.read.csv(path, schema=schema, header=True, escape='"')
    return df.drop(saved_index) if saved_index else df


def read_truth_labels(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Tab-separated truth labels; ``paths`` maps a set name to its file.

    Fields 1, 2, 3, 4 and 7 (from 0) are label, text, subject, speaker and party; quotes
    are plain characters.
    """
    fields = dict(zip([1, 2, 3, 4, 7], TRUTH_LABELS))
    eight = ", ".join(f"{fields.get(i, f'_c{i}')} string" for i in range(8))
    frames = None
    for name, path in paths.items():
        part = spark.read.csv(path, schema=eight, sep="\t", quote="").select(
            *TRUTH_LABELS, F.lit(name).alias("split")
        )
        frames = part if frames is None else frames.unionByName(part)
    return frames


def write_word_counts_json(counts: DataFrame, path: str) -> None:
    """One JSON object per word and count; never the whole vocabulary in one object."""
    counts.write.mode("overwrite").json(path)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small dimension written out in code."""
    return spark.createDataFrame(list(rows), schema)
