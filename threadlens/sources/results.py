"""Result tables that a job may write again: whole tables or partitions, and a manifest."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadlens.sources.tables import read_parquet

MANIFEST = "name string, total_rows bigint, parts string, columns string"


def _manifest(folder: str) -> str:
    return f"{folder}/manifest"


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def save_results(tables: Mapping[str, DataFrame], folder: str, by: Mapping[str, Sequence[str]] | None = None) -> None:
    """Each table as parquet below a folder, then a manifest of all of them.

    A table named in ``by`` is laid out by those columns, and only the partitions that occur
    in the new rows are replaced; any other is replaced whole. A rerun leaves the same tables.
    The manifest holds the rows written (counted by the tasks that write) and the columns; it
    is taken away first and written last, so a folder without one is not complete. Tables of
    earlier runs that are not named now stay on disk and leave the manifest.
    """
    if not tables:
        raise ValueError("no tables to write")
    spark = next(iter(tables.values())).sparkSession
    by = by or {}
    _delete(spark, _manifest(folder))
    rows = []
    for name, table in tables.items():
        seen, parts = Observation(), list(by.get(name, ()))
        writer = table.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        if parts:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
        writer.parquet(f"{folder}/{name}")
        rows.append((name, seen.get["rows"], ",".join(parts), table.schema.json()))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").json(_manifest(folder))


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(name, total_rows, parts, columns) per table; an error where a job did not finish."""
    return spark.read.schema(MANIFEST).json(_manifest(folder))


def read_results(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the manifest, with the columns it states in their order."""
    found = {}
    for row in read_manifest(spark, folder).collect():
        names = [field["name"] for field in json.loads(row["columns"])["fields"]]
        found[row["name"]] = read_parquet(spark, f"{folder}/{row['name']}").select(*[f"`{n}`" for n in names])
    return found
