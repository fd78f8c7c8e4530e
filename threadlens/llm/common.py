"""What the operators share: readable tables and workers that can import this package."""

from __future__ import annotations

import gc
import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers find the package where it is installed by path, not by pip."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{folder}/{name}.parquet")


def forget(spark: SparkSession) -> None:
    """Let Spark drop shuffle files that no frame needs any more, once their result is written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def columns_free_of(names: Sequence[str], taken: Sequence[str]) -> dict[str, str]:
    """Each name, with underscores before it while a taken column has it too."""
    lower = {t.lower() for t in taken}
    free = {}
    for name in names:
        new = name
        while new.lower() in lower:
            new = "_" + new
        free[name] = new
        lower.add(new.lower())
    return free
