"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

_local_folder: str | None = None


def build_session(app: str = "threadlens", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the library's settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    A temporary folder is only made in local mode, where there is one machine.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="threadlens-")
    return _local_folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; one per call, so retries never collide."""
    return f"{shared_folder(spark)}/threadlens-{label}-{uuid.uuid4().hex}"
