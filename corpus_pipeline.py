"""The training-data pipeline: stages over ``documents``, each written before the next one reads it.

Every stage takes what the one before kept, whole, and its decisions are final: rejected
documents, near copies and documents with benchmark passages go, and the mix repeats
small sources. Null and empty texts pass through all stages: they are scored like any
text, share fingerprint zero, hold no benchmark passage, count no token in the mix, and
come out as the end id alone. Rows without a doc_id stay, except where the classifier or the
benchmark rejects them; rows that repeat a doc_id are documents of their own, of which
near copies become one. Extra columns of the input are carried to the last stage, and an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadlens.llm import decontam, mixing, quality, simhash, tokens
from threadlens.llm.common import importable, table
from threadlens.sources.tables import drop_stage, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: No source is repeated more often.
REPEATS = 2.0
END_ID = 2


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    importable(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    importable(spark)
    return simhash.keep_first(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources more often."""
    importable(spark)
    return mixing.remixed(docs, repeats=REPEATS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in seekable files, read back: one row per document taken."""
    import public_tokenizers

    importable(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.token_digests(spark, tokens.write_tokens(docs, path, END_ID, public_tokenizers.PATTERN))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_copies", near_copy_stage),
    ("benchmark", benchmark_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: The stages fit a model and read files back, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; gives what the last one returns."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
        if before is not None:
            drop_stage(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
