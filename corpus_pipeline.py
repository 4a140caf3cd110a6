"""The corpus pipeline: stages over ``documents``, each calling one operator.

Each stage's result is written as Parquet in the shared scratch folder and read
again as the next stage's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelstack.llm import decontamination, mixing, near_dedup, quality_rules, secret_scans
from reelstack.session import remove_scratch, scratch_path, scratch_scope


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return quality_rules.keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the least doc_id."""
    return near_dedup.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a test item, edited ones included."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by its kind."""
    return secret_scans.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes (``taken / size`` copies)."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("near duplicates", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("mixing", mixing_stage),
]

# Near-duplicate search and alignment have no SQL form; the pipeline is tested
# against brute force on small fixtures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's scratch goes when its result is written, and its input when
    the next result is; what stays is the result of the last stage."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage_{k}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_scratch(spark, [before])
        docs, before = spark.read.parquet(path), path
    return docs
