"""From raw documents to packed training sequences, one stored stage after another.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame``; all but the last return the columns of
``documents``. :func:`run` writes each result as Parquet below the shared folder and reads it again
as the next stage's input. Nulls, repeated rows and empty tables are handled as the operators'
docstrings say; a stage keeps every column, whatever its name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locusloom.llm import decontaminate, packing, quality, secret_scan, simhash
from locusloom.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the trees reject; the trees learn from ``labels``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit_quality(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a twentieth or more of their words in benchmark passages."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    return secret_scan.redact_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: Trees, fingerprints and token ids are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{name}")
        result.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
