"""Corpus pipeline: from raw documents to packed training sequences.

    documents -> quality rules -> n-gram Jaccard join -> substring dedup
              -> benchmark decontamination -> best-fit packing

Each stage works on all that the stage before kept and applies its operator
with production parameters; all but the last keep the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, packing, partenum, quality_gbt, store, substring_dedup
from quarry.ship import ensure_on_executors


def _columns(documents: DataFrame, out: DataFrame) -> DataFrame:
    return out.select(*documents.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the quality trees reject go."""
    ensure_on_executors(spark)
    return _columns(docs, quality_gbt.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id stays."""
    ensure_on_executors(spark)
    return _columns(docs, partenum.keep_one(docs))


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 50 words or more that an earlier document has are cut out."""
    ensure_on_executors(spark)
    return _columns(docs, substring_dedup.clean(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is mostly benchmark goes."""
    ensure_on_executors(spark)
    return _columns(docs, decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 1,024 tokens."""
    ensure_on_executors(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("ngram_join", ngram_join),
    ("substring_dedup", substring_removal),
    ("decontamination", benchmark_decontamination),
    ("packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and reread by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The quality trees' verdicts can't be expressed in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL: str | None = None
