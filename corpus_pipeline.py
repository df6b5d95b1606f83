"""Corpus pipeline: documents -> toxicity -> exact dedup -> SimHash near-dedup -> decontamination -> packing.

Every stage calls one operator of ``labelsmith.llm`` on what its predecessor kept. ``STAGES`` are
functions of ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labelsmith.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from labelsmith.llm.common import documents, landed


def polite(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold stay."""
    return toxicity.keep_clean(docs, documents(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the least doc_id stays."""
    return simhash.keep_least(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item stay."""
    return decontaminate.keep_clean(docs, documents(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, each with its sequence and offset."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", polite), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", clean), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = landed(docs, name)
    return docs
