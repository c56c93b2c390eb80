"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents, without the rows they reject. ``run``
writes each stage's result as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from batchlens.llm import language_id, packing, parity_join, quality_rules, winnowing
from batchlens.llm.common import table, written


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.filter_documents(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language_id.filter_documents(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return parity_join.drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return winnowing.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents left, with its training sequence."""
    return packing.best_fit(docs)


STAGES = [
    ("quality_rules", rules_stage),
    ("language_id", language_stage),
    ("near_copies", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Models and components are not expressible in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
