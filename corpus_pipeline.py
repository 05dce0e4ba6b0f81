"""From raw documents to packed training sequences.

Each stage reads what the one before it kept, and its decisions take effect:
documents of no recognised language go, one document of each near-duplicate
group stays, documents with benchmark passages go, personal data is replaced by
its kind, and what is left is packed.  All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from funnelforge.llm import common, decontam, jaccard_join, language_id, packing, pii


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fresh(stage):
    """``stage``, begun with what memory the one before it no longer needs."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.give_back(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@_fresh
def keep_recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected."""
    return language_id.drop_rejected(docs)


@_fresh
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that shares its word 5-grams."""
    return jaccard_join.keep_one(docs)


@_fresh
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark window."""
    return decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


@_fresh
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    return pii.redact(docs)


@_fresh
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut and pack what is left into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", keep_recognised),
    ("jaccard_join", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

#: Tokenisation, language models and weak supervision are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
