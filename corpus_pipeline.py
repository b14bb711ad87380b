"""The corpus pipeline: five stages from raw documents to a mixed training set.

Every stage reads what the stage before it kept.  A filtering stage returns
its input's rows that stay, with all their columns, whatever their names; the
last stage returns what the mix takes of each document.

Null and empty texts are documents without words: the classifier scores them
by its bias, exact dedup keeps one of them, near dedup links them to other
wordless ones, decontamination finds nothing in them, the mix takes 0 words.
Rows are told apart by doc_id: near dedup and decontamination decide for all
rows of a doc_id together, null being one.  Empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tiffin.llm import common, decontaminate, exact, mixing, quality, queries, simhash


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from this stage's labelled documents."""
    return quality.keep_quality(docs, common.table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group that SimHash links connect."""
    found = simhash.near_duplicates(docs)
    return common.keep_rows(docs, found.where("doc_id <=> component_id").select("doc_id"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    found = decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))
    return common.drop_rows(docs, found.where("contaminated").select("doc_id"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix to target weights takes of every document."""
    return mixing.mix(docs, queries.MIX_WEIGHTS, queries.MIX_SHARE, queries.MIX_CAP).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: SQL can't express the classifier and the fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
