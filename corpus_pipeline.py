"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import linededup, mixing, neardup, packing, quality
from quarry.llm.common import scratch, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality rules keep."""
    return quality.filter_quality(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that earlier ones hold; one left empty goes."""
    return linededup.dedup_documents(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates."""
    return neardup.one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents with their places in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Estimation by EM and packing are not SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result stored as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
