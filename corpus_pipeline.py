"""Corpus pipeline: documents cleaned, deduplicated, mixed and packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result to the shared folder and hands the written table on, so a
lost executor costs one stage at most.  All but the last return the columns of
documents; the last returns one row per packed piece.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import line_dedup, mixing, ngram_join, packing, quality
from tidemark.llm.common import documents, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that break a rule."""
    return quality.clean_documents(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go; so do documents left without words."""
    return line_dedup.drop_lines(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest doc_id stays."""
    return ngram_join.one_per_group(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix takes them."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram jaccard join", ngram_jaccard_join),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: The rules of the stages are not SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
