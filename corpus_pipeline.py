"""A corpus from raw documents to packed sequences: five stages, each one of the llm operators.

Every stage reads what its predecessor kept and writes a table that the next one reads. All but
the last return the columns of `documents`. SQL cannot express tokenization, so there is no
ORACLE_SQL; tests compare the stages with plain computations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heatherd.llm import mixing, ngram_join, packing, quality, suffix_dedup
from heatherd.llm.common import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of n-gram Jaccard links stays."""
    return ngram_join.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand in a document with a smaller id are cut out."""
    return suffix_dedup.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their source ask for."""
    return mixing.emit_copies(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before is not None:  # nothing reads it any more
            scratch.drop(before)
        before = name
    return docs
