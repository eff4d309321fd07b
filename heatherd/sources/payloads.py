"""Landed JSON documents: one row per file, parsed by the operator that knows their shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("payload")
    )
