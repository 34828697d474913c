"""Registered queries: passages that repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlode.llm import recompression, suffixes
from ledgerlode.llm.registry import query, table


@query()
def op3_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeated_words(table(spark, sf_dir, "documents")).drop("kept")


@query()
def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")
