"""Registered queries: near copies of texts and of vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlode.llm import ngrams, vectors
from ledgerlode.llm.registry import query, table


@query()
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.ngram_components(table(spark, sf_dir, "documents"))


@query()
def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))
