"""Registered queries: mixing and sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlode.llm import mixing, sharding
from ledgerlode.llm.registry import query, table


@query(mixing.MIX_SQL)
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op9_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)
