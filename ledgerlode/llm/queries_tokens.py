"""Registered queries over codes: byte-level BPE, vector codes, two tokenizers side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlode.llm import alignment, byte_pairs, grid_codes
from ledgerlode.llm.registry import query, table
from ledgerlode.sources.files import stored


@query()
def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_pairs.decode_documents(byte_pairs.encode_documents(table(spark, sf_dir, "documents")))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query(grid_codes.code_sql())
def op12_grid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_codes.compress(table(spark, sf_dir, "embeddings"))


def digested(aligned: DataFrame) -> DataFrame:
    """The groups as a digest, empty where there are no tokens."""
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return aligned.withColumn("groups_sha256", digest).drop("groups")


@query()
def op13_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = stored(digested(alignment.align_documents(table(spark, sf_dir, "documents"))), "alignments")
    return alignment.score_links(held, alignment.link_counts(held))
