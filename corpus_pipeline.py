"""The corpus pipeline: quality, near copies, decontamination, mixing, sharding; each over the table ``documents``
as the stage before left it.

Every stage takes null ids, texts and sources, repeated rows and an empty table: a null text is an empty document, a
null id an id like others, a repeated row a document of its own, and no rows give none. Texts are never cut.

ORACLE_SQL is None: a learned classifier has no SQL. ``tests/llm/test_pipeline.py`` holds the n-gram and
decontamination stages against their operators' results, which have brute-force tests of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlode.llm import decontaminate, mixing, ngrams, quality, sharding
from ledgerlode.llm.registry import ship, table
from ledgerlode.sources.files import shared_root, stored

ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    ship(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    ship(spark)
    return ngrams.drop_near_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in whole documents; those it does not take go. Rows are told
    apart by a number of their own, so repeated and null ids are documents like others."""
    names = docs.columns
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "mix-rows")
    copies = (mixing.mix(rows, table(spark, sf_dir, "labels"), carry=("__row",))
              .where("copies > 0").select("__row", F.col("copies").alias("__copies")))
    return (rows.join(copies, "__row")
                .withColumn("__turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
                .select(*names))


def hash_tree_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each row of the corpus goes: shard and slot."""
    return sharding.shard_documents(docs, shards=8, carry=("doc_id", "lang", "source"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing to target weights", source_mix),
    ("sharding", hash_tree_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = shared_root(spark, "corpus")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
