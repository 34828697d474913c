"""Catalog tables as targets of the jobs: plain, partitioned, and bucketed by key.

A bucketed table is laid out in ``n`` buckets of the key's hash twice over: as Spark buckets, so that a merge reads
it in the distribution that its join needs, without a shuffle, and as the partition column ``key_bucket`` with the
same number, so that a merge reads and replaces the buckets of its batch only. Replacing is a dynamic
partition overwrite: new files are staged, then moved in place of the old ones.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlode.functions.exprs import col
from ledgerlode.sources.files import CODEC, ZSTD_LEVEL

BUCKET = "key_bucket"
_MODE = "spark.sql.sources.partitionOverwriteMode"
_lock, _writers = threading.Lock(), {"n": 0, "before": "STATIC"}


@contextmanager
def _dynamic(spark: SparkSession) -> Iterator[None]:
    """Inserts into tables take the mode of overwriting from the session alone. It is dynamic while any of them runs,
    also from several threads; writes to paths name theirs themselves."""
    with _lock:
        if not _writers["n"]:
            _writers["before"] = spark.conf.get(_MODE)
            spark.conf.set(_MODE, "dynamic")
        _writers["n"] += 1
    try:
        yield
    finally:
        with _lock:
            _writers["n"] -= 1
            if not _writers["n"]:
                spark.conf.set(_MODE, _writers["before"])


def create_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> bool:
    """Create an empty table with the frame's columns where there is none; whether it did."""
    if df.sparkSession.catalog.tableExists(name):
        return False
    df.limit(0).write.format(fmt).partitionBy(*partition_by).saveAsTable(name)
    return True


def add_columns(df: DataFrame, name: str) -> list[str]:
    """Give a table the frame's columns that it lacks, before its partition columns; returns them."""
    spark = df.sparkSession
    have = set(spark.table(name).columns)
    fresh = [f for f in df.schema.fields if f.name not in have]
    if fresh:
        listed = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fresh)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")
    return [f.name for f in fresh]


def in_order(df: DataFrame, name: str) -> DataFrame:
    """The frame with the table's columns and types in the table's order; what it lacks is NULL."""
    have = set(df.columns)
    return df.select([(col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in df.sparkSession.table(name).schema.fields])


def append_rows(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a table, which is created where there is none."""
    create_table(df, name, partition_by)
    add_columns(df, name)
    in_order(df, name).write.insertInto(name)


def overwrite_rows(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Replace all rows of a table, its schema and partitioning included."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)


def replace_rows(df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that the frame has rows for and leave the others, so that a rerun replaces itself."""
    create_table(df, name, partition_by)
    add_columns(df, name)
    with _dynamic(df.sparkSession):
        in_order(df, name).hint("rebalance", *partition_by).write.insertInto(name, overwrite=True)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key, the same number that Spark's bucketing gives it."""
    return F.pmod(F.hash(*[col(k) for k in keys]), F.lit(buckets)).cast("int")


def buckets_of(spark: SparkSession, name: str) -> int:
    """The number of buckets that a table was created with."""
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return int(re.sub(r"\D", "", facts["Num Buckets"]))


def create_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, partition_by: Sequence[str] = ()) -> bool:
    """Create an empty bucketed table for the frame's columns where there is none; whether it did."""
    if df.sparkSession.catalog.tableExists(name):
        return False
    (df.limit(0).withColumn(BUCKET, bucket_of(keys, buckets)).write.option("compression", CODEC).options(**ZSTD_LEVEL)
       .partitionBy(*partition_by, BUCKET).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return True


def stage_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows stored as a table dealt as the one they are meant for, so that whatever groups or joins them by key
    needs no shuffle; with the column ``key_bucket``. Drop the table after use."""
    (df.withColumn(BUCKET, bucket_of(keys, buckets)).write.option("compression", CODEC).options(**ZSTD_LEVEL)
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows dealt to the buckets of a table, as a join with it needs them, with the column ``key_bucket``."""
    return df.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(buckets, *[col(k) for k in keys])


def touched(df: DataFrame) -> list[int]:
    """The buckets that a frame has rows in, at most as many as the table has."""
    return sorted(r[BUCKET] for r in df.select(BUCKET).distinct().collect())


def read_buckets(spark: SparkSession, name: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of some buckets; only their directories are read."""
    df = spark.table(name)
    return df if buckets is None else df.where(F.col(BUCKET).isin(list(buckets)) if buckets else F.lit(False))


def replace_buckets(df: DataFrame, name: str) -> None:
    """Write whole buckets, dealt by key and with the column ``key_bucket``, in place of those that the table has."""
    add_columns(df, name)
    with _dynamic(df.sparkSession):
        in_order(df, name).write.insertInto(name, overwrite=True)


def append_buckets(df: DataFrame, name: str) -> None:
    """Add rows, dealt by key and with the column ``key_bucket``, to the buckets of a table."""
    in_order(df, name).write.insertInto(name)
