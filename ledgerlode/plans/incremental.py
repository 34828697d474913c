"""Merges into bucketed catalog tables: a batch reads and rewrites the buckets of its keys only.

A type 2 table is two tables: ``name`` has the current versions, bucketed by key, and ``name_closed`` the closed ones, one
partition per closing batch and bucket, which no merge reads again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlode.operators import scd
from ledgerlode.sources import files, tables

BUCKETS = 64
BUCKET_BYTES = 8 << 20       # of a table's first batch, where the buckets follow the bytes
CLOSED_BY = "closed_by"


@dataclass(frozen=True)
class Target:
    """A merged table: its name in the catalog, its keys, and the buckets it gets when it is created."""

    name: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS

    @property
    def closed(self) -> str:
        return f"{self.name}_closed"


@dataclass(frozen=True)
class Merged:
    buckets: tuple[int, ...]
    rows: int


def buckets_for(spark: SparkSession, target: Target) -> int:
    """The buckets that the table has, or is to have."""
    return tables.buckets_of(spark, target.name) if spark.catalog.tableExists(target.name) else target.buckets


def _dealt(target: Target, source: DataFrame, on_duplicate: str, newest: Sequence[Column] | None):
    """The batch dealt as the table is, one row per key, and the buckets it touches. A batch with ``key_bucket`` is
    dealt already (``tables.stage_bucketed``)."""
    spark = source.sparkSession
    exists, n = spark.catalog.tableExists(target.name), buckets_for(spark, target)
    dealt = source if tables.BUCKET in source.columns else tables.with_bucket(source, target.keys, n)
    batch = scd.unique_source(dealt, target.keys, on_duplicate, newest)
    placed = source if dealt is source else source.select(tables.bucket_of(target.keys, n).alias(tables.BUCKET))
    return exists, n, batch, tables.touched(placed)


def _filled(target: Target, batch: DataFrame, hit: Sequence[int]) -> Merged:
    """The first batch stored in the empty table as it is; there is nothing to merge it with."""
    batch, seen = files.counted(batch, "first")
    tables.replace_buckets(batch, target.name)
    return Merged(tuple(hit), files.observed(seen))


def merge_type1(target: Target, source: DataFrame, on_duplicate: str = "error",
                newest: Sequence[Column] | None = None) -> Merged:
    """Upsert a batch: rows of its keys replace those of the table, columns that it lacks keep their values."""
    spark = source.sparkSession
    exists, n, batch, hit = _dealt(target, source, on_duplicate, newest)
    if not exists:
        tables.create_bucketed(source.drop(tables.BUCKET), target.name, target.keys, n)
    if not hit:
        return Merged((), 0)
    if not exists:
        return _filled(target, batch, hit)
    held = tables.read_buckets(spark, target.name, hit)
    merged = upserted(held, batch, target.keys)
    merged, seen = files.counted(merged, "merged")
    tables.replace_buckets(merged, target.name)
    return Merged(tuple(hit), files.observed(seen))


def upserted(held: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One full outer join on the key: the batch's row where it has one, else the table's."""
    keys, mine = list(keys), set(batch.columns)
    columns = list(dict.fromkeys([*held.columns, *batch.columns]))
    old = held.select(*keys, F.struct(*held.columns).alias("t"))
    new = batch.select(*keys, F.struct(*batch.columns).alias("s"))

    def value(name: str) -> Column:
        if name not in mine:
            return F.col(f"t.{name}").alias(name)
        fresh = F.col(f"s.{name}")
        return (F.when(F.col("s").isNotNull(), fresh).otherwise(F.col(f"t.{name}")) if name in held.columns
                else fresh).alias(name)

    return old.join(new, keys, "full_outer").select(*[value(c) for c in columns])


def merge_type2(target: Target, source: DataFrame, tracked: Sequence[str], effective_ts, batch_id: str,
                digest_mode: str = "strict", on_duplicate: str = "error", newest: Sequence[Column] | None = None,
                first_start=None) -> Merged:
    """Merge a batch into a history: changed keys get their open version closed and a new one opened.

    Closed versions are written first, into partitions of their own, then the buckets of the current ones. A batch
    that stopped in between, or half-way through the buckets, is run again: buckets that have its rows
    already close nothing any more, and their closed versions are in partitions that are then not replaced.
    """
    spark = source.sparkSession
    exists, n, batch, hit = _dealt(target, source, on_duplicate, newest)
    opened = scd.stamp_scd2(batch, tracked, effective_ts if exists else first_start or effective_ts, digest_mode)
    if not exists:
        tables.create_bucketed(opened.drop(tables.BUCKET), target.name, target.keys, n)
        closed_of = opened.drop(tables.BUCKET).withColumn(CLOSED_BY, F.lit(batch_id))
        tables.create_bucketed(closed_of, target.closed, target.keys, n, partition_by=[CLOSED_BY])
    if not hit:
        return Merged((), 0)
    if not exists:
        return _filled(target, opened, hit)
    current = tables.read_buckets(spark, target.name, hit)
    # Each write runs the join for itself: both sides are dealt by key, so that costs a scan and no shuffle of the table.
    merged = scd.scd2_actions(current, opened, target.keys)
    is_closed = F.col("__action") == scd.EXPIRE
    closed = merged.where(is_closed).drop("__action").withColumn(CLOSED_BY, F.lit(batch_id))
    tables.replace_buckets(closed, target.closed)
    kept, seen = files.counted(merged.where(~is_closed).drop("__action"), "current")
    tables.replace_buckets(kept, target.name)
    return Merged(tuple(hit), files.observed(seen))


def read_current(spark: SparkSession, target: Target) -> DataFrame | None:
    if not spark.catalog.tableExists(target.name):
        return None
    return spark.table(target.name).drop(tables.BUCKET)


def read_history(spark: SparkSession, target: Target) -> DataFrame | None:
    """Current and closed versions; the same as ``read_current`` on a type 1 table."""
    current = read_current(spark, target)
    if current is None or not spark.catalog.tableExists(target.closed):
        return current
    closed = spark.table(target.closed).drop(tables.BUCKET, CLOSED_BY)
    return current.unionByName(closed, allowMissingColumns=True)
