"""Surrogate keys that stay: a stored map from natural keys to numbers, which only ever grows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerlode.operators.ordering import global_row_number
from ledgerlode.sources import tables

BUCKETS = 64


def assign_keys(rows: DataFrame, keys: Sequence[str], name: str, map_table: str, buckets: int = BUCKETS,
                ranges: int | None = None) -> DataFrame:
    """Add the surrogate key ``name`` of each row's natural key, from a bucketed catalog table of all keys so far.

    Natural keys that the map lacks are numbered in their order after its largest number and appended first, so
    numbers once given stay, whichever keys arrive late, and facts written with them stay valid. The numbering ranges
    over the new keys only, and the map is read in its buckets, without a shuffle of it; it is never broadcast, so
    that no map passes through the driver. Rows with a null in their key get none. A load that stopped after the
    append finds its keys there when it runs again. One load of a map at a time.
    """
    keys = list(keys)
    spark = rows.sparkSession
    wanted = rows.select(*keys).dropna(subset=keys).distinct()
    if tables.create_bucketed(wanted.withColumn(name, F.lit(0).cast("long")), map_table, keys, buckets):
        fresh, last = wanted, 0
    else:
        known = spark.table(map_table)
        fresh = wanted.join(known.select(*keys).hint("merge"), keys, "left_anti")
        last = known.agg(F.max(name)).first()[0] or 0
    n = tables.buckets_of(spark, map_table)
    numbered = global_row_number(fresh, keys, name, ranges).withColumn(name, F.col(name) + F.lit(last))
    tables.append_buckets(tables.with_bucket(numbered, keys, n), map_table)
    return rows.join(spark.table(map_table).select(*keys, name).hint("merge"), keys, "left")
