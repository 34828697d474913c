"""Point-in-time join: the version of a key that was valid at the time of an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlode.functions.exprs import all_present, col
from ledgerlode.operators.ordering import (
    HOT_ROWS, carries, has_hot_key, ordered_ranges, with_carry,
)

FEW_ROWS = 200_000
FEW_VERSIONS_PER_KEY = 64


def pit_join(events: DataFrame, versions: DataFrame, keys: Sequence[str], event_time: str,
             start: str, end: str, payload: Sequence[str], strategy: str = "auto",
             hot_rows: int = HOT_ROWS, ranges: int | None = None) -> DataFrame:
    """Left join of events to the version with ``start <= event_time < end`` (open end: no bound).

    Adds the ``payload`` columns. An event takes the version of its key that started last at or before it,
    and NULL when that one has ended, also where versions overlap; of versions with one start the one with the
    largest row hash counts. Versions without a start never count. All strategies give these rows:

    * ``join``: each version ends at the latest where the next one of its key starts; then an equi join on
      the key with the interval as residual condition, planned by the optimizer.
    * ``scan``: events and versions in one ordered pass, each event carrying the last version started
      before it; the cost does not grow with the versions per key. Where one key has more than
      ``hot_rows`` rows, the pass runs over ranges of the ordering, and nothing is broadcast but one
      carry row per range.
    * ``auto``: ``join`` when a count over the version keys alone shows that the versions are few in total
      and per key, else ``scan``. Whether a side is broadcast is left to the optimizer.
    """
    keys, payload = list(keys), list(payload)
    versions = versions.select(*keys, start, end, *[c for c in payload if c not in (start, end)])
    versions = versions.where(all_present([*keys, start]))
    if strategy == "auto":
        strategy = "join" if _few_versions(versions, keys) else "scan"
    if strategy == "join":
        return _interval_join(events, versions, keys, event_time, start, end, payload)
    if strategy == "scan":
        return _ordered_scan(events, versions, keys, event_time, start, end, payload, hot_rows, ranges)
    raise ValueError(f"unknown strategy: {strategy!r}")


def _few_versions(versions: DataFrame, keys: list[str]) -> bool:
    size = (versions.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                    .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                         F.coalesce(F.max("n"), F.lit(0)).alias("most")).first())
    return size.total <= FEW_ROWS and size.most <= FEW_VERSIONS_PER_KEY


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[col(c) for c in df.columns])


def _interval_join(events, versions, keys, event_time, start, end, payload):
    following = Window.partitionBy(*[col(k) for k in keys]).orderBy(col(start), _row_hash(versions))
    right = versions.select(
        *[col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        col(start).alias("__start"), F.least(col(end), F.lead(col(start)).over(following)).alias("__end"),
        *[col(c).alias(f"__p{i}") for i, c in enumerate(payload)])
    condition = (F.col("__start") <= col(event_time)) & (
        F.col("__end").isNull() | (col(event_time) < F.col("__end")))
    for i, k in enumerate(keys):
        condition = condition & (col(k) == F.col(f"__k{i}"))
    joined = events.join(right, condition, "left")
    return joined.select(*events.columns,
                         *[F.col(f"__p{i}").alias(c) for i, c in enumerate(payload)])


def _ordered_scan(events, versions, keys, event_time, start, end, payload, hot_rows, ranges):
    event = F.struct(*events.columns)
    version = F.struct(col(start).alias("at"), col(end).alias("until"),
                       *[col(c).alias(f"p{i}") for i, c in enumerate(payload)])
    key_columns = [f"__k{i}" for i in range(len(keys))]
    named_keys = [col(k).alias(n) for k, n in zip(keys, key_columns)]
    # A version starting at the event's instant is valid for it, so versions (0) sort before events (1).
    opened = versions.select(*named_keys, col(start).alias("__at"), F.lit(0).alias("__kind"),
                             _row_hash(versions).alias("__tie"), version.alias("__v"))
    happened = events.select(*named_keys, col(event_time).alias("__at"), F.lit(1).alias("__kind"),
                             F.monotonically_increasing_id().alias("__tie"), event.alias("__e"))
    stream = opened.unionByName(happened, allowMissingColumns=True)
    group, hot = key_columns, hot_rows <= 0 or has_hot_key(stream, key_columns, hot_rows)
    if hot:
        stream = ordered_ranges(stream, [*key_columns, "__at", "__kind", "__tie"], ranges)
        group = ["__range", *key_columns]
    inside = (Window.partitionBy(*group).orderBy("__at", "__kind", "__tie")
              .rowsBetween(Window.unboundedPreceding, 0))
    seen = (stream.withColumn("__hit", F.last("__v", ignorenulls=True).over(inside))
                  .where("__kind = 1"))
    if hot:
        lasts = stream.groupBy(*group).agg(F.max_by("__v", F.when(F.col("__kind") == 0, F.struct("__at", "__tie")))
                                           .alias("__last"))
        carried = carries(lasts, key_columns, F.last("__last", ignorenulls=True))
        seen = with_carry(seen, carried, key_columns).withColumn("__hit",
                                                                 F.coalesce("__hit", "__carry"))
    valid = F.col("__hit.until").isNull() | (F.col("__at") < F.col("__hit.until"))
    return seen.select(
        *[F.col("__e").getField(c).alias(c) for c in events.columns],
        *[F.when(valid, F.col(f"__hit.p{i}")).alias(c) for i, c in enumerate(payload)])
