"""Slowly changing dimensions as one declarative plan each: type 1 upsert, type 2 history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlode.functions.exprs import as_timestamp, col, row_digest
from ledgerlode.operators.ordering import latest_per_key
from ledgerlode.operators.rows import union_batches

START, END, CURRENT, HASH = (
    "effective_start_date", "effective_end_date", "is_current_flag", "row_hash")
KEEP, EXPIRE, INSERT = "keep", "expire", "insert"


def is_current() -> Column:
    """Test for the current version. A partition directory may give the flag back as text."""
    return F.col(CURRENT).cast("boolean")


def current_versions(df: DataFrame) -> DataFrame:
    """Current rows, or every row when the frame has no history."""
    return df.where(is_current()) if CURRENT in df.columns else df


def unique_source(source: DataFrame, keys: Sequence[str], on_duplicate: str = "error",
                  newest_first: Sequence[Column] | None = None) -> DataFrame:
    """Guard a merge source: ``latest`` keeps the newest row per key, ``error`` fails the job when a
    key occurs twice. The check uses the same key distribution as the merge join that follows. With ``checked`` the
    caller has counted that no key does, and the rows pass as they are."""
    if on_duplicate == "checked":
        return source
    if on_duplicate == "latest":
        order = list(newest_first or [F.xxhash64(*[col(c) for c in source.columns])])
        return latest_per_key(source, keys, order)
    if on_duplicate != "error":
        raise ValueError(f"unknown on_duplicate: {on_duplicate!r}")
    names = [col(k) for k in keys]
    position = F.row_number().over(Window.partitionBy(*names).orderBy(*names))
    key_text = F.concat_ws(",", *[n.cast("string") for n in names])
    failure = F.raise_error(F.concat(F.lit("duplicate key in merge source: "), key_text))
    return (source.withColumn("__pos", position)
                  .where(F.when(F.col("__pos") > 1, failure.cast("boolean")).otherwise(F.lit(True)))
                  .drop("__pos"))


def merge_scd1(current: DataFrame | None, source: DataFrame, keys: Sequence[str],
               on_duplicate: str = "error",
               newest_first: Sequence[Column] | None = None) -> DataFrame:
    """Upsert: a source row replaces the row of the same key, other target rows stay. A source without
    one of the target's columns keeps the old value of that column, as an update of the given columns
    does."""
    keys = list(keys)
    source = unique_source(source, keys, on_duplicate, newest_first)
    if current is None:
        return source
    kept_columns = [c for c in current.columns if c not in source.columns]
    if kept_columns:
        source = source.join(current.select(*keys, *kept_columns), keys, "left")
    return union_batches(current.join(source.select(*keys), keys, "left_anti"), source)


def stamp_scd2(source: DataFrame, tracked: Sequence[str],
               effective_ts: str | dt.datetime | Column, digest_mode: str = "compat") -> DataFrame:
    """Open version rows: start, empty end, current flag and digest of the tracked columns."""
    start = as_timestamp(effective_ts)
    stamped = source.withColumn(START, start)
    return stamped.withColumns({
        END: F.lit(None).cast(stamped.schema[START].dataType),
        CURRENT: F.lit(True),
        HASH: row_digest(tracked, digest_mode),
    })


def scd2_actions(current: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current versions against stamped source rows: one output row per action, in ``__action``.

    One full outer join on the key classifies each key; ``explode`` turns a change into its two rows. A
    change with the start of the open version corrects it: the new row replaces that version, which would
    be empty otherwise. Keys are unique on both sides, so no join key is hot.
    """
    keys = list(keys)
    columns = list(dict.fromkeys([*current.columns, *source.columns]))
    old = current.select(*keys, F.struct(*current.columns).alias("t"))
    new = source.select(*keys, F.struct(*source.columns).alias("s"))
    change = F.col(f"t.{HASH}") != F.col(f"s.{HASH}")
    corrected = change & F.col(f"t.{START}").eqNullSafe(F.col(f"s.{START}"))
    actions = (F.when(F.col("t").isNull() | (F.col("s").isNotNull() & corrected), F.array(F.lit(INSERT)))
                .when(F.col("s").isNotNull() & change, F.array(F.lit(EXPIRE), F.lit(INSERT)))
                .otherwise(F.array(F.lit(KEEP))))
    joined = (old.join(new, keys, "full_outer")
                 .select("t", "s", F.explode(actions).alias("__action")))

    def pick(side: str, frame: DataFrame, name: str) -> Column:
        return F.col(f"{side}.{name}") if name in frame.columns else F.lit(None)

    def value(name: str) -> Column:
        inserted, held = pick("s", source, name), pick("t", current, name)
        if name == END:
            held = F.when(F.col("__action") == EXPIRE, F.col(f"s.{START}")).otherwise(held)
        if name == CURRENT:
            held = F.when(F.col("__action") == EXPIRE, F.lit(False)).otherwise(F.lit(True))
        return F.when(F.col("__action") == INSERT, inserted).otherwise(held).alias(name)

    return joined.select(*[value(c) for c in columns], "__action")


def merge_scd2(current: DataFrame | None, source: DataFrame, keys: Sequence[str],
               tracked: Sequence[str], effective_ts: str | dt.datetime | Column,
               digest_mode: str = "compat", on_duplicate: str = "error",
               newest_first: Sequence[Column] | None = None,
               first_start: str | dt.datetime | Column | None = None,
               with_action: bool = False) -> DataFrame:
    """All versions after merging ``source``.

    A changed key gets its current version closed at ``effective_ts`` and a new one opened at the same
    instant (half-open ``[start, end)``). New keys open a version, keys missing from the source stay
    current, closed history passes through untouched. ``first_start`` replaces the start on first load.
    """
    source = unique_source(source, keys, on_duplicate, newest_first)
    if current is None:
        opened = stamp_scd2(source, tracked, first_start or effective_ts, digest_mode)
        return opened.withColumn("__action", F.lit(INSERT)) if with_action else opened
    stamped = stamp_scd2(source, tracked, effective_ts, digest_mode)
    merged = scd2_actions(current.where(is_current()), stamped, keys)
    history = current.where(~is_current()).withColumn("__action", F.lit(KEEP))
    merged = union_batches(history, merged)
    return merged if with_action else merged.drop("__action")


def scd2_change_counts(merged_with_action: DataFrame) -> DataFrame:
    """Rows per action of a merge made with ``with_action=True``."""
    return merged_with_action.groupBy(F.col("__action").alias("action")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def scd2_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of counts that are all zero on a sound history.

    Every start and every end is a boundary of its key. In a gap-free, non-overlapping chain each inner
    boundary is exactly one end and one start, and only the first start stands alone. Two aggregations
    with map-side combine decide that; no window over the versions of a hot key is needed.
    """
    keys = list(keys)
    closed = F.col(END).isNotNull()
    boundary = F.explode(F.array(
        F.struct(F.col(START).alias("at"), F.lit(1).alias("s"), F.lit(0).alias("e")),
        F.struct(F.col(END).alias("at"), F.lit(0).alias("s"), F.lit(1).alias("e")))).alias("b")
    points = (df.select(*keys, boundary).where(F.col("b.at").isNotNull())
                .groupBy(*keys, F.col("b.at").alias("at"))
                .agg(F.sum("b.s").alias("s"), F.sum("b.e").alias("e")))
    chains = points.groupBy(*keys).agg(
        F.count_if((F.col("s") > 0) & (F.col("e") == 0)).alias("heads"),
        F.count_if((F.col("s") > 1) | (F.col("e") > 1)).alias("doubled"))
    flags = df.groupBy(*keys).agg(
        F.count_if(is_current()).alias("n_current"),
        F.count_if(is_current() == closed).alias("mismatch"),
        F.count_if(closed & (F.col(END) <= F.col(START))).alias("empty"))
    return flags.join(chains, keys).agg(
        F.count(F.lit(1)).alias("keys_checked"),
        F.count_if(F.col("n_current") > 1).alias("keys_with_two_current"),
        F.count_if((F.col("heads") > 1) | (F.col("doubled") > 0)).alias("keys_with_broken_chain"),
        F.coalesce(F.sum("mismatch"), F.lit(0)).alias("flag_mismatches"),
        F.coalesce(F.sum("empty"), F.lit(0)).alias("empty_intervals"))
