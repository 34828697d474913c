"""Ordered operators that never put an unbounded group into one task.

A global ``row_number``, or a running sum over one hot key, would sort all its rows in one task. Here
such rows are range-partitioned by the full ordering first, so that a hot key is cut like any other run
of rows. The result is stored once with its range number: later scans, and tasks redone after a lost
executor, see the same ranges. Each range is then numbered or summed by its own, and a small table of
carries (one row per range) is broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlode.functions.exprs import col
from ledgerlode.sources.files import stored

HOT_ROWS = 5_000_000         # a key with more rows than this is cut into ranges


def _by_range(df: DataFrame, order: Sequence[str], ranges: int | None) -> DataFrame:
    names = [col(c) for c in order]
    return df.repartitionByRange(ranges, *names) if ranges else df.repartitionByRange(*names)


def ordered_ranges(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """The rows stored in ranges of the ordering, with the range number in ``__range``.

    Without a given number, there are as many ranges as shuffle partitions, small ones merged.
    """
    return stored(_by_range(df, order, ranges).withColumn("__range", F.spark_partition_id()), "ranges")


def global_row_number(df: DataFrame, order: Sequence[str], name: str,
                      ranges: int | None = None) -> DataFrame:
    """``row_number() over (order by …)`` as long, without a single-partition sort of the rows.

    One range shuffle and a sort inside each range; the position within a range comes from the sorted
    partition itself. Offsets are counted on the range column alone.
    """
    columns = [col(c) for c in order]
    # The id of a row is its partition number times 2^33 plus its position in the partition.
    laid_out = stored(_by_range(df, order, ranges).sortWithinPartitions(*columns)
                      .withColumn("__id", F.monotonically_increasing_id())
                      .withColumn("__range", F.shiftright("__id", 33)), "numbered")
    counts = laid_out.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    position = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (laid_out.join(F.broadcast(offsets), "__range")     # one row per range
                    .withColumn(name, (position + F.col("__off")).cast("long"))
                    .drop("__range", "__id", "__off"))


def surrogate_key(df: DataFrame, order: Sequence[str], name: str, mode: str = "sequence",
                  ranges: int | None = None) -> DataFrame:
    """Surrogate key per row. ``sequence`` numbers 1..n in key order and shifts on every rebuild;
    ``hash`` is a 64-bit hash of the key columns, stable and free of any shuffle (test it unique)."""
    if mode == "sequence":
        return global_row_number(df, order, name, ranges)
    if mode == "hash":
        return df.withColumn(name, F.xxhash64(*[col(c) for c in order]))
    raise ValueError(f"unknown key mode: {mode!r}")


def has_hot_key(df: DataFrame, keys: Sequence[str], limit: int) -> bool:
    """Whether one key has more than ``limit`` rows; a count over the key columns with map-side combine."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (counts.agg(F.max("n")).first()[0] or 0) > limit


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str,
                hot_rows: int = HOT_ROWS, ranges: int | None = None) -> DataFrame:
    """Running total of ``value`` per ``by`` in ``order`` (which must be unique within ``by``).

    As long as no group has more than ``hot_rows`` rows this is one window. Beyond that the rows are cut
    into ranges of ``by + order`` together: an account with a third of all rows spreads over a third of
    the ranges, and only a group that crosses a cut needs a carry. Both ways give the type of the sum.
    """
    by, order = list(by), list(order)
    kind = df.select(F.sum(value)).schema[0].dataType
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if hot_rows > 0 and not has_hot_key(df, by, hot_rows):
        return df.withColumn(name, F.sum(value).over(inside))
    cut = ordered_ranges(df.withColumn("__value", value), by + order, ranges)
    totals = cut.groupBy("__range", *by).agg(F.sum("__value").alias("__last"))
    inside = (Window.partitionBy("__range", *by).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    summed = cut.withColumn("__sum", F.sum("__value").over(inside))
    joined = with_carry(summed, carries(totals, by, F.sum("__last")), by)
    return (joined.withColumn(name, F.coalesce(F.col("__sum") + F.coalesce("__carry", F.lit(0)),
                                               F.col("__carry")).cast(kind))
                  .drop("__value", "__range", "__sum", "__carry"))


def carries(lasts: DataFrame, by: Sequence[str], combine: Column) -> DataFrame:
    """What a group brings into a range from the earlier ones, from one ``__last`` per range and group."""
    before = (Window.partitionBy(*by).orderBy("__range")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (lasts.withColumn("__carry", combine.over(before))
                 .where(F.col("__carry").isNotNull())
                 .select(F.col("__range").alias("__crange"), F.struct(*by).alias("__by"), "__carry"))


def with_carry(df: DataFrame, carried: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach the carry of (range, group). A range has at most one group that began before it, so the
    broadcast side has at most one row per range."""
    same = (F.col("__range") == F.col("__crange")) & F.struct(*by).eqNullSafe(F.col("__by"))
    return df.join(F.broadcast(carried), same, "left").drop("__crange", "__by")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """First row per key in the given order, which must be total for a repeatable answer.

    Spark limits each key to one row before the shuffle (``WindowGroupLimit``), so a hot key sends one
    row per map task.
    """
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*newest_first)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def flag_first(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """True on the first row of every group in ``order`` (unique within the group), else false.

    The first row is found by a map-side combined ``min`` and joined back on the whole order key, so
    the rows of a hot group stay spread.
    """
    firsts = (df.groupBy(*by).agg(F.min(F.struct(*order)).alias("__first"))
                .select(*by, *[F.col(f"__first.{c}").alias(c) for c in order],
                        F.lit(True).alias(name)))
    on = [*by, *order]
    return df.join(firsts, on, "left").withColumn(name, F.coalesce(name, F.lit(False)))
