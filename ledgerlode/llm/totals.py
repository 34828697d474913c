"""Running totals inside groups of any size, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def unit_hash(*columns: Column) -> Column:
    """A number in (0, 1) from a 64-bit hash of the columns."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11) + 0.5) / F.lit(float(1 << 53))


def bucket_count(rows: Column) -> Column:
    """The root of the group's rows: buckets, and rows in a bucket, then grow alike."""
    return F.greatest(F.lit(1), F.ceil(F.sqrt(rows.cast("double")))).cast("long")


def running_totals(df: DataFrame, group: str, buckets: str, unit: str, order: list[str],
                   value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same group that come before this one.

    ``unit`` is a number in [0, 1] that never falls in the order of the columns ``order``, and
    ``buckets`` the number of buckets the group is cut into by it. A window then only ever sorts one
    bucket, and one more window the sums of a group's buckets, so no task holds a whole group. The
    frame is scanned twice: hand in a stored one.
    """
    cut = df.withColumn("__bucket", F.least(F.floor(F.col(unit) * F.col(buckets)).cast("long"),
                                            F.col(buckets) - 1))
    sums = (cut.groupBy(group, "__bucket").agg(F.sum(value).alias("__sum"))
               .withColumn("__offset", F.coalesce(F.sum("__sum").over(
                   Window.partitionBy(group).orderBy("__bucket")
                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .select(group, "__bucket", "__offset"))
    inside = Window.partitionBy(group, "__bucket").orderBy(*order)
    before = F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return (cut.withColumn("__before", F.coalesce(before, F.lit(0)))
               .join(sums, [group, "__bucket"])
               .withColumn(out, F.col("__before") + F.col("__offset"))
               .drop("__bucket", "__before", "__offset"))
