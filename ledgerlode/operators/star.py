"""Star schema: calendar, current-key lookups, fact key resolution, revenue pre-aggregation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlode.functions.exprs import col, date_key
from ledgerlode.operators.scd import current_versions

# The default bounds of the calendar.
CALENDAR_START = "2015-01-01"
CALENDAR_END = "2030-12-31"
#: A side of a join with more rows is not broadcast.
BROADCAST_ROWS = 50_000


def dim_date(spark: SparkSession, start: str | dt.date = CALENDAR_START,
             end: str | dt.date = CALENDAR_END) -> DataFrame:
    """Calendar dimension, one row per day of the closed range."""
    days = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last"))
    return calendar_of(days)


def calendar_of(bounds: DataFrame) -> DataFrame:
    """Calendar for a one-row frame with the columns ``first`` and ``last``, e.g. an aggregate."""
    day = F.col("calendar_date")
    span = F.when(F.col("first") <= F.col("last"),
                  F.sequence("first", "last", F.expr("interval 1 day")))
    days = bounds.select(F.explode(span).alias("calendar_date"))
    return days.select(
        date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.concat(F.lit("FY"), F.year(day).cast("string"),
                 F.lit("Q"), F.quarter(day).cast("string")).alias("fca_reporting_quarter"),
    )


def current_lookup(dim: DataFrame, natural_key: str | Sequence[str], sk: str) -> DataFrame:
    """Natural key to surrogate key, current versions only."""
    keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    return current_versions(dim).select(*keys, sk)


def joined_by_rows(side: DataFrame, n_rows: int) -> DataFrame:
    """A side of a join that is not broadcast where it has many rows. The optimizer goes by the bytes of the files, which
    are compressed: rows of ten times that size would then pass through the driver, once per join."""
    return side.hint("merge") if n_rows > BROADCAST_ROWS else side


def resolve_fact(events: DataFrame, lookups: Sequence[tuple[DataFrame, str]],
                 columns: Sequence[str], calendar: DataFrame | None = None,
                 date_column: str | None = None) -> DataFrame:
    """Fact rows with dimension keys in place of natural keys.

    Each lookup is ``(frame, natural key)``; an unmatched key gives NULL. The calendar is broadcast: it
    holds one row per day whatever the data. The lookups are left to the optimizer, which broadcasts a
    side only below its size threshold and otherwise splits skewed partitions of the fact side (AQE); give those read
    from files through ``joined_by_rows``.
    """
    fact = events
    for lookup, key in lookups:
        fact = fact.join(lookup, key, "left")
    if date_column is not None:
        days = calendar.select(F.col("date_sk"), F.col("calendar_date").alias("__day"))
        fact = fact.join(F.broadcast(days), col(date_column).cast("date") == F.col("__day"), "left")
    return fact.select(*columns)


def fact_revenue(interest: DataFrame, fees: DataFrame, accounts: DataFrame | None, by: str = "account",
                 key: str = "account_id") -> DataFrame:
    """Interest and fee revenue per account, per account and month, or, for reports that ask for no account, per
    ``calendar_month`` alone. Without ``accounts`` no surrogate key is looked up.

    Both sides are aggregated before they meet, so the outer join sees one row per account (and month)
    from each side, and rows with only one kind of revenue stay.
    """
    grains = {"account": [key], "month": [key, "revenue_month"], "calendar_month": ["revenue_month"]}
    if by not in grains:
        raise ValueError(f"unknown grain: {by!r}")
    grain = grains[by]

    def per_grain(df: DataFrame, date: str, amount: str, name: str) -> DataFrame:
        if "revenue_month" in grain:
            df = df.withColumn("revenue_month", F.trunc(date, "MM"))
        return df.groupBy(*grain).agg(F.sum(amount).cast("decimal(18,2)").alias(name))

    earned = per_grain(interest, "charge_date", "interest_amount", "total_interest_revenue")
    charged = per_grain(fees, "fee_date", "fee_amount", "total_fee_revenue")
    filled = {
        c: F.coalesce(F.col(c), F.lit(0).cast("decimal(18,2)"))
        for c in ("total_interest_revenue", "total_fee_revenue")
    }
    both = earned.join(charged, grain, "outer")
    if accounts is not None and key in grain:
        both = both.join(accounts, key, "left")
    return (both.withColumns(filled)
                  .withColumn("total_revenue", _total("total_interest_revenue", "total_fee_revenue")))


def _total(*names: str) -> Column:
    return sum((F.col(n) for n in names[1:]), F.col(names[0])).cast("decimal(18,2)")


def snowflake(child: DataFrame, parent: DataFrame, natural_key: str,
              attributes: Sequence[str], prefix: str = "") -> DataFrame:
    """Dimension to parent dimension on the natural key. Only the parent's current versions join, else
    every child row would repeat once per parent version."""
    right = current_versions(parent).select(
        natural_key, *[col(a).alias(prefix + a) for a in attributes])
    return child.join(right, natural_key, "left")
