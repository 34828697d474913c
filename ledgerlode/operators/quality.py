"""Data quality: one-scan profiles, referential checks, the fail-closed gate, run-log rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlode.functions.exprs import any_null, as_timestamp, col
from ledgerlode.operators.rows import existing
from ledgerlode.schemas import DQ_SUMMARY_SCHEMA, RUN_LOG_SCHEMA

# Gate thresholds.
NULL_RATE_LIMIT = 0.02
ORPHAN_RATE_LIMIT = 0.001


class DataQualityError(RuntimeError):
    """Raised by the gate when a check failed."""


def _rate(part: Column, total: Column) -> Column:
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))


def dq_profile(df: DataFrame, table: str, keys: Sequence[str],
               not_null: Sequence[str] = ()) -> DataFrame:
    """Standard suite as one row: total rows, rows with a NULL key, duplicated key groups, NULL rate
    per column, and whether it passed (keys present and unique; NULL rates only inform).

    One scan and one shuffle: rows are counted per key with a map-side combine, and everything else is
    a sum over those counts.
    """
    keys = list(keys)
    columns = existing(df, not_null)
    null_counts = [F.count_if(col(c).isNull()).alias(f"__null{i}") for i, c in enumerate(columns)]
    total, zero = F.sum("__n"), F.lit(0).cast("long")
    rates = [F.lit(c) for c in columns]
    totals = F.coalesce(total, zero)
    entries: list[Column] = []
    for i, name in enumerate(rates):
        entries += [name, _rate(F.coalesce(F.sum(f"__null{i}"), zero), totals)]
    null_rates = (F.create_map(*entries) if entries
                  else F.from_json(F.lit("{}"), "map<string,double>"))
    counted = F.count(F.lit(1)).alias("__n")
    if keys:
        groups = df.groupBy(*[col(k) for k in keys]).agg(counted, *null_counts)
        null_keys = F.coalesce(F.sum(F.when(any_null(keys), F.col("__n"))), zero)
        doubled = F.count_if(F.col("__n") > 1)
    else:
        groups = df.agg(counted, *null_counts)
        null_keys = doubled = zero
    one = groups.agg(totals.alias("total_rows"), null_keys.alias("null_pk_rows"),
                     doubled.alias("duplicate_pk_groups"), null_rates.alias("null_rates"))
    passed = (F.col("null_pk_rows") == 0) & (F.col("duplicate_pk_groups") == 0)
    return one.select(F.lit(table).alias("table_name"), "*", passed.alias("passed"))


def null_rates(df: DataFrame, columns: Sequence[str], limit: float = NULL_RATE_LIMIT) -> DataFrame:
    """One row per column: NULL count, NULL rate and whether the rate is within ``limit``."""
    columns = existing(df, columns)
    counts = df.agg(F.count(F.lit(1)).alias("total"),
                    *[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_rows"))
                      for i, c in enumerate(columns)])
    rows = counts.select("total", F.explode(pairs).alias("p"))
    rate = _rate(F.col("p.null_rows"), F.col("total"))
    return rows.select("p.column_name", F.col("total").alias("total_rows"), "p.null_rows",
                       rate.alias("null_rate"), (rate <= F.lit(limit)).alias("passed"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1"))


def has_repeats(df: DataFrame) -> bool:
    """Whether rows may repeat each other: false only when all differ. A count over one hash per row; the rows stay
    where they are."""
    hashes = df.select(F.xxhash64(*[col(c) for c in df.columns]).alias("h"))
    return not hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def key_tests(df: DataFrame, key: str) -> DataFrame:
    """Not-null and uniqueness test of one key column, as one row."""
    groups = df.groupBy(col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
        F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("duplicate_keys"),
    ).select(F.lit(key).alias("key_column"), "*",
             ((F.col("null_rows") == 0) & (F.col("duplicate_keys") == 0)).alias("passed"))


def orphan_checks(fact: DataFrame, fact_table: str,
                  references: Sequence[tuple[str, str]],
                  limit: float = ORPHAN_RATE_LIMIT) -> DataFrame:
    """Unresolved foreign keys of a fact, one row per ``(key column, dimension)``, in one scan."""
    counts = fact.agg(F.count(F.lit(1)).alias("total"),
                      *[F.count_if(col(fk).isNull()).alias(f"n{i}")
                        for i, (fk, _) in enumerate(references)])
    pairs = F.array(*[
        F.struct(F.lit(fk).alias("fk_column"), F.lit(dim).alias("dim_table"),
                 F.col(f"n{i}").alias("orphan_rows"))
        for i, (fk, dim) in enumerate(references)])
    rows = counts.select("total", F.explode(pairs).alias("p"))
    rate = _rate(F.col("p.orphan_rows"), F.col("total"))
    return rows.select(
        F.lit("REFERENTIAL_INTEGRITY").alias("check_type"), F.lit(fact_table).alias("fact_table"),
        "p.fk_column", "p.dim_table", F.col("total").alias("total_rows"), "p.orphan_rows",
        rate.alias("orphan_rate"), F.lit(float(limit)).alias("threshold"),
        (rate <= F.lit(float(limit))).alias("passed"))


def null_checks(fact: DataFrame, fact_table: str, columns: Sequence[str],
                limit: float = NULL_RATE_LIMIT) -> DataFrame:
    """NULL rates as rows of the same shape, one per column, so that one gate reduces both kinds."""
    rates = null_rates(fact, columns, limit)
    return rates.select(
        F.lit("NULL_RATE").alias("check_type"), F.lit(fact_table).alias("fact_table"),
        F.col("column_name").alias("fk_column"), F.lit(None).cast("string").alias("dim_table"), "total_rows",
        F.col("null_rows").alias("orphan_rows"), F.col("null_rate").alias("orphan_rate"),
        F.lit(float(limit)).alias("threshold"), "passed")


def missing_parents(child: DataFrame, parent: DataFrame, child_key: str,
                    parent_key: str) -> DataFrame:
    """Referential check against the parent itself: child rows whose key has no parent, NULL keys
    apart. Child rows are counted per key first, so the anti join moves one row per key."""
    counts = child.groupBy(col(child_key).alias("__key")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(col(parent_key).alias("__key")).distinct()
    lost = counts.where("__key is not null").join(known, "__key", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"), F.lit(0).cast("long").alias("null_key_rows"),
        F.lit(0).cast("long").alias("total_rows"))
    seen = counts.agg(
        F.lit(0).cast("long").alias("orphan_rows"), F.lit(0).cast("long").alias("orphan_keys"),
        F.coalesce(F.sum(F.when(F.col("__key").isNull(), F.col("n"))), F.lit(0))
         .alias("null_key_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"))
    names = ["total_rows", "null_key_rows", "orphan_rows", "orphan_keys"]
    return lost.unionByName(seen).agg(*[F.sum(n).alias(n) for n in names])


def union_checks(checks: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def summary_rows(checks: DataFrame, batch_id: str,
                 validated_at: str | dt.datetime | Column) -> DataFrame:
    """Check rows as they are appended to the validation summary table."""
    stamped = checks.withColumns({"batch_id": F.lit(batch_id),
                                  "validation_timestamp": as_timestamp(validated_at)})
    return stamped.select(*DQ_SUMMARY_SCHEMA.fieldNames())


def gate_result(checks: DataFrame) -> DataFrame:
    """One row: number of checks, number failed, and the AND over all results."""
    return checks.agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.coalesce(F.col("passed"), F.lit(False))).alias("n_failed"),
        F.coalesce(F.bool_and(F.coalesce(F.col("passed"), F.lit(False))), F.lit(True))
         .alias("all_passed"))


def failed_checks(checks: DataFrame) -> DataFrame:
    """The failed checks, each as one JSON text in ``check``."""
    told = [c for c in ("check_type", "fact_table", "fk_column", "orphan_rows", "total_rows") if c in checks.columns]
    return (checks.where(~F.coalesce(F.col("passed"), F.lit(False)))
                  .select(F.to_json(F.struct(*told)).alias("check")))


def dq_gate(checks: DataFrame) -> None:
    """Raise when a check failed, so that nothing after the gate runs. The error names the failed checks."""
    result = gate_result(checks).first()
    if not result.all_passed:
        failed = sorted(r.check for r in failed_checks(checks).collect())        # a few per fact
        raise DataQualityError(f"{result.n_failed} of {result.n_checks} checks failed: [{', '.join(failed)}]")


def run_log(spark: SparkSession, events: Iterable[dict]) -> DataFrame:
    """Run-log rows for a handful of driver-side events (one per table and step)."""
    rows = []
    for e in events:
        start, end = e.get("start_time"), e.get("end_time")
        duration = (end - start).total_seconds() if start and end else 0.0
        row = {**e, "duration_seconds": duration, "log_id": "_".join(
            str(e[k]) for k in ("notebook_name", "table_name", "batch_id", "status"))}
        rows.append(tuple(row.get(name) for name in RUN_LOG_SCHEMA.fieldNames()))
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)
