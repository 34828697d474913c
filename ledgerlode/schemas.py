"""Explicit schemas: column groups, control tables and the column-naming convention of the entities."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Names and order of the added column groups and control-table columns.
AUDIT_COLUMNS = [
    "source_system", "batch_id", "pipeline_name", "load_timestamp",
    "file_name", "ingestion_timestamp", "record_hash",
]
SCD2_COLUMNS = ["effective_start_date", "effective_end_date", "is_current_flag", "row_hash"]
SILVER_STAMP = "silver_load_timestamp"


# The control tables.
CONFIG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("layer_role", T.StringType()),
    T.StructField("primary_key", T.StringType()),
    T.StructField("scd_type", T.IntegerType()),
    T.StructField("natural_keys", T.ArrayType(T.StringType())),
    T.StructField("bronze_path", T.StringType()),
    T.StructField("silver_table", T.StringType()),
    T.StructField("bronze_table", T.StringType()),
    T.StructField("active_flag", T.BooleanType()),
])
RUN_LOG_SCHEMA = T.StructType([
    T.StructField("log_id", T.StringType()),
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("notebook_name", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("error_message", T.StringType()),
])
DQ_SUMMARY_SCHEMA = T.StructType([
    T.StructField("check_type", T.StringType()),
    T.StructField("fact_table", T.StringType()),
    T.StructField("fk_column", T.StringType()),
    T.StructField("dim_table", T.StringType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("orphan_rows", T.LongType()),
    T.StructField("orphan_rate", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("validation_timestamp", T.TimestampType()),
])

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(12, 6)

# Columns whose type does not follow from their name.
_EXCEPTIONS: dict[str, T.DataType] = {
    "date_of_birth": T.DateType(),
    "alert_date": T.TimestampType(),
    "call_date": T.TimestampType(),
    "activity_date": T.TimestampType(),
    "push_notification_opt_in": T.BooleanType(),
    "decimal_places": T.IntegerType(),
    "billing_cycle_day": T.IntegerType(),
    "installments_paid": T.IntegerType(),
    "monthly_installment": MONEY,
    "apr_applied": RATE,
    "probability_of_default": RATE,
    "years_in_employment": T.DecimalType(5, 1),
}

# Tried in order: (prefixes, suffixes, type).
_NAMING: list[tuple[tuple[str, ...], tuple[str, ...], T.DataType]] = [
    (("is_",), ("_flag",), T.BooleanType()),
    ((), ("_id", "_type", "_status", "_reason", "_code"), T.StringType()),
    ((), ("_timestamp",), T.TimestampType()),
    ((), ("_date", "_period_start", "_period_end"), T.DateType()),
    (("points_", "number_of_", "days_"), ("_score", "_months", "_seconds"), T.IntegerType()),
    (("geocode_",), ("_rate", "_apr", "_percent"), RATE),
    (
        ("total_",),
        ("_amount", "_balance", "_fee", "_limit", "_income", "_debt", "_due"),
        MONEY,
    ),
]


def pinned_type(column: str) -> T.DataType:
    """Type of an entity column, decided by its name alone so that no source is ever inferred."""
    if column in _EXCEPTIONS:
        return _EXCEPTIONS[column]
    for prefixes, suffixes, data_type in _NAMING:
        if column.startswith(prefixes) or column.endswith(suffixes):
            return data_type
    return T.StringType()


def entity_schema(columns: Iterable[str], primary_key: str | None = None) -> T.StructType:
    """Pinned schema for a list of entity columns; the primary key is declared not null."""
    return T.StructType(
        [T.StructField(c, pinned_type(c), nullable=c != primary_key) for c in columns]
    )
