"""Row operators of the bronze and silver layers: stamping, casting, cleansing, splitting, masking."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlode.functions.exprs import (
    all_present, any_null, as_timestamp, col, row_digest, tail_mask, token,
)
from ledgerlode.operators.evolve import fit, keeps_value
from ledgerlode.schemas import AUDIT_COLUMNS, SILVER_STAMP


def stamp_audit(df: DataFrame, source_system: str, batch_id: str | Column, pipeline_name: str,
                load_ts: str | dt.datetime | Column, file_name: str | Column,
                digest_mode: str = "compat") -> DataFrame:
    """Add the seven audit columns; the record hash covers every column that was there before."""
    business = [c for c in df.columns if c not in AUDIT_COLUMNS]

    def text(value: str | Column) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    return df.withColumns({
        "source_system": F.lit(source_system),
        "batch_id": text(batch_id),
        "pipeline_name": F.lit(pipeline_name),
        "load_timestamp": as_timestamp(load_ts),
        "file_name": text(file_name),
        "ingestion_timestamp": as_timestamp(load_ts),
        "record_hash": row_digest(business, digest_mode),
    })


def business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in AUDIT_COLUMNS]


def drop_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)


def stamp_silver(df: DataFrame, load_ts: str | dt.datetime | Column) -> DataFrame:
    return df.withColumn(SILVER_STAMP, as_timestamp(load_ts))


def of_batch(df: DataFrame, batch_id: str) -> DataFrame:
    """Rows of one batch. On a table partitioned by ``batch_id`` only that partition is read."""
    return df.where(F.col("batch_id") == F.lit(batch_id))


def existing(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The given columns that the frame has, in the given order."""
    present = set(df.columns)
    return [c for c in columns if c in present]


def enforce_schema(df: DataFrame, target: T.StructType, on_error: str = "raise"):
    """Cast shared columns to the target types; other columns pass through. A value that the cast would change, such as
    5.75 as a whole number, does not fit.

    ``raise`` fails the job at the first value that does not fit and returns one frame.
    ``quarantine`` returns ``(good, bad)``: ``bad`` keeps the rows as they came.
    """
    if on_error == "quarantine":
        good, bad = fit(df, target)
        return good, bad.drop("misfits")
    if on_error != "raise":
        raise ValueError(f"unknown on_error: {on_error!r}")
    wanted = {f.name: f.dataType for f in target.fields}

    def cast(field: T.StructField) -> Column:
        name, kind = field.name, wanted.get(field.name, field.dataType)
        if kind == field.dataType:
            return col(name)
        held = col(name).try_cast(kind)
        failure = F.raise_error(F.concat(F.lit(f"{name} does not hold "), col(name).cast("string")))
        kept = F.when(keeps_value(col(name), field.dataType, kind), held)
        if isinstance(field.dataType, T.StringType) or not isinstance(kind, T.DecimalType):
            kept = kept.when(held.isNull(), col(name).cast(kind))
        return kept.otherwise(failure.cast(kind)).alias(name)

    return df.select([cast(f) for f in df.schema.fields])


def standardise_text(df: DataFrame, upper: Iterable[str] = ()) -> DataFrame:
    """Trim every string column, and upper-case the listed ones, in one projection."""
    upper = set(upper)
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    changes = {c: F.upper(F.trim(col(c))) if c in upper else F.trim(col(c)) for c in strings}
    return df.withColumns(changes) if changes else df


def split_quarantine(df: DataFrame, keys: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: rows with every key present, and rows missing at least one key."""
    keys = list(keys)
    return df.where(all_present(keys)), df.where(any_null(keys))


def dedup_by_hash(df: DataFrame, hash_column: str = "record_hash") -> DataFrame:
    """One row per record hash, when the frame has it.

    ``dropDuplicates`` aggregates before the shuffle, so a third of all rows being copies of one
    record reaches the reducers as one row per map task.
    """
    return df.dropDuplicates([hash_column]) if hash_column in df.columns else df


def dedup_business(df: DataFrame) -> DataFrame:
    """Distinct business rows. The audit columns go first: ``distinct`` then needs no per-column
    aggregate and plans as two hash aggregates with a map-side combine."""
    return drop_audit(df).distinct()


def cleanse(df: DataFrame, keys: Iterable[str], upper: Iterable[str] = ()) -> DataFrame:
    """Trim, drop repeated business rows, drop rows without a key; the key filter runs first."""
    good, _ = split_quarantine(df, keys)
    return dedup_business(standardise_text(good, upper))


def mask_columns(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Mask sensitive columns. Rules: ``tail`` keeps four characters, ``token`` is a hash prefix,
    ``null`` removes the value, ``shape`` replaces letters and digits by class."""
    makers = {
        "tail": tail_mask,
        "token": token,
        "null": lambda c: F.lit(None).cast("string"),
        "shape": lambda c: F.mask(c),
    }
    return df.withColumns({c: makers[rule](col(c)) for c, rule in rules.items()})


def entitled_rows(df: DataFrame, entitlement: DataFrame, keys: list[str], role_column: str,
                  role: str) -> DataFrame:
    """Rows a role may see: semi join to the entitlement rows of that role."""
    allowed = entitlement.where(F.col(role_column) == F.lit(role)).select(*keys)
    return df.join(allowed, keys, "left_semi")


def union_batches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column missing from a batch is NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def split_channel(df: DataFrame, column: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Two feeds from one: rows of the channel, and every other row (NULL included)."""
    is_channel = F.coalesce(F.col(column) == F.lit(value), F.lit(False))
    return df.where(is_channel), df.where(~is_channel)
