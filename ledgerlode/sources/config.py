"""Table configuration: one record per table that says where it comes from and how it merges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ledgerlode.schemas import CONFIG_SCHEMA
from ledgerlode.sources.files import table_exists


@dataclass(frozen=True)
class TableConfig:
    table_name: str
    source_system: str
    layer_role: str
    primary_key: str
    scd_type: int
    natural_keys: tuple[str, ...]
    bronze_path: str
    silver_table: str
    bronze_table: str
    active_flag: bool

    @classmethod
    def of(cls, row: Row) -> TableConfig:
        values = row.asDict()
        return cls(**{**values, "natural_keys": tuple(values["natural_keys"] or ())})


def table_config(spark: SparkSession, path: str | None = None, table: str | None = None,
                 layer_role: str | None = None, active_only: bool = True) -> DataFrame:
    """Configuration from the catalog table when it exists, else from the JSON file."""
    if table is not None and table_exists(spark, table):
        df = spark.table(table)
    elif path is not None:
        df = spark.read.schema(CONFIG_SCHEMA).option("multiLine", True).json(path)
    else:
        raise ValueError("neither a configuration table nor a file was found")
    return select_config(df, layer_role, active_only)


def select_config(df: DataFrame, layer_role: str | None = None,
                  active_only: bool = True) -> DataFrame:
    if active_only:
        df = df.where(F.col("active_flag"))
    if layer_role:
        df = df.where(F.col("layer_role") == F.lit(layer_role))
    return df


def config_of(df: DataFrame, table_name: str) -> TableConfig:
    """The record of one table."""
    row = df.where(F.col("table_name") == F.lit(table_name)).first()
    if row is None:
        raise ValueError(f"no configuration for table {table_name!r}")
    return TableConfig.of(row)
