"""The schemas of a bronze table's batches. A batch keeps the types it was stored with; readers get the widest."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlode.operators.evolve import cast_to, widened
from ledgerlode.sources import files

_RECORDS = "_schemas"          # beside the batches; readers of the table pass over names with an underscore


def record_schema(spark: SparkSession, table: str, batch_id: str, schema: T.StructType) -> None:
    """Note the business columns and types that a batch was stored with, in one row."""
    rows = spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1)
    files.overwrite_path(rows, f"{table}/{_RECORDS}/batch_id={batch_id}")


def batch_schemas(spark: SparkSession, table: str) -> dict[str, list[str]]:
    """The recorded schemas, as JSON, with the batches of each, oldest first."""
    root = f"{table}/{_RECORDS}"
    if not files.child_names(spark, root):
        return {}
    records = (spark.read.schema("schema string, batch_id string").parquet(root).groupBy("schema")
                    .agg(F.sort_array(F.collect_list("batch_id")).alias("batches")))
    return {r.schema: r.batches for r in sorted(records.collect(), key=lambda r: r.batches)}   # a few schemas


def known_schema(spark: SparkSession, table: str, leave_out: str | None = None) -> T.StructType | None:
    """The business columns of all batches but one, each in the widest type it has had."""
    kept = [T.StructType.fromJson(json.loads(text)) for text, batches in batch_schemas(spark, table).items()
            if set(batches) != {leave_out}]
    return reduce(widened, kept) if kept else None


def read_bronze(spark: SparkSession, table: str, fmt: str = "parquet") -> DataFrame:
    """All batches with the columns of every one, each column in the widest type; ``batch_id`` is text. Batches of one
    schema are read together, and no footers are merged."""
    groups = batch_schemas(spark, table)
    wide = reduce(widened, [T.StructType.fromJson(json.loads(text)) for text in groups])
    parts = []
    for batches in groups.values():
        paths = [f"{table}/batch_id={b}" for b in batches]
        stored = spark.read.format(fmt).option("basePath", table).load(paths)
        audit = [f for f in stored.schema if f.name not in wide.names and f.name != "batch_id"]
        parts.append(cast_to(stored, T.StructType([*wide.fields, *audit, T.StructField("batch_id", T.StringType())])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
