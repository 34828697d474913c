"""Readers and writers. Every path may be on any Hadoop-compatible storage."""

from __future__ import annotations

import atexit
import datetime as dt
import tempfile
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import lru_cache, reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ledgerlode.functions.exprs import col

TEXT_FORMATS = ("csv", "json", "xml")
FORMATS = ("parquet", "orc", "delta", "jdbc", "table", *TEXT_FORMATS)
#: What the layers' columnar files are compressed with; digests in text halve, which the usual codec leaves as they are.
CODEC = "zstd"
#: At its quickest, which stores such digests no larger than the default level does, in well under half of the time.
ZSTD_LEVEL = {"parquet.compression.codec.zstd.level": "1"}
#: Row groups are small, and sizes are looked at from the first row on.
WIDE_ROWS = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1",
             "parquet.page.size.row.check.min": "1"}
# Layout of a landing partition.
LANDING_LEVELS = ("ingestion_date", "batch_id")


@lru_cache(maxsize=1)
def _local_root() -> str:
    """One folder per driver process in local mode, gone when the process ends."""
    folder = tempfile.TemporaryDirectory(prefix="ledgerlode-")
    atexit.register(folder.cleanup)
    return folder.name


def shared_root(spark: SparkSession, name: str) -> str:
    """A path, not yet there, under the shared directory the cluster names in ``spark.checkpoint.dir``.
    Where that is unset a session in local mode, as in tests, gets a directory of its own; on a cluster
    there is no folder that every machine sees, so it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all machines share")
        base = _local_root()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4()}"


def stored(df: DataFrame, name: str, path: str | None = None, codec: str | None = None, wide: bool = False) -> DataFrame:
    """The frame written once to the shared folder and read back. Use it where several scans follow:
    it cuts the lineage, survives lost executors, and the scans prune columns. Give the ``path`` to be
    able to ``discard`` the files after use, a ``codec`` where the session's compresses too little, and say where rows
    may be ``wide``, so that few of them are held at a time when they are written and read."""
    path = path or shared_root(df.sparkSession, name)
    options = (ZSTD_LEVEL if codec == CODEC else {}) | (WIDE_ROWS if wide else {})
    df.write.options(**options).parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> bool:
    """Delete stored files that nothing reads any more."""
    return _delete(spark, path)


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a path; empty when it does not exist."""
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def touch(spark: SparkSession, path: str) -> None:
    """An empty marker file."""
    fs, hadoop_path = _filesystem(spark, path)
    fs.create(hadoop_path, True).close()


def ensure_directory(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _filesystem(spark, path)
    fs.mkdirs(hadoop_path)


def read_source(spark: SparkSession, fmt: str, location: str | None = None,
                schema: T.StructType | None = None,
                options: Mapping[str, str] | None = None) -> DataFrame:
    """Read one dataset. Text formats need a schema (nothing is inferred); ``table`` reads a catalog
    table; ``jdbc`` takes its ``url`` and ``dbtable`` from the options, and for a parallel read
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``."""
    options = dict(options or {})
    if fmt not in FORMATS:
        raise ValueError(f"unknown source format: {fmt!r}")
    if fmt == "table":
        return spark.table(location)
    if fmt in TEXT_FORMATS and schema is None:
        raise ValueError(f"format {fmt} needs an explicit schema")
    if fmt == "jdbc" and not {"url", "dbtable"} <= options.keys():
        raise ValueError("format jdbc needs the options url and dbtable")
    if fmt == "csv":
        options.setdefault("header", "true")
    if fmt == "xml":
        options.setdefault("rowTag", "row")
    if fmt in TEXT_FORMATS:
        options.setdefault("mode", "FAILFAST")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None and fmt != "jdbc":
        reader = reader.schema(schema)
    return reader.load(location) if location is not None else reader.load()


def read_first_existing(spark: SparkSession, fmt: str, locations: Sequence[str],
                        schema: T.StructType | None = None,
                        options: Mapping[str, str] | None = None) -> DataFrame:
    """Read the first location that exists; the last one is read, and fails, if none does."""
    exists = table_exists if fmt == "table" else path_exists
    found = next((loc for loc in locations if exists(spark, loc)), locations[-1])
    return read_source(spark, fmt, found, schema, options)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def landing_path(root: str, source_system: str, table: str, ingestion_date: str,
                 batch_id: str) -> str:
    values = zip(LANDING_LEVELS, (ingestion_date, batch_id))
    return "/".join([root, source_system, table, *[f"{k}={v}" for k, v in values]])


def read_landing(spark: SparkSession, root: str, source_system: str, table: str,
                 ingestion_date: str, batch_id: str, fmt: str = "parquet") -> DataFrame:
    """One landing partition, read by its path. The partition values are not data columns."""
    path = landing_path(root, source_system, table, ingestion_date, batch_id)
    return read_source(spark, fmt, path)


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame with a row counter that fills while it is written; no second scan."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def observed(seen: Observation) -> int:
    """The count of ``counted``. A plan that adaptive execution finds empty reports no metrics: no rows."""
    try:
        return int(seen.get.get("n", 0) or 0)
    except Py4JJavaError as error:
        if "AssertionError" in error.java_exception.toString():
            return 0
        raise


def overwrite_path(df: DataFrame, path: str, fmt: str = "parquet",
                   partition_by: Sequence[str] = ()) -> None:
    """Replace a dataset, its schema included. With partition columns, rows are first brought together
    by them; the rebalance splits a partition value that holds too much for one task."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if fmt in ("parquet", "orc"):
        writer = writer.option("compression", CODEC).options(**ZSTD_LEVEL)
    writer.partitionBy(*partition_by).save(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       fmt: str = "parquet") -> None:
    """Write partitions and leave the others alone, so that loading a batch again replaces it."""
    (df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).save(path))


def append_path(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """All batches of a table partitioned by ``batch_id``, with the columns of every batch. A given
    schema saves the scan of all footers. The batch id stays text."""
    reader = spark.read.format(fmt)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    df = reader.load(path)
    return df.withColumn("batch_id", F.col("batch_id").cast("string"))


def compact(df: DataFrame, keys: Sequence[str], files: int) -> DataFrame:
    """Rows arranged for a rewrite into ``files`` files clustered by ``keys``.

    A hash of the row breaks ties in the range partitioning, so a key value that holds a third of the
    rows is spread over a third of the files.
    """
    spread = F.xxhash64(*[col(c) for c in df.columns])
    return (df.withColumn("__spread", spread)
              .repartitionByRange(files, *[col(k) for k in keys], "__spread")
              .sortWithinPartitions(*[col(k) for k in keys])
              .drop("__spread"))


FILE_BYTES = 128 << 20
#: Rows to a file of a format that one task reads whole.
WHOLE_FILE_ROWS = 100_000


def file_count(df: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """How many files of about ``file_bytes`` the stored files that a frame reads make."""
    spark = df.sparkSession
    total = 0
    for name in df.inputFiles():
        fs, path = _filesystem(spark, name)
        total += fs.getFileStatus(path).getLen()
    return max(1, -(-total // file_bytes))


def retained(df: DataFrame, date_column: str, as_of: str, days: int) -> DataFrame:
    """Rows within the retention window that ends at ``as_of``."""
    return df.where(F.col(date_column) >= F.date_sub(F.lit(as_of).cast("date"), days))


def expired_partitions(spark: SparkSession, path: str, as_of: str, days: int) -> list[str]:
    """Directories ``ingestion_date=…`` of a landing dataset that are older than the window. Only
    directory names are read."""
    level = LANDING_LEVELS[0] + "="
    oldest = dt.date.fromisoformat(as_of) - dt.timedelta(days=days)
    return [f"{path}/{n}" for n in child_names(spark, path)
            if n.startswith(level) and dt.date.fromisoformat(n[len(level):]) < oldest]


def drop_partitions(spark: SparkSession, paths: Iterable[str]) -> int:
    """Delete partition directories; returns how many existed."""
    return reduce(lambda n, p: n + int(_delete(spark, p)), paths, 0)


def _delete(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.delete(hadoop_path, True)
