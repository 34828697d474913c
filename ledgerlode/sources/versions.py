"""Tables that are rewritten from themselves, without a transactional format.

Spark refuses to overwrite what it reads. Each write therefore goes to a new directory ``v=<n>``, which
counts once its marker file is there; a failed or half-done write is never seen and its number is used
again. One writer per table at a time.

Three layouts share this:

* plain: every version holds the whole table.
* history: ``v=<n>/is_current_flag=true`` holds the whole current state, ``…=false`` only the versions
  closed by that write. Closed history is never read or rewritten by a merge, so the cost of a batch
  follows the current rows, not the age of the table.
* partitioned: a version holds the partitions that its batch touched. The table is the newest version
  of each partition, so an upsert into a large fact rewrites the touched partitions only.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlode.operators.scd import CURRENT
from ledgerlode.sources.files import child_names, ensure_directory, path_exists, touch

MARKER = "_COMMITTED"


def _directory(root: str, number: int) -> str:
    return f"{root}/v={number:06d}"


def committed(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    numbers = [int(n[2:]) for n in child_names(spark, root) if n.startswith("v=")]
    return [n for n in numbers if path_exists(spark, f"{_directory(root, n)}/{MARKER}")]


def write_version(df: DataFrame, root: str, partition_by: str | None = None, fmt: str = "parquet",
                  touched: Iterable[str] = ()) -> int:
    """Write and commit the next version. ``touched`` names the partition directories that this version
    replaces; one that received no rows is committed empty."""
    spark = df.sparkSession
    done = committed(spark, root)
    number = done[-1] + 1 if done else 1
    target = _directory(root, number)
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(target)
    for name in touched:
        ensure_directory(spark, f"{target}/{name}")
    touch(spark, f"{target}/{MARKER}")
    return number


def _partitions(spark: SparkSession, directory: str) -> list[str]:
    return [n for n in child_names(spark, directory) if "=" in n]


def newest_partitions(spark: SparkSession, root: str) -> dict[str, str]:
    """Partition directory name to the path of its newest committed version."""
    newest: dict[str, str] = {}
    for number in committed(spark, root):
        directory = _directory(root, number)
        newest.update({n: f"{directory}/{n}" for n in _partitions(spark, directory)})
    return newest


def _has_data(spark: SparkSession, directory: str) -> bool:
    return any(not n.startswith(("_", ".")) for n in child_names(spark, directory))


def read_current(spark: SparkSession, root: str, fmt: str = "parquet",
                 only: Sequence[str] | None = None) -> DataFrame | None:
    """Newest state: the rows of a plain or partitioned table, the current rows of a history table.

    ``only`` limits a partitioned table to some partition directories, whose column comes back as text.
    None when there is nothing to read.
    """
    done = [n for n in committed(spark, root) if _has_data(spark, _directory(root, n))]
    if not done:
        return None
    directory = _directory(root, done[-1])
    names = _partitions(spark, directory)
    if not names:
        return spark.read.format(fmt).load(directory)
    column = names[0].split("=")[0]
    if column == CURRENT:
        df = spark.read.format(fmt).load(directory)
        return df.withColumn(CURRENT, F.col(CURRENT).cast("boolean")).where(CURRENT)
    newest = {n: d for n, d in newest_partitions(spark, root).items() if _has_data(spark, d)}
    wanted = [d for n, d in newest.items() if only is None or n in set(only)]
    if not wanted:
        return None
    schema = spark.read.format(fmt).load(max(newest.values())).schema   # of the newest version
    reader = spark.read.format(fmt).schema(schema.add(column, "string")).option("basePath", root)
    return reader.load(wanted).drop("v")


def read_history(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame | None:
    """Current and closed versions of a history table; the same as ``read_current`` on the others.

    Closed parts are read with the newest schema, so no footers are merged; a column that an older part
    lacks is NULL there.
    """
    current = read_current(spark, root, fmt)
    if current is None or CURRENT not in current.columns:
        return current
    parts = []
    for number in committed(spark, root):
        part = f"{_directory(root, number)}/{CURRENT}=false"
        if path_exists(spark, part):
            parts.append(part)
    if not parts:
        return current
    closed = spark.read.format(fmt).schema(current.drop(CURRENT).schema).load(parts)
    return current.unionByName(closed.withColumn(CURRENT, F.lit(False)))


def superseded(spark: SparkSession, root: str) -> list[str]:
    """Directories that no reader needs any more: replaced states and partitions, never closed history.
    Drop them once no job that started before the newest version is still running."""
    done = committed(spark, root)
    needed = set(newest_partitions(spark, root).values())
    old: list[str] = []
    for number in done[:-1]:
        directory = _directory(root, number)
        names = _partitions(spark, directory)
        if not names:
            old.append(directory)
        for name in names:
            path = f"{directory}/{name}"
            if name != f"{CURRENT}=false" and path not in needed:
                old.append(path)
    return old
