"""The queries of this package, and the SQL that some of them must agree with."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import lru_cache, wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


@lru_cache(maxsize=1)
def _archive() -> str:
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="ledgerlode-code-")
    target = Path(folder) / "ledgerlode.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    return str(target)


def ship(spark: SparkSession) -> None:
    """Send the library's code to the executors, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if not any(f.endswith("/ledgerlode.zip") for f in context.listFiles):
        context.addPyFile(_archive())


def query(sql: str | None = None):
    """Register the function under its own name."""
    def add(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return run
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
