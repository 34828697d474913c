"""Run registered queries against their SQL in DuckDB and report differences."""

from __future__ import annotations

import datetime as dt
import sys
import tempfile
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def session(partitions: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("ledgerlode-tests")
             .config("spark.sql.shuffle.partitions", str(partitions))
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    for kind in (int, float, Decimal, dt.datetime, dt.date, str):
        if isinstance(value, kind):
            return kind.__name__
    return type(value).__name__


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple((_kind(r[i]), str(r[i])) for i in order) for r in rows])


def difference(spark, con, name: str, sf: str) -> tuple[str | None, int]:
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, sf)
    got, names = [tuple(r) for r in df.collect()], df.columns
    if name not in oracle_sql():
        return None, len(got)
    cursor = con.execute(oracle_sql()[name])
    want_names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}", len(got)
    a, b = normal(got, names), normal(want, want_names)
    if a != b:
        left, right = [r for r in a if r not in set(b)], [r for r in b if r not in set(a)]
        return f"rows {len(a)} vs {len(b)}; spark only {left[:2]}; sql only {right[:2]}", len(got)
    return None, len(got)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    from __spark_entry__ import queries
    spark, con = session(), duck(sf)
    bad = 0
    for name in only or queries():
        begun = time.time()
        try:
            problem, n = difference(spark, con, name, sf)
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} rows={n} {time.time() - begun:.1f}s "
              f"{problem or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
