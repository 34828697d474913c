"""Queries over catalog tables, merges into buckets, kept surrogate keys, Z-order, growing schemas and expiry."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlode.catalogue import views
from ledgerlode.catalogue.registry import query
from ledgerlode.catalogue.views import FIRST, SECOND, TRACKED, money, ntz, party_id, sql, table
from ledgerlode.operators import rows, zorder
from ledgerlode.plans import incremental
from ledgerlode.plans.jobs import Lake, expire_landing, land, load_bronze
from ledgerlode.sources import bronze, files, keymap, tables
from ledgerlode.sources.config import TableConfig

THIRD = "2002-01-01 00:00:00"
MOVED = 5                     # the third delivery has the customers of the first nations


@contextmanager
def _database(spark: SparkSession) -> Iterator[str]:
    """A database in the shared folder, dropped at the end with its tables."""
    name = f"run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{files.shared_root(spark, 'tables')}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


@query(sql(f"""SELECT * FROM (
    SELECT v.* REPLACE (CASE WHEN v.is_current_flag AND b.party_id IS NOT NULL THEN TIMESTAMP '{THIRD}'
        ELSE v.effective_end_date END AS effective_end_date, v.is_current_flag AND b.party_id IS NULL AS is_current_flag)
      FROM versions v LEFT JOIN moved b USING (party_id)
    UNION ALL SELECT *, TIMESTAMP '{THIRD}', NULL, TRUE, {views.DIGEST} FROM moved)""", "versions").replace(
        "\nSELECT * FROM (", f""", moved AS (SELECT * REPLACE ('MOVED' AS segment) FROM parties1 WHERE nation_key < {MOVED})
    SELECT * FROM (""", 1))
def scd2_incremental(spark, sf):
    """Three deliveries merged into a bucketed table, the last one twice."""
    first, second = views.parties_first(spark, sf), views.parties_second(spark, sf)
    third = first.where(F.col("nation_key") < MOVED).withColumn("segment", F.lit("MOVED"))
    deliveries = [("b1", first, FIRST), ("b2", second, SECOND), ("b3", third, THIRD), ("b3", third, THIRD)]
    with _database(spark) as name:
        target = incremental.Target(f"{name}.party", ("party_id",), 8)
        for batch_id, df, at in deliveries:
            incremental.merge_type2(target, df, TRACKED, ntz(at), batch_id, "compat")
        return files.stored(incremental.read_history(spark, target), "history")


@query("""SELECT 'S' || s_suppkey AS merchant_id, load,
    CASE WHEN s_suppkey % 2 = 1 THEN row_number() OVER (PARTITION BY load ORDER BY s_suppkey % 2 = 0, 'S' || s_suppkey)
      ELSE count(*) FILTER (WHERE s_suppkey % 2 = 1) OVER (PARTITION BY load)
        + row_number() OVER (PARTITION BY load ORDER BY s_suppkey % 2 = 1, 'S' || s_suppkey) END::BIGINT AS merchant_sk
    FROM supplier, (VALUES (1), (2)) t(load) WHERE load = 2 OR s_suppkey % 2 = 1""")
def sk_stable(spark, sf):
    """Every second merchant, then all: those of the first load keep their keys."""
    merchants = table(spark, sf, "supplier").select("s_suppkey", party_id("S", "s_suppkey").alias("merchant_id"))
    with _database(spark) as name:
        loads = []
        for load, df in ((1, merchants.where("s_suppkey % 2 = 1")), (2, merchants)):
            keyed = keymap.assign_keys(df, ["merchant_id"], "merchant_sk", f"{name}.merchant_keys", 4)
            loads.append(files.stored(keyed.select("merchant_id", F.lit(load).alias("load"), "merchant_sk"), "keyed"))
        return rows.union_batches(*loads)


_KEYS, _BITS, _ZONE_ROWS = ("l_suppkey", "l_partkey"), 3, 2000


def _grid(low: str, high: str) -> str:
    return f"[{low} + (({high} - {low}) * k) // {1 << _BITS} FOR k IN range(1, {1 << _BITS})]"


_BIT = " + ".join(f"(((r{i} >> {b}) & 1) << {b * 2 + i})" for b in range(_BITS) for i in range(2))


@query(f"""WITH edges AS (SELECT min(l_suppkey) AS a, max(l_suppkey) AS b, min(l_partkey) AS c, max(l_partkey) AS d FROM lineitem),
    ranked AS (SELECT l_suppkey, l_partkey, len([x FOR x IN {_grid('a', 'b')} IF x <= l_suppkey]) AS r0,
      len([x FOR x IN {_grid('c', 'd')} IF x <= l_partkey]) AS r1 FROM lineitem, edges),
    celled AS (SELECT *, {_BIT} AS cell FROM ranked),
    zones AS (SELECT cell, (sum(n) OVER (ORDER BY cell) - n) // {_ZONE_ROWS} AS zone FROM (
      SELECT cell, count(*) AS n FROM celled GROUP BY cell)),
    map AS (SELECT zone, count(*) AS n, min(l_suppkey) AS sa, max(l_suppkey) AS sb, min(l_partkey) AS pa,
      max(l_partkey) AS pb FROM celled JOIN zones USING (cell) GROUP BY zone),
    probes AS (SELECT 'l_suppkey' AS key, unnest({_grid('a', 'b')}) AS v FROM edges
      UNION ALL SELECT 'l_partkey', unnest({_grid('c', 'd')}) FROM edges)
    SELECT key, v::VARCHAR AS probe, count(*) FILTER (CASE WHEN key = 'l_suppkey' THEN v BETWEEN sa AND sb
      ELSE v BETWEEN pa AND pb END) AS n_zones, count(*) AS total, sum(n)::BIGINT AS n_rows
    FROM probes, map GROUP BY key, v""")
def zorder_cluster(spark, sf):
    """Lines written in Z-order of two keys: how many zones a value of one key can lie in, by the zones' min and max."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_KEYS)
    edges = lines.agg(*[f(k).alias(f"{n}_{k}") for k in _KEYS for f, n in ((F.min, "low"), (F.max, "high"))]).first()
    steps = 1 << _BITS
    grid = {k: [low + (high - low) * i // steps for i in range(1, steps)]
            for k in _KEYS for low, high in [(edges[f"low_{k}"], edges[f"high_{k}"])]}
    path = files.shared_root(spark, "zorder")
    files.overwrite_path(zorder.clustered(lines, _KEYS, _ZONE_ROWS, _BITS, grid), path, partition_by=[zorder.ZONE])
    zones = files.stored(zorder.zone_map(spark.read.parquet(path), _KEYS), "zone-map")
    n_rows = zones.agg(F.sum("n_rows")).first()[0]
    return zorder.zones_to_read(zones, grid).withColumn("n_rows", F.lit(n_rows).cast("long"))


@query("""SELECT 'bronze' AS side, batch, flag, count(*) AS n_rows, sum(amount) AS amount, count(amount) AS n_amounts FROM (
      SELECT 'b1' AS batch, NULL AS flag, CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS amount FROM lineitem WHERE l_returnflag = 'A'
      UNION ALL SELECT 'b2', l_linestatus, l_quantity + 0.5 FROM lineitem WHERE l_returnflag = 'N'
      UNION ALL SELECT 'b3', l_linestatus, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_discount <= 0.05) GROUP BY ALL
    UNION ALL SELECT 'quarantine', 'b3', l_linestatus, count(*), NULL, count(*) FROM lineitem
      WHERE l_returnflag = 'R' AND l_discount > 0.05 GROUP BY ALL""")
def bronze_evolution(spark, sf):
    """Whole numbers, then fractions and a new column, then text of which some is no number."""
    lines, amount = table(spark, sf, "lineitem"), F.col("l_quantity")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    text = F.when(F.col("l_discount") > 0.05, F.lit("n/a")).otherwise(amount.cast("string"))
    deliveries = {
        "b1": lines.where("l_returnflag = 'A'").select(*keys, amount.cast("int").alias("amount")),
        "b2": lines.where("l_returnflag = 'N'").select(*keys, (amount + 0.5).alias("amount"), F.col("l_linestatus").alias("flag")),
        "b3": lines.where("l_returnflag = 'R'").select(*keys, text.alias("amount"), F.col("l_linestatus").alias("flag"))}
    lake = Lake(spark, files.shared_root(spark, "lake"), "daily", "2001-08-02", "2001-08-02 06:00:00")
    cfg = TableConfig("line", "CORE", "FACT", "l_orderkey", 1, ("l_orderkey",), "", "silver_line", "bronze_line", True)
    for batch_id, df in deliveries.items():
        land(lake, cfg, batch_id, df)
        load_bronze(lake, cfg, batch_id)
    kept = bronze.read_bronze(spark, lake.path("bronze", cfg.bronze_table))
    refused = spark.read.parquet(f"{lake.path('control', 'bronze_quarantine_line')}/batch_id=b3")

    def counted(df: DataFrame, side: str, total) -> DataFrame:
        return df.groupBy(F.col("batch_id").alias("batch"), "flag").agg(
            F.count(F.lit(1)).alias("n_rows"), total.alias("amount"), F.count("amount").alias("n_amounts")).select(
            F.lit(side).alias("side"), "batch", "flag", "n_rows", "amount", "n_amounts")

    return counted(kept, "bronze", F.sum("amount")).unionByName(
        counted(refused.withColumn("batch_id", F.lit("b3")), "quarantine", F.lit(None).cast("double")))


@query("""SELECT step, o_orderstatus, count(*) * times AS n_rows, CAST(sum(p) * times AS DECIMAL(38,2)) AS total
    FROM (SELECT o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders),
      (VALUES ('append', 2), ('overwrite', 1)) t(step, times) GROUP BY ALL, times
    UNION ALL SELECT 'partitions', o_orderstatus, count(*), CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE
      CAST(o_totalprice AS DECIMAL(18,2)) END) AS DECIMAL(38,2)) FROM orders GROUP BY ALL
    UNION ALL SELECT 'added column', o_orderstatus, count(*), CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS DECIMAL(38,2))
      FROM orders GROUP BY ALL""".replace("GROUP BY ALL, times", "GROUP BY step, o_orderstatus, times"))
def catalog_roundtrip(spark, sf):
    """Tables of the catalog: created once, appended to, overwritten, and one partition replaced by a rerun."""
    orders = table(spark, sf, "orders").select("o_orderkey", money("o_totalprice").alias("price"), "o_orderstatus")
    redone = orders.where("o_orderstatus = 'F'").withColumns({"price": F.lit(0).cast("decimal(18,2)"), "mark": F.lit(1)})

    def totals(step: str, name: str, column: str = "price") -> DataFrame:
        found = files.read_source(spark, "table", name).groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(column).cast("decimal(38,2)").alias("total"))
        return files.stored(found.select(F.lit(step).alias("step"), "o_orderstatus", "n_rows", "total"), "totals")

    with _database(spark) as name:
        log, whole, parts = (f"{name}.{t}" for t in ("log", "whole", "parts"))
        for _ in range(2):
            tables.append_rows(orders, log)
            tables.overwrite_rows(orders, whole)
        tables.replace_rows(orders, parts, ["o_orderstatus"])
        for _ in range(2):
            tables.replace_rows(redone, parts, ["o_orderstatus"])
        return rows.union_batches(totals("append", log), totals("overwrite", whole), totals("partitions", parts),
                                  totals("added column", parts, "mark"))


_DAYS = {"F": "2001-06-01", "O": "2001-07-03", "P": "2001-08-01"}


@query(" UNION ALL ".join(
    f"""SELECT '{stage}' AS stage, DATE '{day}' AS ingestion_date, count(*) AS n_rows, {gone}::BIGINT AS n_dropped
    FROM orders WHERE o_orderstatus = '{status}'"""
    for stage, gone in (("before", 0), ("after", 1)) for status, day in _DAYS.items() if stage == "before" or status != "F"))
def landing_expiry(spark, sf):
    """Landing partitions before and after those older than the retention went."""
    cfg = TableConfig("orders", "CORE", "FACT", "o_orderkey", 1, ("o_orderkey",), "", "silver_orders", "bronze_orders", True)
    lake = Lake(spark, files.shared_root(spark, "lake"), "daily", "2001-08-02", "2001-08-02 06:00:00")
    for status, day in _DAYS.items():
        lake.ingestion_date = day
        land(lake, cfg, "b1", table(spark, sf, "orders").where(F.col("o_orderstatus") == status))

    def counts(stage: str, gone: int) -> DataFrame:
        found = spark.read.parquet(f"{lake.path('landing')}/CORE/orders").groupBy("ingestion_date").agg(
            F.count(F.lit(1)).alias("n_rows"))
        return files.stored(found.select(F.lit(stage).alias("stage"), F.col("ingestion_date").cast("date").alias("ingestion_date"),
                                         "n_rows", F.lit(gone).cast("long").alias("n_dropped")), "expiry")

    before = counts("before", 0)
    return before.unionByName(counts("after", expire_landing(lake, cfg, "2001-08-02")))
