"""Physical plans: what must, and must not, be in them."""

import compare  # noqa: F401
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlode.operators import measures, ordering, rows, scd, star
from ledgerlode.sources import files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SMALL}/orders.parquet")


def test_no_python_in_any_plan(spark):
    for name in ("fact_transaction", "points_ledger", "dq_profile", "scd2_merge", "pit_join_scan"):
        text = plan(entry.queries()[name](spark, SMALL))
        assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


def test_row_number_sorts_no_rows_in_one_task(orders):
    text = plan(ordering.global_row_number(orders, ["o_custkey", "o_orderkey"], "n", 8))
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    assert len(single) == 1          # the offsets, one row per range
    below = text[text.index(single[0]):]
    assert "HashAggregate" in below.splitlines()[1]
    assert text.count("Exchange hashpartitioning") == 1      # of the counts; the rows do not move again


def test_scd2_merge_is_one_full_outer_join(spark):
    text = plan(entry.queries()["scd2_merge"](spark, SMALL))
    assert text.count("FullOuter") == 1


def test_latest_per_key_limits_before_the_shuffle(orders):
    text = plan(ordering.latest_per_key(orders, ["o_custkey"], [F.desc("o_orderkey")]))
    assert text.count("WindowGroupLimit") == 2


def test_batch_filter_prunes_partitions(spark, orders, tmp_path):
    path = str(tmp_path / "b")
    files.replace_partitions(orders.withColumn("batch_id", F.date_format("o_orderdate", "yyyy")), path,
                             ["batch_id"])
    text = plan(rows.of_batch(spark.read.parquet(path), "1998"))
    assert "PartitionFilters: [isnotnull(batch_id" in text


def test_key_filter_reaches_the_scan(orders):
    good, _ = rows.split_quarantine(orders.select("o_custkey", "o_orderkey"), ["o_custkey"])
    text = plan(good)
    assert "PushedFilters: [IsNotNull(o_custkey)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_business_dedup_combines_before_the_shuffle(orders):
    text = plan(rows.dedup_business(orders))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


def test_calendar_is_broadcast(spark, orders):
    days = star.dim_date(spark, "1996-01-01", "2000-12-31")
    fact = star.resolve_fact(orders, [], ["o_orderkey", "date_sk"], days, "o_orderdate")
    text = plan(fact)
    assert "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning") == 0


def test_fact_is_aggregated_before_it_meets_a_large_dimension(spark, orders):
    fact = orders.select(F.col("o_custkey").alias("account_sk"), F.lit(1).alias("date_sk"))
    dim = spark.read.parquet(f"{SMALL}/customer.parquet").select(
        F.col("c_custkey").alias("account_sk"), "c_mktsegment")
    report = measures.measure_table({"FactTransaction": fact, "DimAccount": dim},
                                    ["Total Transactions"], ["DimAccount.c_mktsegment"])
    text = plan(report)
    assert text.index("Join") < text.rindex("partial_count")


def test_closed_history_is_not_joined(spark, tmp_path):
    source = spark.createDataFrame([("1", "A")], "id string, a string")
    path = str(tmp_path / "versions")
    scd.merge_scd2(None, source, ["id"], ["a"], "2026-01-01 00:00:00").write.parquet(path)
    text = plan(scd.merge_scd2(spark.read.parquet(path), source, ["id"], ["a"], "2026-01-02 00:00:00"))
    assert text.count("FullOuter") == 1 and "Union" in text
    history = text[text.index("Union"):].split("Project [CASE WHEN (__action")[0]
    assert "NOT cast(is_current_flag" in history or "NOT is_current_flag" in history
