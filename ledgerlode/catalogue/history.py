"""Queries over the merges, the history invariants and the point-in-time join."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ledgerlode.catalogue import views
from ledgerlode.catalogue.registry import query
from ledgerlode.catalogue.views import FIRST, TRACKED, money, ntz, sql, table
from ledgerlode.functions import rules
from ledgerlode.operators import ordering, pit, scd

_KEY = ["party_id"]


@query(sql("""SELECT * FROM parties2 UNION ALL
    SELECT * FROM parties1 a WHERE NOT EXISTS (SELECT 1 FROM parties2 b WHERE b.party_id = a.party_id)""",
           "parties1", "parties2"))
def scd1_merge(spark, sf):
    return scd.merge_scd1(views.parties_first(spark, sf), views.parties_second(spark, sf), _KEY)


@query(sql(f"""SELECT party_id, party_name, nation_key, segment, balance,
    TIMESTAMP '{FIRST}' AS effective_start_date, CAST(NULL AS TIMESTAMP) AS effective_end_date,
    TRUE AS is_current_flag, row_hash FROM hashed1""", "hashed1"))
def scd2_first_load(spark, sf):
    return scd.merge_scd2(None, views.parties_first(spark, sf), _KEY, TRACKED, ntz(FIRST))


@query(sql("SELECT * FROM versions", "versions"))
def scd2_merge(spark, sf):
    return views.party_versions(spark, sf)


@query(sql("SELECT * FROM versions WHERE is_current_flag", "versions"))
def scd2_current(spark, sf):
    return scd.current_versions(views.party_versions(spark, sf))


@query(sql("""SELECT 'keep' AS action, count(*) AS n_rows FROM hashed1 a
      LEFT JOIN hashed2 b USING (party_id) WHERE b.row_hash IS NULL OR a.row_hash = b.row_hash
    UNION ALL SELECT 'expire', count(*) FROM hashed1 a JOIN hashed2 b USING (party_id)
      WHERE a.row_hash <> b.row_hash
    UNION ALL SELECT 'insert', count(*) FROM hashed2 b LEFT JOIN hashed1 a USING (party_id)
      WHERE a.row_hash IS NULL OR a.row_hash <> b.row_hash""", "hashed1", "hashed2"))
def scd2_change_counts(spark, sf):
    return scd.scd2_change_counts(views.party_versions(spark, sf, with_action=True))


@query(sql("""SELECT count(*) AS keys_checked, count(*) FILTER (WHERE n_current > 1) AS keys_with_two_current,
    count(*) FILTER (WHERE broken > 0) AS keys_with_broken_chain, sum(mismatch)::BIGINT AS flag_mismatches,
    sum(none)::BIGINT AS empty_intervals FROM (
      SELECT party_id, count(*) FILTER (WHERE is_current_flag) AS n_current,
        count(*) FILTER (WHERE effective_start_date IS DISTINCT FROM ended AND before IS NOT NULL) AS broken,
        count(*) FILTER (WHERE is_current_flag = (effective_end_date IS NOT NULL)) AS mismatch,
        count(*) FILTER (WHERE effective_end_date <= effective_start_date) AS none
      FROM (SELECT *, lag(effective_end_date) OVER w AS ended, lag(effective_start_date) OVER w AS before
        FROM versions WINDOW w AS (PARTITION BY party_id ORDER BY effective_start_date)) GROUP BY party_id)""", "versions"))
def scd2_invariants(spark, sf):
    return scd.scd2_violations(views.party_versions(spark, sf), _KEY)


@query("""SELECT * EXCLUDE (rn) FROM (SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber,
    CAST(l_shipdate AS DATE) AS l_shipdate, row_number() OVER (PARTITION BY l_suppkey
    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) AS rn FROM lineitem)
    WHERE rn = 1""")
def latest_per_key(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_partkey", "l_linenumber",
        F.col("l_shipdate").cast("date").alias("l_shipdate"))
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    return ordering.latest_per_key(lines, ["l_suppkey"], [F.desc(c) for c in order])


def _order_versions(spark, sf):
    """Priority of a customer from order to order, as half-open versions. Orders of the same customer
    and instant count as one."""
    starts = (table(spark, sf, "orders").groupBy("o_custkey", "o_orderdate")
              .agg(F.max("o_orderpriority").alias("priority"),
                   F.max(money("o_totalprice")).alias("price")))
    # Bounded window: a customer has at most one row per day here.
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate")
    return starts.select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("valid_from"),
                         F.lead("o_orderdate").over(w).alias("valid_to"), "priority", "price")


def _shipments(spark, sf):
    """Order lines as events of the buyer at ship time."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return (lines.join(orders.select("o_orderkey", "o_custkey"),
                       F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("user_id"), "l_orderkey", "l_linenumber", "l_partkey",
                    F.col("l_shipdate").alias("at")))


_PIT = """WITH starts AS (SELECT o_custkey AS user_id, o_orderdate AS valid_from,
      max(o_orderpriority) AS priority, max(CAST(o_totalprice AS DECIMAL(18,2))) AS price
      FROM orders GROUP BY ALL),
    versions AS (SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS valid_to
      FROM starts),
    moves AS (SELECT o_custkey AS user_id, l_orderkey, l_linenumber, l_partkey, l_shipdate AS at
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT m.*, v.priority, v.price, v.valid_from FROM moves m LEFT JOIN versions v
      ON m.user_id = v.user_id AND v.valid_from <= m.at AND (v.valid_to IS NULL OR m.at < v.valid_to)"""


@query(_PIT)
def pit_join(spark, sf):
    return pit.pit_join(_shipments(spark, sf), _order_versions(spark, sf), ["user_id"], "at",
                        "valid_from", "valid_to", ["priority", "price", "valid_from"])


# Without a limit on rows per key, so that the ranges are compared with SQL too.
@query(_PIT)
def pit_join_scan(spark, sf):
    return pit.pit_join(_shipments(spark, sf), _order_versions(spark, sf), ["user_id"], "at",
                        "valid_from", "valid_to", ["priority", "price", "valid_from"], "scan",
                        hot_rows=0)


@query("""WITH risk AS (SELECT o_custkey AS user_id, o_orderdate AS valid_from,
      lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to,
      CASE WHEN score > 800 THEN 'A' WHEN score > 650 THEN 'B' WHEN score > 500 THEN 'C' ELSE 'D' END
        AS risk_grade
      FROM (SELECT o_custkey, o_orderdate, CAST(floor(max(o_totalprice) / 500) AS INTEGER) AS score
        FROM orders GROUP BY ALL)),
    cases AS (SELECT event_id AS fraud_case_id, user_id, ts FROM events WHERE event_type = 'error')
    SELECT c.*, r.risk_grade FROM cases c LEFT JOIN risk r ON c.user_id = r.user_id
      AND r.valid_from <= c.ts AND (r.valid_to IS NULL OR c.ts < r.valid_to)""")
def fraud_grade_at_event(spark, sf):
    scored = (table(spark, sf, "orders").groupBy("o_custkey", "o_orderdate")
              .agg(F.floor(F.max("o_totalprice") / 500).cast("int").alias("score")))
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate")
    risk = scored.select(F.col("o_custkey").alias("user_id"),
                         F.col("o_orderdate").alias("valid_from"),
                         F.lead("o_orderdate").over(w).alias("valid_to"),
                         rules.risk_grade(F.col("score")).alias("risk_grade"))
    cases = table(spark, sf, "events").where("event_type = 'error'").select(
        F.col("event_id").alias("fraud_case_id"), "user_id", "ts")
    return pit.pit_join(cases, risk, ["user_id"], "ts", "valid_from", "valid_to", ["risk_grade"])
