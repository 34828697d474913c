"""Queries over the data-quality operators and the run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlode.catalogue import views
from ledgerlode.catalogue.layers import PEOPLE, _nullable_people
from ledgerlode.catalogue.registry import query
from ledgerlode.catalogue.views import ntz, sql, table
from ledgerlode.operators import quality

_LINE_KEY = ["l_orderkey", "l_linenumber"]


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL
    HAVING count(*) > 1""")
def dup_key_groups(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), _LINE_KEY)


@query("""SELECT 'lineitem' AS table_name, sum(n)::BIGINT AS total_rows,
    coalesce(sum(n) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL), 0)::BIGINT AS null_pk_rows,
    count(*) FILTER (WHERE n > 1) AS duplicate_pk_groups, sum(no_tax) / sum(n) AS tax_null_rate,
    count(*) FILTER (WHERE n > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL) = 0 AS passed
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) FILTER (WHERE l_tax IS NULL) AS no_tax
      FROM lineitem GROUP BY ALL)""")
def dq_profile(spark, sf):
    profile = quality.dq_profile(table(spark, sf, "lineitem"), "lineitem", _LINE_KEY, ["l_tax"])
    return profile.withColumn("tax_null_rate", F.col("null_rates")["l_tax"]).drop("null_rates")


_NULLS = ["c_name", "c_mktsegment", "c_nationkey"]


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS total_rows,
    count(*) FILTER (WHERE {c} IS NULL) AS null_rows,
    round(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*), 9) AS null_rate,
    count(*) FILTER (WHERE {c} IS NULL) <= 0.02 * count(*) AS passed FROM {PEOPLE}"""
    for c in _NULLS))
def null_profile(spark, sf):
    rates = quality.null_rates(_nullable_people(spark, sf), _NULLS)
    return rates.withColumn("null_rate", F.round("null_rate", 9))


@query(" UNION ALL ".join(
    f"""SELECT '{k}' AS key_column, sum(n)::BIGINT AS total_rows, coalesce(sum(n) FILTER (WHERE {k} IS NULL), 0)::BIGINT
    AS null_rows, count(*) FILTER (WHERE {k} IS NOT NULL AND n > 1) AS duplicate_keys,
    count(*) FILTER (WHERE {k} IS NULL OR n > 1) = 0 AS passed FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY 1)"""
    for t, k in (("supplier", "s_suppkey"), ("orders", "o_custkey"))))
def key_tests(spark, sf):
    return quality.union_checks([
        quality.key_tests(table(spark, sf, "supplier"), "s_suppkey"),
        quality.key_tests(table(spark, sf, "orders"), "o_custkey")])


_REFERENCES = [("account_sk", "DimAccount"), ("card_sk", "DimCard"), ("merchant_sk", "DimMerchant"),
               ("date_sk", "DimDate")]
_ORPHANS = " UNION ALL ".join(
    f"""SELECT 'REFERENTIAL_INTEGRITY' AS check_type, 'FactTransaction' AS fact_table,
    '{fk}' AS fk_column, '{dim}' AS dim_table, count(*) AS total_rows,
    count(*) FILTER (WHERE {fk} IS NULL) AS orphan_rows,
    round(CAST(count(*) FILTER (WHERE {fk} IS NULL) AS DOUBLE) / count(*), 9) AS orphan_rate,
    CAST(0.001 AS DOUBLE) AS threshold,
    count(*) FILTER (WHERE {fk} IS NULL) <= 0.001 * count(*) AS passed FROM fact_transaction"""
    for fk, dim in _REFERENCES)


def _checks(spark, sf):
    return quality.orphan_checks(views.fact_transaction(views.Dimensions(spark, sf)), "FactTransaction", _REFERENCES)


@query(sql(_ORPHANS, "fact_transaction"))
def fk_orphan_rate(spark, sf):
    return _checks(spark, sf).withColumn("orphan_rate", F.round("orphan_rate", 9))


@query("""SELECT count(*) AS total_rows, count(*) FILTER (WHERE k IS NULL) AS null_key_rows,
    count(*) FILTER (WHERE k IS NOT NULL AND c_custkey IS NULL) AS orphan_rows,
    count(DISTINCT CASE WHEN c_custkey IS NULL THEN k END) AS orphan_keys
    FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders)
    LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) ON k = c_custkey""")
def fk_anti_orphans(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    parents = table(spark, sf, "customer").where("c_acctbal >= 0")
    found = quality.missing_parents(orders, parents, "k", "c_custkey")
    return found.select(*[F.col(c).cast("long").alias(c) for c in found.columns])


@query(sql(f"""SELECT *, 'b1' AS batch_id, TIMESTAMP '2001-08-03 00:00:00' AS validation_timestamp
    FROM ({_ORPHANS})""", "fact_transaction"))
def dq_summary(spark, sf):
    rounded = _checks(spark, sf).withColumn("orphan_rate", F.round("orphan_rate", 9))
    return quality.summary_rows(rounded, "b1", ntz("2001-08-03 00:00:00"))


@query(sql(f"""SELECT count(*) AS n_checks, count(*) FILTER (WHERE NOT passed) AS n_failed,
    bool_and(passed) AS all_passed FROM ({_ORPHANS})""", "fact_transaction"))
def dq_gate(spark, sf):
    return quality.gate_result(_checks(spark, sf))
