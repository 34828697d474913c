"""Queries over the dimensions, the facts and the revenue tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlode.catalogue import views
from ledgerlode.catalogue.registry import query
from ledgerlode.catalogue.views import Dimensions, sql, table
from ledgerlode.operators import derive, ordering, quality, scd, star
from ledgerlode.plans.gold import FACTS

_COLUMNS = {f.name: f.columns for f in FACTS}


@query("""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, CAST(d AS DATE) AS calendar_date,
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
    CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
    strftime(d, '%A') AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
    dayofweek(d) IN (0, 6) AS is_weekend, 'FY' || year(d) || 'Q' || quarter(d)
    AS fca_reporting_quarter
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
    FROM orders)""")
def dim_date(spark, sf):
    bounds = table(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"),
        F.max("o_orderdate").cast("date").alias("last"))
    return star.calendar_of(bounds)


@query(sql("SELECT * FROM dim_account", "dim_account"))
def sk_scd2(spark, sf):
    return Dimensions(spark, sf).account


@query("""SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
    CAST(row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS BIGINT) AS order_sk
    FROM orders""")
def sk_by_customer(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return ordering.surrogate_key(orders, ["o_custkey", "o_orderdate", "o_orderkey"], "order_sk")


@query(sql("SELECT * FROM dim_merchant", "dim_merchant"))
def sk_scd1(spark, sf):
    return Dimensions(spark, sf).merchant


@query(sql("""SELECT 'party_sk' AS key_column, sum(n)::BIGINT AS total_rows,
    coalesce(sum(n) FILTER (WHERE party_id IS NULL), 0)::BIGINT AS null_rows,
    count(*) FILTER (WHERE n > 1) AS duplicate_keys, max(n) = 1 AS passed
    FROM (SELECT party_id, effective_start_date, count(*) AS n FROM versions GROUP BY ALL)""", "versions"))
def sk_hash_unique(spark, sf):
    keyed = ordering.surrogate_key(views.party_versions(spark, sf), ["party_id", scd.START],
                                   "party_sk", "hash")
    return quality.key_tests(keyed, "party_sk")


@query(sql("SELECT * FROM account_now", "account_now"))
def current_lookup(spark, sf):
    return Dimensions(spark, sf).lookup("account", "account_id")[0]


@query(sql("SELECT * FROM fact_transaction", "fact_transaction"))
def fact_transaction(spark, sf):
    return views.fact_transaction(Dimensions(spark, sf))


@query(sql("""SELECT payment_id, account_sk, date_sk, payment_amount, payment_method, payment_status,
    is_autopay_flag FROM payments LEFT JOIN account_now USING (account_id)
    LEFT JOIN calendar ON payment_date = calendar_date""", "payments", "account_now", "calendar"))
def fact_payment(spark, sf):
    return payment_fact(Dimensions(spark, sf))


def payment_fact(dims, keys=("account",)):
    spark, sf = dims.spark, dims.sf
    return dims.resolve(views.payments(spark, sf), keys, _COLUMNS["FactPayment"], views.calendar(spark, sf), "payment_date")


@query(sql("""SELECT statement_id, account_sk, date_sk, opening_balance, closing_balance,
    total_purchases, total_payments, total_fees, total_interest,
    CAST(greatest(CAST(25 AS DECIMAL(18,2)), ROUND(closing_balance * 0.03, 2)) AS DECIMAL(18,2))
      AS minimum_payment_due
    FROM (SELECT *, CAST(opening_balance + total_purchases - total_payments + total_fees
      + total_interest AS DECIMAL(18,2)) AS closing_balance FROM statements)
    LEFT JOIN account_now USING (account_id) LEFT JOIN calendar ON statement_date = calendar_date""",
           "statements", "account_now", "calendar"))
def fact_statement(spark, sf):
    return star.resolve_fact(derive.statement_amounts(views.statements(spark, sf)),
                             [Dimensions(spark, sf).lookup("account", "account_id")],
                             _COLUMNS["FactStatement"], views.calendar(spark, sf), "statement_date")


@query(sql("""SELECT fraud_case_id, account_sk AS customer_sk, date_sk, fraud_type, disputed_amount,
    recovery_amount, case_status FROM fraud LEFT JOIN account_now ON customer_id = account_id
    LEFT JOIN calendar24 ON case_open_date = calendar_date""", "fraud", "account_now", "calendar24"))
def fact_fraud(spark, sf):
    return fraud_fact(Dimensions(spark, sf))


def fraud_fact(dims, keys=("customer",)):
    spark, sf = dims.spark, dims.sf
    cases = scd.current_versions(views.fraud_case_versions(spark, sf))
    return dims.resolve(cases, keys, _COLUMNS["FactFraud"], star.dim_date(spark, *views.CALENDAR_2024), "case_open_date")


@query(sql("""SELECT collections_id, account_sk, collections_stage, outstanding_balance,
    promise_to_pay_amount, collections_status FROM collections LEFT JOIN account_now USING (account_id)""",
           "collections", "account_now"))
def fact_collections(spark, sf):
    return collections_fact(Dimensions(spark, sf))


def collections_fact(dims, keys=("account",)):
    return dims.resolve(views.collections(dims.spark, dims.sf), keys, _COLUMNS["FactCollections"])


def revenue_fact(dims, by, keys=("account",)):
    accounts = by != "calendar_month"
    return star.fact_revenue(views.interest_charges(dims.spark, dims.sf, accounts),
                             views.fees(dims.spark, dims.sf, accounts),
                             dims.lookup("account", "account_id")[0] if keys else None, by)


@query(sql("SELECT * FROM revenue", "revenue"))
def fact_revenue(spark, sf):
    return revenue_fact(Dimensions(spark, sf), "account")


@query(sql("SELECT * FROM revenue_monthly", "revenue_monthly"))
def fact_revenue_monthly(spark, sf):
    return revenue_fact(Dimensions(spark, sf), "month")


@query(sql("""SELECT o_orderkey, customer_id, v.segment AS customer_segment,
    v.party_name AS customer_party_name FROM (SELECT o_orderkey, 'C' || o_custkey AS customer_id
    FROM orders) LEFT JOIN (SELECT * FROM versions WHERE is_current_flag) v ON customer_id = v.party_id""",
           "versions"))
def product_customer_snowflake(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", views.party_id("C", "o_custkey").alias("customer_id"))
    parents = views.party_versions(spark, sf).withColumnRenamed("party_id", "customer_id")
    return star.snowflake(orders, parents, "customer_id", ["segment", "party_name"], "customer_")
