"""Queries over the business rules and the tables derived by them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlode.catalogue import views
from ledgerlode.catalogue.registry import query
from ledgerlode.catalogue.views import money, sql, table
from ledgerlode.functions import rules
from ledgerlode.functions.exprs import token
from ledgerlode.operators import derive


@query("""SELECT CASE WHEN d < 30 THEN '1-29' WHEN d < 60 THEN '30-59' WHEN d < 90 THEN '60-89'
    WHEN d < 120 THEN '90-119' ELSE '120+' END AS dpd_bucket, count(*) AS n_rows,
    CAST(sum(d) AS BIGINT) AS days, CAST(min(d) AS INTEGER) AS least, CAST(max(d) AS INTEGER) AS most
    FROM (SELECT date_diff('day', o_orderdate, l_shipdate) AS d FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey) WHERE d > 0 GROUP BY 1""")
def dpd_bucket(spark, sf):
    late = (table(spark, sf, "lineitem").join(table(spark, sf, "orders"),
                                              F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.datediff("l_shipdate", "o_orderdate").alias("days_past_due"))
            .where("days_past_due > 0"))
    return derive.delinquency_buckets(late).groupBy("dpd_bucket").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("days_past_due").alias("days"),
        F.min("days_past_due").alias("least"), F.max("days_past_due").alias("most"))


@query("""SELECT c_custkey, score, CASE WHEN score > 800 THEN 'A' WHEN score > 650 THEN 'B'
    WHEN score > 500 THEN 'C' ELSE 'D' END AS risk_grade
    FROM (SELECT c_custkey, CAST(floor(c_acctbal / 10) AS INTEGER) AS score FROM customer)""")
def risk_grade(spark, sf):
    scored = table(spark, sf, "customer").select(
        "c_custkey", F.floor(F.col("c_acctbal") / 10).cast("int").alias("score"))
    return scored.withColumn("risk_grade", rules.risk_grade(F.col("score")))


@query(sql("""SELECT statement_id, closing_balance, statement_period_end + 21 AS payment_due_date,
    CAST(greatest(CAST(25 AS DECIMAL(18,2)), ROUND(closing_balance * 0.03, 2)) AS DECIMAL(18,2))
      AS minimum_payment_due
    FROM (SELECT *, CAST(opening_balance + total_purchases - total_payments + total_fees
      + total_interest AS DECIMAL(18,2)) AS closing_balance FROM statements)""", "statements"))
def statement_math(spark, sf):
    return derive.statement_amounts(views.statements(spark, sf)).select(
        "statement_id", "closing_balance", "payment_due_date", "minimum_payment_due")


@query("""SELECT transaction_id, account_id, principal AS principal_amount, tenure_months,
    interest_rate, CAST(CAST((2 * n + tenure_months * 100000) // (2 * tenure_months * 100000)
      AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS monthly_installment,
    d AS emi_start_date, d + 30 * tenure_months AS emi_end_date,
    CAST(ROUND(principal * 0.02, 2) AS DECIMAL(18,2)) AS processing_fee
    FROM (SELECT *, CAST(replace(CAST(principal
        * CAST(1 + interest_rate * 0.01 AS DECIMAL(10,5)) AS VARCHAR), '.', '') AS HUGEINT) AS n
      FROM (SELECT o_orderkey AS transaction_id, 'C' || o_custkey AS account_id,
        CAST(o_totalprice AS DECIMAL(18,2)) AS principal, CAST(o_orderdate AS DATE) AS d,
        CAST(3 * CAST(left(o_orderpriority, 1) AS INTEGER) AS INTEGER) AS tenure_months,
        CAST(day(o_orderdate) * 0.483 AS DECIMAL(9,3)) AS interest_rate FROM orders))""")
def emi_schedule(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        views.party_id("C", "o_custkey").alias("account_id"),
        money("o_totalprice").alias("transaction_amount"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        (F.left("o_orderpriority", F.lit(1)).cast("int") * 3).alias("tenure_months"),
        (F.day("o_orderdate").cast("decimal(9,0)") * F.lit("0.483").cast("decimal(4,3)"))
        .cast("decimal(9,3)").alias("interest_rate"))
    return derive.emi_plans(orders)


@query("""SELECT account_id, transaction_id, points_earned, points_redeemed,
    CAST(SUM(points_earned - points_redeemed) OVER (PARTITION BY account_id
      ORDER BY transaction_date, transaction_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS points_balance,
    transaction_date, transaction_date + 1095 AS expiry_date
    FROM (SELECT 'C' || user_id AS account_id, event_id AS transaction_id,
      CAST(floor(CAST(value AS DECIMAL(18,2))) AS INTEGER) AS points_earned,
      CASE WHEN event_type = 'signup' THEN CAST(floor(CAST(value AS DECIMAL(18,2))) AS INTEGER)
        ELSE 0 END AS points_redeemed, CAST(ts AS DATE) AS transaction_date
      FROM events WHERE event_type IN ('purchase', 'signup', 'click'))""")
def points_ledger(spark, sf):
    events = table(spark, sf, "events")
    posted = events.select(
        views.party_id("C", "user_id").alias("account_id"),
        F.col("event_id").alias("transaction_id"), F.col("event_type").alias("mcc_code"),
        F.col("ts").cast("date").alias("transaction_date"),
        money("value").alias("transaction_amount"))
    eligible = events.where(F.col("event_type").isin("purchase", "signup", "click")).select(
        F.col("event_type").alias("mcc_code"))
    redeemed = F.when(F.col("mcc_code") == "signup", F.col("points_earned")).otherwise(0)
    return derive.points_ledger(posted, eligible, redeemed=redeemed)


@query(sql("""SELECT 'INT' || lpad(CAST(row_number() OVER (ORDER BY statement_id) AS VARCHAR), 8, '0')
    AS interest_charge_id, account_id, statement_id, statement_date AS charge_date,
    opening_balance AS average_daily_balance, total_interest AS interest_amount, 30 AS days_in_period
    FROM statements WHERE total_interest > 0""", "statements"))
def derived_interest(spark, sf):
    return derive.interest_charges(views.statements(spark, sf))


@query(sql("""SELECT 'FEE' || lpad(CAST(row_number() OVER (ORDER BY statement_id) AS VARCHAR), 8, '0')
    AS fee_id, account_id, total_fees AS fee_amount, statement_date AS fee_date
    FROM statements WHERE total_fees > 0""", "statements"))
def derived_fees(spark, sf):
    return derive.fee_rows(views.statements(spark, sf))


def _alerts(spark, sf):
    return table(spark, sf, "events").where("event_type = 'error'").select(
        F.col("event_id").alias("fraud_alert_id"), F.col("event_id").alias("transaction_id"),
        F.col("ts").alias("alert_date"),
        F.when(F.col("value") > 10, F.lit("CLOSED_CONFIRMED")).otherwise(F.lit("OPEN"))
        .alias("alert_status"))


def _cases(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("account_id"),
        money("o_totalprice").alias("transaction_amount"))
    accounts = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("account_id"), F.col("c_name").alias("customer_id"))
    return derive.fraud_cases(_alerts(spark, sf), orders, accounts)


_CASES = """SELECT 'FC' || lpad(CAST(row_number() OVER (ORDER BY event_id) AS VARCHAR), 7, '0')
    AS fraud_case_id, event_id AS fraud_alert_id, c_name AS customer_id,
    CAST(ts AS DATE) AS case_open_date, CAST(o_totalprice AS DECIMAL(18,2)) AS disputed_amount,
    TRUE AS confirmed_fraud_flag FROM events JOIN orders ON event_id = o_orderkey
    JOIN customer ON o_custkey = c_custkey WHERE event_type = 'error' AND value > 10"""


@query(_CASES)
def case_chain(spark, sf):
    return _cases(spark, sf)


@query(f"""SELECT 'CB' || substr(fraud_case_id, 3) AS chargeback_id, fraud_alert_id AS transaction_id,
    fraud_case_id, case_open_date + 2 AS chargeback_date, disputed_amount AS chargeback_amount
    FROM ({_CASES})""")
def chargebacks(spark, sf):
    return derive.chargebacks(_cases(spark, sf), _alerts(spark, sf))


def _collections(spark, sf):
    overdue = table(spark, sf, "orders").where("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("delinquency_id"),
        views.party_id("C", "o_custkey").alias("account_id"),
        money("o_totalprice").alias("overdue_amount"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("WRITTEN_OFF")).otherwise(F.lit("OPEN"))
        .alias("collections_status"))
    return derive.collections_cases(overdue)


_COLLECTIONS = """SELECT 'COL' || lpad(CAST(row_number() OVER (ORDER BY o_orderkey) AS VARCHAR), 7, '0')
    AS collections_id, 'C' || o_custkey AS account_id,
    CAST(o_totalprice AS DECIMAL(18,2)) AS outstanding_balance,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'WRITTEN_OFF' ELSE 'OPEN' END AS collections_status
    FROM orders WHERE o_orderstatus <> 'F'"""


@query(_COLLECTIONS)
def collections_cases(spark, sf):
    return _collections(spark, sf)


@query(f"""SELECT 'WO' || lpad(CAST(row_number() OVER (ORDER BY collections_id) AS VARCHAR), 7, '0')
    AS write_off_id, account_id, outstanding_balance AS write_off_amount
    FROM ({_COLLECTIONS}) WHERE collections_status = 'WRITTEN_OFF'""")
def write_offs(spark, sf):
    return derive.write_offs(_collections(spark, sf))


@query("""SELECT c_custkey, CAST(lim - 150.25 AS DECIMAL(18,2)) AS available_credit_amount,
    CAST(ROUND(lim * 0.30, 2) AS DECIMAL(18,2)) AS cash_advance_limit,
    CAST(ROUND((lim + 30000) * 0.06, 2) AS DECIMAL(18,2)) AS net_monthly_income,
    round(date_diff('day', d, DATE '2026-07-18') / CAST(365.25 AS DOUBLE), 1) AS years,
    make_date(CAST(year(d) + 4 AS INTEGER), CAST(month(d) AS INTEGER),
      CAST(least(day(d), 28) AS INTEGER)) AS card_expiry_date,
    substr(sha256(CAST(c_custkey AS VARCHAR)), 1, 32) AS card_token
    FROM (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) + 2000 AS lim, d FROM customer
      JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS d FROM orders GROUP BY ALL)
      ON c_custkey = o_custkey)""")
def limits_income_age(spark, sf):
    first = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("issue"))
    people = (table(spark, sf, "customer").join(first, F.col("c_custkey") == F.col("o_custkey"))
              .select("c_custkey", "issue",
                      money(money("c_acctbal") + 2000).alias("credit_limit_amount"),
                      F.lit("150.25").cast("decimal(18,2)").alias("used_amount")))
    gross = money(F.col("credit_limit_amount") + 30000)
    return derive.credit_limits(people).select(
        "c_custkey", "available_credit_amount", "cash_advance_limit",
        rules.net_monthly_income(gross).alias("net_monthly_income"),
        rules.years_between(F.col("issue"), F.lit("2026-07-18").cast("date")).alias("years"),
        rules.card_expiry(F.col("issue")).alias("card_expiry_date"),
        token(F.col("c_custkey")).alias("card_token"))


@query("""SELECT o_custkey, o_orderkey, o_orderdate, rn = 1 AS is_primary,
    CASE WHEN rn = 1 THEN 'CURRENT' ELSE 'PREVIOUS' END AS address_type FROM (SELECT o_custkey,
    o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)""")
def address_primary(spark, sf):
    places = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return derive.address_roles(places, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("""SELECT c_custkey, CAST(k AS INTEGER) AS period_no,
    DATE '2026-07-18' - CAST(30 * k + 30 AS INTEGER) AS statement_period_start,
    DATE '2026-07-18' - CAST(30 * k AS INTEGER) AS statement_period_end
    FROM customer, range(12) r(k)""")
def statement_periods(spark, sf):
    return derive.statement_periods(table(spark, sf, "customer").select("c_custkey"), "2026-07-18")
