"""Queries over the measure layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlode.catalogue import gold, views
from ledgerlode.catalogue.registry import query
from ledgerlode.catalogue.views import sql, table
from ledgerlode.operators import measures, star


def _star(spark, sf, *names, grouped=True):
    """Only the tables that a report asks for are derived, and only the keys of the dimensions that it groups by
    looked up."""
    def asked(*kinds):
        return [d for d in kinds if grouped and f"Dim{d.capitalize()}" in names]

    dims = views.Dimensions(spark, sf)
    status = F.when(F.col("balance") >= 0, F.lit("ACTIVE")).otherwise(F.lit("CLOSED"))
    makers = {
        "DimAccount": lambda: dims.account.withColumn("account_status", status),
        "DimCustomer": lambda: dims.customer,
        "DimCard": lambda: dims.card,
        "DimMerchant": lambda: dims.merchant,
        "DimDate": lambda: views.calendar(spark, sf),
        "ShippingDate": lambda: views.shipping_calendar(spark, sf),
        "FactTransaction": lambda: views.fact_transaction(dims, asked("account", "card", "merchant")),
        "FactPayment": lambda: gold.payment_fact(dims, asked("account")),
        "FactFraud": lambda: gold.fraud_fact(dims, asked("customer")),
        "FactCollections": lambda: gold.collections_fact(dims, asked("account")),
        "FactRevenue": lambda: gold.revenue_fact(dims, "account", asked("account")),
        "FactRevenueMonthly": lambda: gold.revenue_fact(dims, "calendar_month", ()),
    }
    # Dimensions first: facts then look their keys up in what is stored already.
    return {n: makers[n]() for n in sorted(names)}


def _typed(df):
    """One decimal type for all sums, doubles rounded: the form in which SQL is compared."""
    changes = {}
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind.startswith("decimal"):
            changes[f.name] = F.col(f"`{f.name}`").cast("decimal(38,2)")
        elif kind == "double":
            changes[f.name] = F.round(f"`{f.name}`", 6)
    return df.withColumns(changes) if changes else df


@query(sql("""SELECT segment, fca_reporting_quarter,
    CAST(SUM(transaction_amount) AS DECIMAL(38,2)) AS "Total Transaction Amount",
    count(*) AS "Total Transactions",
    round(CAST(SUM(transaction_amount) AS DOUBLE) / count(*), 6) AS "Average Transaction Value"
    FROM fact_transaction LEFT JOIN dim_account USING (account_sk)
    LEFT JOIN (SELECT *, 'FY' || year || 'Q' || quarter AS fca_reporting_quarter FROM calendar)
      USING (date_sk) GROUP BY ALL""", "fact_transaction"))
def measures_by_segment_quarter(spark, sf):
    data = _star(spark, sf, "FactTransaction", "DimAccount", "DimDate")
    return _typed(measures.measure_table(
        data, ["Total Transaction Amount", "Total Transactions", "Average Transaction Value"],
        ["DimAccount.segment", "DimDate.fca_reporting_quarter"]))


@query(sql("""SELECT channel_merchant AS merchant_name, card_type, count(*) AS "Total Transactions",
    CAST(SUM(transaction_amount) AS DECIMAL(38,2)) AS "Total Transaction Amount"
    FROM (SELECT f.*, m.merchant_name AS channel_merchant, c.card_type FROM fact_transaction f
      LEFT JOIN dim_merchant m USING (merchant_sk) LEFT JOIN dim_card c USING (card_sk))
    GROUP BY ALL""", "fact_transaction"))
def measures_by_merchant_card(spark, sf):
    data = _star(spark, sf, "FactTransaction", "DimMerchant", "DimCard")
    return _typed(measures.measure_table(
        data, ["Total Transactions", "Total Transaction Amount"],
        ["DimMerchant.merchant_name", "DimCard.card_type"]))


_GLOBAL = [
    "Total Transaction Amount", "Total Transactions", "Total Customers", "Active Accounts",
    "Total Payments", "Total Fee Revenue", "Total Interest Revenue", "Total Revenue",
    "Total Disputed Fraud Amount", "Fraud Case Count", "Total Outstanding Collections",
]


@query(sql("""SELECT
    (SELECT CAST(SUM(transaction_amount) AS DECIMAL(38,2)) FROM transactions)
      AS "Total Transaction Amount",
    (SELECT count(*) FROM transactions) AS "Total Transactions",
    (SELECT count(DISTINCT party_id) FROM versions) AS "Total Customers",
    (SELECT count(DISTINCT party_id) FROM versions WHERE balance >= 0) AS "Active Accounts",
    (SELECT CAST(SUM(payment_amount) AS DECIMAL(38,2)) FROM payments) AS "Total Payments",
    (SELECT CAST(SUM(total_fee_revenue) AS DECIMAL(38,2)) FROM revenue) AS "Total Fee Revenue",
    (SELECT CAST(SUM(total_interest_revenue) AS DECIMAL(38,2)) FROM revenue)
      AS "Total Interest Revenue",
    (SELECT CAST(SUM(total_revenue) AS DECIMAL(38,2)) FROM revenue) AS "Total Revenue",
    (SELECT CAST(SUM(disputed_amount) AS DECIMAL(38,2)) FROM fraud) AS "Total Disputed Fraud Amount",
    (SELECT count(*) FROM fraud) AS "Fraud Case Count",
    (SELECT CAST(SUM(outstanding_balance) AS DECIMAL(38,2)) FROM collections)
      AS "Total Outstanding Collections" """,
           "transactions", "versions", "payments", "revenue", "fraud", "collections"))
def measures_global(spark, sf):
    data = _star(spark, sf, "FactTransaction", "DimCustomer", "DimAccount", "FactPayment",
                 "FactRevenue", "FactFraud", "FactCollections", grouped=False)
    return _typed(measures.measure_table(data, _GLOBAL))


def _event_star(spark, sf):
    """Purchases as transactions and error events as fraud cases, on the days of 2024."""
    days = star.dim_date(spark, *views.CALENDAR_2024)
    dims = views.Dimensions(spark, sf)
    bought = table(spark, sf, "events").where("event_type = 'purchase'").select(
        F.col("ts").cast("date").alias("day"), views.money("value").alias("transaction_amount"))
    sales = dims.resolve(bought, (), ["date_sk", "transaction_amount"], days, "day")
    return {"FactTransaction": sales, "FactFraud": gold.fraud_fact(dims, ()), "DimDate": days}


@query(sql("""SELECT week_of_year, CASE WHEN COALESCE(t, 0) = 0 THEN 0 ELSE round(
      CAST(COALESCE(d, 0) - COALESCE(r, 0) AS DOUBLE) / CAST(t AS DOUBLE), 6) END AS "Fraud Loss Rate"
    FROM (SELECT week_of_year, SUM(disputed_amount) AS d, SUM(recovery_amount) AS r FROM fraud
      LEFT JOIN calendar24 ON case_open_date = calendar_date GROUP BY ALL)
    FULL JOIN (SELECT week_of_year, SUM(CAST(value AS DECIMAL(18,2))) AS t FROM events
      LEFT JOIN calendar24 ON CAST(ts AS DATE) = calendar_date WHERE event_type = 'purchase'
      GROUP BY ALL) USING (week_of_year)""", "fraud", "calendar24"))
def fraud_loss_rate(spark, sf):
    return _typed(measures.measure_table(_event_star(spark, sf), ["Fraud Loss Rate"],
                                         ["DimDate.week_of_year"]))


@query(sql("""SELECT segment, round(CAST(count(*) FILTER (WHERE is_international_flag) AS DOUBLE)
    / count(*), 6) AS "International Transaction %"
    FROM fact_transaction LEFT JOIN dim_account USING (account_sk) GROUP BY ALL""",
           "fact_transaction"))
def international_pct(spark, sf):
    data = _star(spark, sf, "FactTransaction", "DimAccount")
    return _typed(measures.measure_table(data, ["International Transaction %"],
                                         ["DimAccount.segment"]))


def _to_date(kind, period):
    return sql(f"""SELECT calendar_date, CAST(SUM(COALESCE(n, 0)) OVER (PARTITION BY {period}
    ORDER BY calendar_date) AS BIGINT) AS "Transactions {kind}" FROM calendar
    LEFT JOIN (SELECT transaction_date AS d, count(*) AS n FROM transactions GROUP BY ALL)
      ON d = calendar_date""", "calendar", "transactions")


@query(_to_date("MTD", "year, month"))
def txn_mtd(spark, sf):
    data = _star(spark, sf, "FactTransaction", "DimDate")
    return measures.time_measure("Transactions MTD", data)


@query(_to_date("YTD", "year"))
def txn_ytd(spark, sf):
    data = _star(spark, sf, "FactTransaction", "DimDate")
    return measures.time_measure("Transactions YTD", data)


@query(sql("""SELECT s.month_start, CAST(n.v AS DECIMAL(38,2)) AS "Total Revenue",
    CAST(b.v AS DECIMAL(38,2)) AS "Revenue Prior Month"
    FROM (SELECT DISTINCT CAST(date_trunc('month', calendar_date) AS DATE) AS month_start
      FROM shipping_calendar) s
    LEFT JOIN (SELECT revenue_month AS m, SUM(total_revenue) AS v FROM revenue_monthly GROUP BY ALL) n
      ON n.m = s.month_start
    LEFT JOIN (SELECT CAST(revenue_month + INTERVAL 1 MONTH AS DATE) AS m, SUM(total_revenue) AS v
      FROM revenue_monthly GROUP BY ALL) b ON b.m = s.month_start""", "shipping_calendar", "revenue_monthly"))
def revenue_prior_month(spark, sf):
    data = _star(spark, sf, "ShippingDate", "FactRevenueMonthly")
    data = {"FactRevenue": data["FactRevenueMonthly"], "DimDate": data["ShippingDate"]}
    return _typed(measures.time_measure("Revenue Prior Month", data))


@query(sql("""SELECT CAST(SUM(total_fees) AS DECIMAL(38,2)) AS total_fees,
    CAST(SUM(total_interest) AS DECIMAL(38,2)) AS total_interest,
    round(CAST(SUM(opening_balance) AS DOUBLE) / count(*), 6) AS opening_balance FROM statements""",
           "statements"))
def implicit_sums(spark, sf):
    balances = views.statements(spark, sf).withColumn(
        "opening_balance", F.col("opening_balance").cast("double"))
    return _typed(measures.implicit_sums(balances, ["total_fees", "total_interest"],
                                         ["opening_balance"]))
