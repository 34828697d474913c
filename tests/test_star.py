import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlode.operators import measures, scd, star

DAY = dt.date


def test_calendar_bounds_and_attributes(spark):
    days = star.dim_date(spark)
    assert days.count() == 5844
    rows = {r.date_sk: r for r in days.where("date_sk in (20150101, 20270103, 20280229)").collect()}
    assert rows[20150101].day_name == "Thursday" and rows[20150101].fca_reporting_quarter == "FY2015Q1"
    assert rows[20270103].is_weekend and rows[20270103].week_of_year == 53
    assert rows[20270103].day_of_week == 1 and rows[20280229].month_name == "February"
    assert days.columns == [
        "date_sk", "calendar_date", "year", "quarter", "month", "month_name", "day_of_month",
        "day_of_week", "day_name", "week_of_year", "is_weekend", "fca_reporting_quarter"]
    assert star.dim_date(spark, "2020-02-01", "2020-01-01").count() == 0


def test_current_lookup_ignores_closed_versions(frame):
    dim = frame([("a", 1, False), ("a", 2, True)], "account_id string, account_sk long, "
                                                   "is_current_flag boolean")
    assert [tuple(r) for r in star.current_lookup(dim, "account_id", "account_sk").collect()] == [
        ("a", 2)]
    plain = frame([("m", 1)], "merchant_id string, merchant_sk long")
    assert star.current_lookup(plain, "merchant_id", "merchant_sk").count() == 1


def test_fact_keeps_unmatched_rows(spark, frame):
    fact = frame([("t1", "a", DAY(2020, 1, 1)), ("t2", "zz", DAY(1999, 1, 1)), ("t3", None, None)],
                 "txn string, account_id string, d date")
    lookup = frame([("a", 7)], "account_id string, account_sk long")
    out = star.resolve_fact(fact, [(lookup, "account_id")], ["txn", "account_sk", "date_sk"],
                            star.dim_date(spark, "2020-01-01", "2020-12-31"), "d")
    assert sorted(map(tuple, out.collect())) == [
        ("t1", 7, 20200101), ("t2", None, None), ("t3", None, None)]


@pytest.fixture()
def revenue_inputs(frame):
    interest = frame([("both", DAY(2020, 1, 5), D("1.50")), ("both", DAY(2020, 2, 5), D("2.00")),
                      ("interest only", DAY(2020, 1, 9), D("3.00"))],
                     "account_id string, charge_date date, interest_amount decimal(18,2)")
    fees = frame([("both", DAY(2020, 1, 20), D("10.00")), ("fee only", DAY(2020, 3, 1), D("4.00"))],
                 "account_id string, fee_date date, fee_amount decimal(18,2)")
    accounts = frame([("both", 1), ("fee only", 2)], "account_id string, account_sk long")
    return interest, fees, accounts


def test_revenue_per_account(revenue_inputs):
    rows = {r.account_id: r for r in star.fact_revenue(*revenue_inputs).collect()}
    assert rows["both"].total_revenue == D("13.50") and rows["both"].account_sk == 1
    assert rows["fee only"].total_interest_revenue == D("0.00")
    assert rows["interest only"].account_sk is None and rows["interest only"].total_revenue == D("3.00")


def test_revenue_per_month(revenue_inputs):
    rows = {(r.account_id, r.revenue_month): r.total_revenue
            for r in star.fact_revenue(*revenue_inputs, by="month").collect()}
    assert rows == {("both", DAY(2020, 1, 1)): D("11.50"), ("both", DAY(2020, 2, 1)): D("2.00"),
                    ("interest only", DAY(2020, 1, 1)): D("3.00"),
                    ("fee only", DAY(2020, 3, 1)): D("4.00")}
    with pytest.raises(ValueError):
        star.fact_revenue(*revenue_inputs, by="week")


def test_one_fact_row_per_case_with_two_versions(frame):
    case = "fraud_case_id string, customer_id string, status string"
    v1 = scd.merge_scd2(None, frame([("f", "c", "OPEN")], case), ["fraud_case_id"], ["status"],
                        "2020-01-01 00:00:00")
    v2 = scd.merge_scd2(v1, frame([("f", "c", "CLOSED")], case), ["fraud_case_id"], ["status"],
                        "2020-01-02 00:00:00")
    assert v2.count() == 2
    assert [r.status for r in scd.current_versions(v2).collect()] == ["CLOSED"]


def test_snowflake_joins_current_parent_only(frame):
    child = frame([("a", "p"), ("b", "none")], "account_id string, product_id string")
    parent = frame([("p", "old", False), ("p", "new", True)],
                   "product_id string, name string, is_current_flag boolean")
    rows = {r.account_id: r.product_name for r in star.snowflake(
        child, parent, "product_id", ["name"], "product_").collect()}
    assert rows == {"a": "new", "b": None}


@pytest.fixture()
def small_star(spark, frame):
    days = star.dim_date(spark, "2020-01-01", "2020-03-31")
    customers = frame([(1, "c1", "RETAIL", True), (2, "c2", "PREMIUM", True)],
                      "customer_sk long, customer_id string, segment string, is_current_flag boolean")
    accounts = frame([(1, "a1", "c1", "ACTIVE", False), (2, "a1", "c1", "CLOSED", True),
                      (3, "a2", "c2", "ACTIVE", True)],
                     "account_sk long, account_id string, customer_id string, "
                     "account_status string, is_current_flag boolean")
    txns = frame([(2, 20200101, D("10.00"), True), (2, 20200102, D("20.00"), False),
                  (3, 20200201, D("30.00"), False), (None, None, D("5.00"), None)],
                 "account_sk long, date_sk int, transaction_amount decimal(18,2), "
                 "is_international_flag boolean")
    fraud = frame([(1, 20200101, D("8.00"), D("2.00")), (1, 20200301, D("6.00"), None)],
                  "customer_sk long, date_sk int, disputed_amount decimal(18,2), "
                  "recovery_amount decimal(18,2)")
    return {"DimDate": days, "DimCustomer": customers, "DimAccount": accounts,
            "FactTransaction": txns, "FactFraud": fraud}


def test_measures_without_groups(small_star):
    names = ["Total Transaction Amount", "Total Transactions", "Total Customers", "Active Accounts",
             "Fraud Case Count", "Fraud Loss Rate", "International Transaction %",
             "Average Transaction Value"]
    row = measures.measure_table(small_star, names).first()
    assert row["Total Transaction Amount"] == D("65.00") and row["Total Transactions"] == 4
    assert row["Total Customers"] == 2 and row["Active Accounts"] == 2
    assert row["Fraud Case Count"] == 2
    assert row["Fraud Loss Rate"] == pytest.approx(12 / 65)
    assert row["International Transaction %"] == pytest.approx(0.25)
    assert row["Average Transaction Value"] == pytest.approx(65 / 4)
    current = measures.measure_table(small_star, ["Active Accounts"], current_only=True)
    assert current.first()[0] == 1


def test_measures_by_parent_dimension_and_month(small_star):
    out = measures.measure_table(small_star, ["Total Transactions"],
                                 ["DimCustomer.segment", "DimDate.month"])
    got = {(r.segment, r.month): r["Total Transactions"] for r in out.collect()}
    assert got == {("RETAIL", 1): 2, ("PREMIUM", 2): 1, (None, None): 1}


def test_ratio_across_facts_with_missing_side(small_star):
    out = measures.measure_table(small_star, ["Fraud Loss Rate"], ["DimDate.month"])
    got = {r.month: r["Fraud Loss Rate"] for r in out.collect()}
    assert got[1] == pytest.approx(6 / 30) and got[2] == 0 and got[3] == 0


def test_unreachable_attribute(small_star):
    with pytest.raises(ValueError, match="no path"):
        measures.measure_table(small_star, ["Fraud Case Count"], ["DimAccount.account_status"])
    with pytest.raises(ValueError, match="cannot be grouped"):
        measures.measure_table(small_star, ["Total Customers"], ["DimDate.month"])


def test_measures_on_empty_facts(small_star):
    empty = {n: df.limit(0) if n.startswith("Fact") else df for n, df in small_star.items()}
    row = measures.measure_table(empty, ["Total Transactions", "Total Transaction Amount",
                                         "Fraud Loss Rate", "Average Transaction Value"]).first()
    assert tuple(row) == (0, None, 0.0, None)


def test_to_date_counts_restart(small_star):
    mtd = {str(r.calendar_date): r[1] for r in measures.time_measure(
        "Transactions MTD", small_star).collect()}
    ytd = {str(r.calendar_date): r[1] for r in measures.time_measure(
        "Transactions YTD", small_star).collect()}
    assert (mtd["2020-01-31"], mtd["2020-02-01"], mtd["2020-03-01"]) == (2, 1, 0)
    assert (ytd["2020-01-31"], ytd["2020-02-01"], ytd["2020-03-31"]) == (2, 3, 3)
    with pytest.raises(ValueError):
        measures.time_measure("Transactions WTD", small_star)


def test_prior_month_over_a_gap(spark, frame):
    days = star.dim_date(spark, "2020-01-01", "2020-04-30")
    monthly = frame([(DAY(2020, 1, 1), D("5.00")), (DAY(2020, 3, 1), D("7.00"))],
                    "revenue_month date, total_revenue decimal(18,2)")
    out = measures.time_measure("Revenue Prior Month", {"FactRevenue": monthly, "DimDate": days})
    got = {r.month_start.month: (r["Total Revenue"], r["Revenue Prior Month"]) for r in out.collect()}
    assert got == {1: (D("5.00"), None), 2: (None, D("5.00")), 3: (D("7.00"), None),
                   4: (None, D("7.00"))}


def test_display_formats(small_star):
    names = ["Total Transactions", "Total Transaction Amount", "International Transaction %"]
    row = measures.formatted(measures.measure_table(small_star, names), names).first()
    assert tuple(row) == ("4", "65.00", "25.00%")


def test_implicit_aggregation(frame):
    df = frame([(D("1.00"), 10.0), (D("2.00"), 20.0)], "fee decimal(18,2), apr double")
    assert tuple(measures.implicit_sums(df, ["fee"], ["apr"]).first()) == (D("3.00"), 15.0)
    assert df.agg(F.sum("apr")).first()[0] == 30.0
