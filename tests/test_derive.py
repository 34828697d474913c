import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlode.functions import rules
from ledgerlode.operators import derive


@pytest.mark.parametrize("days,label", [
    (1, "1-29"), (29, "1-29"), (30, "30-59"), (59, "30-59"), (60, "60-89"), (89, "60-89"),
    (90, "90-119"), (119, "90-119"), (120, "120+"), (999, "120+"), (None, None)])
def test_dpd(frame, days, label):
    assert frame([(days,)], "d int").select(rules.dpd_bucket(F.col("d"))).first()[0] == label


@pytest.mark.parametrize("score,grade", [
    (500, "D"), (501, "C"), (650, "C"), (651, "B"), (800, "B"), (801, "A"), (None, None)])
def test_grade(frame, score, grade):
    assert frame([(score,)], "s int").select(rules.risk_grade(F.col("s"))).first()[0] == grade


def test_statement(frame):
    row = derive.statement_amounts(frame(
        [("s", D("100.00"), D("50.00"), D("20.00"), D("12.00"), D("1.50"), dt.date(2026, 7, 18)),
         ("t", D("9000.00"), D("0.00"), D("0.00"), D("0.00"), D("0.17"), dt.date(2026, 2, 28))],
        "statement_id string, opening_balance decimal(18,2), total_purchases decimal(18,2), "
        "total_payments decimal(18,2), total_fees decimal(18,2), total_interest decimal(18,2), "
        "statement_period_end date")).collect()
    assert row[0].closing_balance == D("143.50") and row[0].minimum_payment_due == D("25.00")
    assert row[0].payment_due_date == dt.date(2026, 8, 8)
    assert row[1].minimum_payment_due == D("270.01") and row[1].payment_due_date == dt.date(2026, 3, 21)


def test_emi(frame):
    row = derive.emi_plans(frame(
        [("t", "a", D("1000.00"), 12, D("14.900"), dt.date(2026, 1, 31))],
        "transaction_id string, account_id string, transaction_amount decimal(18,2), "
        "tenure_months int, interest_rate decimal(9,3), transaction_date date")).first()
    assert row.monthly_installment == D("95.75") and row.processing_fee == D("20.00")
    assert row.emi_end_date == dt.date(2026, 1, 31) + dt.timedelta(days=360)


def test_points_balance_and_redemption(frame):
    txns = frame([("a", 1, "food", dt.date(2026, 1, 1), D("10.99")),
                  ("a", 2, "fuel", dt.date(2026, 1, 2), D("99.00")),
                  ("a", 3, "food", dt.date(2026, 1, 3), D("5.00")),
                  ("b", 4, "food", dt.date(2026, 1, 1), D("7.50"))],
                 "account_id string, transaction_id int, mcc_code string, transaction_date date, "
                 "transaction_amount decimal(18,2)")
    eligible = frame([("food",), ("food",)], "mcc_code string")
    ledger = derive.points_ledger(txns, eligible, redeemed=F.when(
        F.col("transaction_id") == 3, F.col("points_earned")).otherwise(0))
    rows = {r.transaction_id: (r.points_earned, r.points_redeemed, r.points_balance)
            for r in ledger.collect()}
    assert rows == {1: (10, 0, 10), 3: (5, 5, 10), 4: (7, 0, 7)}
    assert ledger.where("transaction_id = 1").first().expiry_date == dt.date(2028, 12, 31)


def test_case_chain(frame):
    alerts = frame([("A2", "T1", dt.datetime(2026, 1, 5, 23), "CLOSED_CONFIRMED"),
                    ("A1", "T2", dt.datetime(2026, 1, 6), "CLOSED_CONFIRMED"),
                    ("A3", "T1", dt.datetime(2026, 1, 7), "OPEN")],
                   "fraud_alert_id string, transaction_id string, alert_date timestamp, "
                   "alert_status string")
    txns = frame([("T1", "a", D("10.00")), ("T2", "b", D("20.00"))],
                 "transaction_id string, account_id string, transaction_amount decimal(18,2)")
    accounts = frame([("a", "c1"), ("b", "c2")], "account_id string, customer_id string")
    cases = derive.fraud_cases(alerts, txns, accounts)
    assert sorted((r.fraud_case_id, r.customer_id, str(r.case_open_date)) for r in cases.collect()) == [
        ("FC0000001", "c2", "2026-01-06"), ("FC0000002", "c1", "2026-01-05")]
    back = derive.chargebacks(cases, alerts)
    assert sorted((r.chargeback_id, r.transaction_id, str(r.chargeback_date))
                  for r in back.collect()) == [
        ("CB0000001", "T2", "2026-01-08"), ("CB0000002", "T1", "2026-01-07")]


def test_collections_and_write_offs(frame):
    overdue = frame([("D1", "a", D("5.00"), "OPEN"), ("D2", "b", D("6.00"), "WRITTEN_OFF")],
                    "delinquency_id string, account_id string, overdue_amount decimal(18,2), "
                    "collections_status string")
    cases = derive.collections_cases(overdue)
    assert cases.count() == 2
    assert [tuple(r) for r in derive.write_offs(cases).collect()] == [("WO0000001", "b", D("6.00"))]


def test_limits_income_expiry_years(frame):
    row = derive.credit_limits(frame([(D("1000.00"), D("250.10"))],
                                     "credit_limit_amount decimal(18,2), used_amount decimal(18,2)"))
    assert tuple(row.first())[2:] == (D("749.90"), D("300.00"))
    df = frame([(D("30001.00"), dt.date(2024, 2, 29), dt.date(2026, 7, 18))],
               "gross decimal(18,2), issue date, now date")
    net, expiry, years = df.select(
        rules.net_monthly_income(F.col("gross")), rules.card_expiry(F.col("issue")),
        rules.years_between(F.col("issue"), F.col("now"))).first()
    assert (net, expiry, years) == (D("1800.06"), dt.date(2028, 2, 28), 2.4)


def test_addresses_and_periods(frame):
    homes = frame([("c", 2, "x"), ("c", 1, "y"), ("d", 9, "z")], "customer_id string, n int, v string")
    rows = {r.v: (r.is_primary, r.address_type) for r in derive.address_roles(
        homes, ["customer_id"], ["n"]).collect()}
    assert rows == {"x": (False, "PREVIOUS"), "y": (True, "CURRENT"), "z": (True, "CURRENT")}
    periods = derive.statement_periods(frame([("a",)], "account_id string"), "2026-07-18").collect()
    assert len(periods) == 12
    first = min(periods, key=lambda r: r.period_no)
    assert str(first.statement_period_start) == "2026-06-18"
    assert all(r.statement_period_end - r.statement_period_start == dt.timedelta(days=30)
               for r in periods)
