"""Tables that follow by rule from other tables: charges, cases, points, periods, addresses."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlode.functions import rules
from ledgerlode.functions.exprs import padded_id
from ledgerlode.operators.ordering import flag_first, global_row_number, running_sum


def with_sequence_id(df: DataFrame, order: Sequence[str], name: str, prefix: str,
                     width: int) -> DataFrame:
    """Zero-padded ids 1..n in the given (unique) order."""
    numbered = global_row_number(df, order, "__seq")
    return numbered.withColumn(name, padded_id(prefix, F.col("__seq"), width)).drop("__seq")


def statement_amounts(statements: DataFrame) -> DataFrame:
    """Closing balance, minimum due and due date of statements."""
    closing = rules.closing_balance(*[F.col(c) for c in (
        "opening_balance", "total_purchases", "total_payments", "total_fees", "total_interest")])
    return (statements.withColumn("closing_balance", closing)
            .withColumns({
                "minimum_payment_due": rules.minimum_due(F.col("closing_balance")),
                "payment_due_date": rules.payment_due_date(F.col("statement_period_end")),
            }))


def interest_charges(statements: DataFrame) -> DataFrame:
    """One charge per statement with interest."""
    charged = with_sequence_id(statements.where("total_interest > 0"), ["statement_id"],
                               "interest_charge_id", "INT", 8)
    return charged.select(
        "interest_charge_id", "account_id", "statement_id",
        F.col("statement_date").alias("charge_date"),
        F.col("opening_balance").alias("average_daily_balance"),
        F.col("total_interest").alias("interest_amount"),
        F.lit(rules.STATEMENT_DAYS).alias("days_in_period"))


def fee_rows(statements: DataFrame) -> DataFrame:
    """One fee per statement with fees."""
    charged = with_sequence_id(statements.where("total_fees > 0"), ["statement_id"],
                               "fee_id", "FEE", 8)
    return charged.select("fee_id", "account_id", F.col("total_fees").alias("fee_amount"),
                          F.col("statement_date").alias("fee_date"))


def emi_plans(transactions: DataFrame) -> DataFrame:
    """Instalment plan figures for transactions with ``tenure_months`` and ``interest_rate``."""
    principal, tenure = F.col("transaction_amount"), F.col("tenure_months")
    return transactions.select(
        "transaction_id", "account_id", principal.alias("principal_amount"), "tenure_months",
        "interest_rate",
        rules.emi_installment(principal, F.col("interest_rate"), tenure).alias("monthly_installment"),
        F.col("transaction_date").alias("emi_start_date"),
        rules.emi_end_date(F.col("transaction_date"), tenure).alias("emi_end_date"),
        rules.emi_fee(principal).alias("processing_fee"))


def points_ledger(transactions: DataFrame, eligible: DataFrame, category: str = "mcc_code",
                  redeemed: Column | None = None) -> DataFrame:
    """Loyalty ledger: points of eligible categories with the balance after each posting.

    ``redeemed`` gives the points redeemed with a posting, by default none.
    """
    earning = transactions.join(eligible.select(category).distinct(), category, "left_semi")
    points = earning.withColumn("points_earned", rules.points_for(F.col("transaction_amount")))
    points = points.withColumn("points_redeemed",
                               (redeemed if redeemed is not None else F.lit(0)).cast("int"))
    balanced = running_sum(points, ["account_id"], ["transaction_date", "transaction_id"],
                           (F.col("points_earned") - F.col("points_redeemed")).cast("long"),
                           "points_balance")
    return balanced.select(
        "account_id", "transaction_id", "points_earned", "points_redeemed", "points_balance",
        "transaction_date", rules.points_expiry(F.col("transaction_date")).alias("expiry_date"))


def fraud_cases(alerts: DataFrame, transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """A case per confirmed alert, with the customer and the disputed amount."""
    confirmed = alerts.where(F.col("alert_status") == "CLOSED_CONFIRMED").select(
        "fraud_alert_id", "transaction_id", F.col("alert_date").cast("date").alias("case_open_date"))
    disputed = transactions.select("transaction_id", "account_id",
                                   F.col("transaction_amount").alias("disputed_amount"))
    cases = (confirmed.join(disputed, "transaction_id")
                      .join(accounts.select("account_id", "customer_id"), "account_id"))
    return with_sequence_id(cases, ["fraud_alert_id"], "fraud_case_id", "FC", 7).select(
        "fraud_case_id", "fraud_alert_id", "customer_id", "case_open_date", "disputed_amount",
        F.lit(True).alias("confirmed_fraud_flag"))


def chargebacks(cases: DataFrame, alerts: DataFrame) -> DataFrame:
    """A chargeback per case, on the transaction of its alert."""
    joined = cases.join(alerts.select("fraud_alert_id", "transaction_id"), "fraud_alert_id")
    return with_sequence_id(joined, ["fraud_case_id"], "chargeback_id", "CB", 7).select(
        "chargeback_id", "transaction_id", "fraud_case_id",
        rules.chargeback_date(F.col("case_open_date")).alias("chargeback_date"),
        F.col("disputed_amount").alias("chargeback_amount"))


def delinquency_buckets(delinquencies: DataFrame) -> DataFrame:
    return delinquencies.withColumn("dpd_bucket", rules.dpd_bucket(F.col("days_past_due")))


def collections_cases(delinquencies: DataFrame) -> DataFrame:
    """A collections case per delinquency, carrying the overdue amount."""
    cases = with_sequence_id(delinquencies, ["delinquency_id"], "collections_id", "COL", 7)
    return cases.select("collections_id", "account_id",
                        F.col("overdue_amount").alias("outstanding_balance"), "collections_status")


def write_offs(collections: DataFrame) -> DataFrame:
    """A write-off per collections case with that outcome."""
    lost = collections.where(F.col("collections_status") == "WRITTEN_OFF")
    return with_sequence_id(lost, ["collections_id"], "write_off_id", "WO", 7).select(
        "write_off_id", "account_id", F.col("outstanding_balance").alias("write_off_amount"))


def credit_limits(limits: DataFrame) -> DataFrame:
    """Available credit and cash advance limit from ``credit_limit_amount`` and ``used_amount``."""
    limit = F.col("credit_limit_amount")
    return limits.withColumns({
        "available_credit_amount": rules.available_credit(limit, F.col("used_amount")),
        "cash_advance_limit": rules.cash_limit(limit),
    })


def address_roles(addresses: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First address of a customer is the current, primary one; the others are previous."""
    flagged = flag_first(addresses, by, order, "is_primary")
    return flagged.withColumn("address_type", F.when(F.col("is_primary"), F.lit("CURRENT"))
                              .otherwise(F.lit("PREVIOUS")))


def statement_periods(accounts: DataFrame, last_day: str | dt.date | Column) -> DataFrame:
    """The rolling 30-day statement periods of every account, newest first."""
    last = last_day if isinstance(last_day, Column) else F.lit(last_day).cast("date")
    numbered = accounts.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(rules.STATEMENT_PERIODS - 1))).alias("period_no"))
    end = F.date_sub(last, (F.col("period_no") * rules.STATEMENT_DAYS).cast("int"))
    return numbered.withColumns({
        "statement_period_start": F.date_sub(end, rules.STATEMENT_DAYS),
        "statement_period_end": end,
    })
