"""Business rules as column expressions. Thresholds and factors are fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Upper bounds (exclusive) of the days-past-due buckets; lower bounds of the grades.
DPD_BUCKETS = [(30, "1-29"), (60, "30-59"), (90, "60-89"), (120, "90-119")]
DPD_LAST = "120+"
RISK_GRADES = [(800, "A"), (650, "B"), (500, "C")]
RISK_LAST = "D"
# Amounts, shares and day counts.
MINIMUM_DUE_FLOOR = 25
MINIMUM_DUE_SHARE = "0.03"
PAYMENT_DUE_DAYS = 21
STATEMENT_DAYS = 30
STATEMENT_PERIODS = 12
EMI_FEE_SHARE = "0.02"
POINTS_VALID_DAYS = 1095
CHARGEBACK_DAYS = 2
CASH_SHARE = "0.30"
NET_SHARE = "0.72"
DAYS_PER_YEAR = 365.25
CARD_YEARS = 4
CARD_LAST_DAY = 28


def _decimal(text: str, precision: int = 6, scale: int = 2) -> Column:
    return F.lit(text).cast(f"decimal({precision},{scale})")


def _money(value: Column) -> Column:
    return F.round(value, 2).cast("decimal(18,2)")


def dpd_bucket(days: Column) -> Column:
    steps = F.when(days.isNull(), F.lit(None).cast("string"))
    for bound, label in DPD_BUCKETS:
        steps = steps.when(days < bound, F.lit(label))
    return steps.otherwise(F.lit(DPD_LAST))


def risk_grade(score: Column) -> Column:
    steps = F.when(score.isNull(), F.lit(None).cast("string"))
    for bound, label in RISK_GRADES:
        steps = steps.when(score > bound, F.lit(label))
    return steps.otherwise(F.lit(RISK_LAST))


def closing_balance(opening: Column, purchases: Column, payments: Column, fees: Column,
                    interest: Column) -> Column:
    return _money(opening + purchases - payments + fees + interest)


def minimum_due(closing: Column) -> Column:
    return _money(F.greatest(F.lit(MINIMUM_DUE_FLOOR).cast("decimal(18,2)"),
                             closing * _decimal(MINIMUM_DUE_SHARE)))


def payment_due_date(period_end: Column) -> Column:
    return F.date_add(period_end, PAYMENT_DUE_DAYS)


def emi_installment(principal: Column, annual_rate: Column, tenure: Column) -> Column:
    """Flat-rate instalment; ``annual_rate`` is in percent."""
    factor = _decimal("1") + annual_rate.cast("decimal(9,3)") * _decimal("0.01")
    owed = (principal.cast("decimal(18,2)") * factor).cast("decimal(27,7)")   # keeps the quotient exact
    return _money(owed / tenure.cast("decimal(5,0)"))


def emi_end_date(start: Column, tenure: Column) -> Column:
    return F.date_add(start, (tenure * STATEMENT_DAYS).cast("int"))


def emi_fee(principal: Column) -> Column:
    return _money(principal * _decimal(EMI_FEE_SHARE))


def points_for(amount: Column) -> Column:
    return amount.cast("int")


def points_expiry(date: Column) -> Column:
    return F.date_add(date, POINTS_VALID_DAYS)


def chargeback_date(case_open: Column) -> Column:
    return F.date_add(case_open, CHARGEBACK_DAYS)


def available_credit(limit: Column, used: Column) -> Column:
    return _money(limit - used)


def cash_limit(limit: Column) -> Column:
    return _money(limit * _decimal(CASH_SHARE))


def net_monthly_income(gross: Column) -> Column:
    return _money(gross * _decimal(NET_SHARE) / F.lit(12).cast("decimal(5,0)"))


def years_between(start: Column, as_of: Column) -> Column:
    return F.round(F.datediff(as_of, start) / F.lit(DAYS_PER_YEAR), 1)


def card_expiry(issue: Column) -> Column:
    return F.make_date(F.year(issue) + CARD_YEARS, F.month(issue),
                       F.least(F.day(issue), F.lit(CARD_LAST_DAY)))
