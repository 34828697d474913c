"""The gold model: which dimensions and facts are built from which silver tables."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dimension:
    name: str
    silver: str
    natural_key: str
    sk: str
    history: bool


@dataclass(frozen=True)
class AtEvent:
    """Columns of a dimension as they were when the fact happened: its versions are joined on ``key`` by the time in
    ``event_time``. ``columns`` maps the dimension's columns to those of the fact."""

    dimension: str
    key: str
    event_time: str
    columns: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Fact:
    name: str
    silver: str
    dimensions: tuple[str, ...]
    date_column: str | None
    columns: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    at_event: tuple[AtEvent, ...] = ()


# Names, keys and columns of the gold tables.
DIMENSIONS = [
    Dimension("DimCustomer", "silver_customer", "customer_id", "customer_sk", True),
    Dimension("DimAccount", "silver_account", "account_id", "account_sk", True),
    Dimension("DimCard", "silver_credit_card", "card_id", "card_sk", True),
    Dimension("DimProduct", "silver_card_product", "product_id", "product_sk", True),
    Dimension("DimRisk", "silver_customer_risk_profile", "risk_profile_id", "risk_sk", True),
    Dimension("DimBranch", "silver_branch", "branch_id", "branch_sk", True),
    Dimension("DimMerchant", "silver_merchant", "merchant_id", "merchant_sk", False),
    Dimension("DimCurrency", "silver_currency", "currency_code", "currency_sk", False),
    Dimension("DimCampaign", "silver_campaign", "campaign_id", "campaign_sk", False),
    Dimension("DimGeography", "silver_geography", "geography_id", "geography_sk", False),
]
FACTS = [
    Fact("FactTransaction", "silver_transaction", ("DimAccount", "DimCard", "DimMerchant"),
         "transaction_date",
         ("transaction_id", "account_sk", "card_sk", "merchant_sk", "date_sk", "transaction_amount",
          "transaction_currency", "transaction_type", "transaction_status", "channel",
          "is_international_flag"),
         ("date_sk",)),
    Fact("FactPayment", "silver_payment", ("DimAccount",), "payment_date",
         ("payment_id", "account_sk", "date_sk", "payment_amount", "payment_method", "payment_status",
          "is_autopay_flag")),
    Fact("FactStatement", "silver_statement", ("DimAccount",), "statement_date",
         ("statement_id", "account_sk", "date_sk", "opening_balance", "closing_balance", "total_purchases",
          "total_payments", "total_fees", "total_interest", "minimum_payment_due")),
    Fact("FactFraud", "silver_fraud_case", ("DimCustomer",), "case_open_date",
         ("fraud_case_id", "customer_sk", "date_sk", "fraud_type", "disputed_amount", "recovery_amount",
          "case_status")),
    Fact("FactCollections", "silver_collections", ("DimAccount",), None,
         ("collections_id", "account_sk", "collections_stage", "outstanding_balance",
          "promise_to_pay_amount", "collections_status")),
]
#: Columns of the facts whose NULL rate the gate checks on request.
NULL_CHECKS = {
    "FactTransaction": ("transaction_amount", "transaction_type"),
    "FactPayment": ("payment_amount",),
    "FactStatement": ("closing_balance",),
    "FactFraud": ("fraud_type",),
    "FactCollections": ("outstanding_balance",),
}
# The gate's foreign keys, and further ones that are checked on request.
GATE_REFERENCES = {
    "FactTransaction": [("account_sk", "DimAccount"), ("card_sk", "DimCard")],
    "FactPayment": [("account_sk", "DimAccount")],
    "FactStatement": [("account_sk", "DimAccount")],
    "FactFraud": [("customer_sk", "DimCustomer")],
    "FactCollections": [("account_sk", "DimAccount")],
}
EXTENDED_REFERENCES = {
    "FactTransaction": [("merchant_sk", "DimMerchant"), ("date_sk", "DimDate")],
    "FactPayment": [("date_sk", "DimDate")],
    "FactStatement": [("date_sk", "DimDate")],
    "FactFraud": [("date_sk", "DimDate")],
    "FactRevenue": [("account_sk", "DimAccount")],
}
