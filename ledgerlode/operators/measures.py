"""Measure layer: named aggregates over the star, evaluated per group of dimension attributes.

A measure is a set of additive parts on one table (its partial sums and counts) and an expression over
the parts. Evaluation aggregates a fact to its foreign keys first, joins the dimensions to that, and
adds up; parts of several facts meet by UNION ALL and one last aggregation at the shared grain. Hot
accounts or days therefore collapse before any shuffle, and facts are never joined to each other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlode.functions.exprs import safe_divide
from ledgerlode.operators.scd import current_versions
from ledgerlode.operators.star import snowflake

# The model's relationships. Fact table -> {dimension: surrogate key}.
FACT_KEYS: dict[str, dict[str, str]] = {
    "FactTransaction": {"DimDate": "date_sk", "DimAccount": "account_sk", "DimCard": "card_sk",
                        "DimMerchant": "merchant_sk"},
    "FactPayment": {"DimDate": "date_sk", "DimAccount": "account_sk"},
    "FactStatement": {"DimDate": "date_sk", "DimAccount": "account_sk"},
    "FactFraud": {"DimDate": "date_sk", "DimCustomer": "customer_sk"},
    "FactCollections": {"DimAccount": "account_sk"},
    "FactRevenue": {"DimAccount": "account_sk"},
}
# Dimension -> {parent dimension: natural key}.
DIM_PARENTS: dict[str, dict[str, str]] = {
    "DimAccount": {"DimProduct": "product_id", "DimCustomer": "customer_id"},
}


@dataclass(frozen=True)
class Part:
    """One additive ingredient. ``distinct`` parts count distinct values of ``expr`` instead."""

    table: str
    kind: str                                   # sum | count | distinct
    expr: Callable[[], Column] = field(default=lambda: F.lit(1))
    where: Callable[[], Column] | None = None

    def value(self) -> Column:
        return F.when(self.where(), self.expr()) if self.where else self.expr()

    def aggregate(self) -> Column:
        if self.kind == "sum":
            return F.sum(self.value())
        if self.kind == "distinct":
            return F.count_distinct(self.value())
        return F.count(self.value())


@dataclass(frozen=True)
class Measure:
    parts: Mapping[str, Part]
    result: Callable[[], Column]
    display: str = "0"


def _sum(table: str, column: str) -> Part:
    return Part(table, "sum", lambda: F.col(column))


def _count(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast("long")


def _simple(part_name: str, part: Part, display: str) -> Measure:
    result = (lambda: F.col(part_name)) if part.kind == "sum" else (lambda: _count(part_name))
    return Measure({part_name: part}, result, display)


_AMOUNT = _sum("FactTransaction", "transaction_amount")
_TXNS = Part("FactTransaction", "count")
_DISPUTED = _sum("FactFraud", "disputed_amount")

# Measure names, their definitions and display formats.
MEASURES: dict[str, Measure] = {
    "Total Transaction Amount": _simple("txn_amount", _AMOUNT, "0.00"),
    "Total Transactions": _simple("txn_rows", _TXNS, "0"),
    "Total Customers": _simple(
        "customers", Part("DimCustomer", "distinct", lambda: F.col("customer_id")), "0"),
    "Active Accounts": _simple(
        "active_accounts",
        Part("DimAccount", "distinct", lambda: F.col("account_id"),
             lambda: F.col("account_status") == "ACTIVE"), "0"),
    "Total Payments": _simple("payments", _sum("FactPayment", "payment_amount"), "0.00"),
    "Total Fee Revenue": _simple("fees", _sum("FactRevenue", "total_fee_revenue"), "0.00"),
    "Total Interest Revenue": _simple(
        "interest", _sum("FactRevenue", "total_interest_revenue"), "0.00"),
    "Total Revenue": _simple("revenue", _sum("FactRevenue", "total_revenue"), "0.00"),
    "Total Disputed Fraud Amount": _simple("disputed", _DISPUTED, "0.00"),
    "Fraud Case Count": _simple("fraud_rows", Part("FactFraud", "count"), "0"),
    "Fraud Loss Rate": Measure(
        {"disputed": _DISPUTED, "recovered": _sum("FactFraud", "recovery_amount"),
         "txn_amount": _AMOUNT},
        lambda: safe_divide(
            F.coalesce("disputed", F.lit(0)) - F.coalesce("recovered", F.lit(0)),
            F.col("txn_amount")),
        "0.00%"),
    "Total Outstanding Collections": _simple(
        "outstanding", _sum("FactCollections", "outstanding_balance"), "0.00"),
    "International Transaction %": Measure(
        {"intl_rows": Part("FactTransaction", "count",
                           where=lambda: F.col("is_international_flag")),
         "txn_rows": _TXNS},
        lambda: safe_divide(_count("intl_rows"), F.col("txn_rows")),
        "0.00%"),
    "Average Transaction Value": Measure(
        {"txn_amount": _AMOUNT,
         "txn_valued": Part("FactTransaction", "count", lambda: F.col("transaction_amount"))},
        lambda: F.when(F.col("txn_valued") > 0,
                       F.col("txn_amount").cast("double") / F.col("txn_valued")),
        "0.00"),
}


def measure_table(star: Mapping[str, DataFrame], names: Sequence[str],
                  by: Sequence[str] = (), current_only: bool = False) -> DataFrame:
    """Evaluate measures grouped by dimension attributes given as ``Dimension.column``.

    Result columns: the attributes (named by their column) and one column per measure name. With
    ``current_only`` the distinct counts over dimensions read current versions only.
    """
    attributes = [tuple(b.split(".", 1)) for b in by]
    parts: dict[str, Part] = {}
    for name in names:
        parts.update(MEASURES[name].parts)
    by_table: dict[str, dict[str, Part]] = {}
    for part_name, part in parts.items():
        by_table.setdefault(part.table, {})[part_name] = part
    frames = [_partials(star, table, group, attributes, current_only)
              for table, group in by_table.items()]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    columns = [c for _, c in attributes]
    totals = merged.groupBy(*columns).agg(*[F.sum(p).alias(p) for p in parts])
    return totals.select(*columns, *[MEASURES[n].result().alias(n) for n in names])


def _partials(star: Mapping[str, DataFrame], table: str, parts: Mapping[str, Part],
              attributes: list[tuple[str, str]], current_only: bool) -> DataFrame:
    columns = [c for _, c in attributes]
    if table in FACT_KEYS:
        return _fact_partials(star, table, parts, attributes)
    frame = star[table]
    if current_only:
        frame = current_versions(frame)
    own = [c for d, c in attributes if d == table]
    for parent, natural_key in DIM_PARENTS.get(table, {}).items():
        wanted = [c for d, c in attributes if d == parent]
        if wanted:
            frame = snowflake(frame, star[parent], natural_key, wanted)
            own += wanted
    missing = set(columns) - set(own)
    if missing:
        raise ValueError(f"{table} cannot be grouped by {sorted(missing)}")
    return frame.groupBy(*columns).agg(*[p.aggregate().alias(n) for n, p in parts.items()])


def _fact_partials(star: Mapping[str, DataFrame], table: str, parts: Mapping[str, Part],
                   attributes: list[tuple[str, str]]) -> DataFrame:
    """Partial sums of a fact per group of attributes.

    The calendar joins first: it is small whatever the data, and its attributes are far coarser than
    its days. The fact then shrinks to one row per remaining key and calendar attribute, with a
    map-side combine, and only that meets the other dimensions.
    """
    columns = [c for _, c in attributes]
    keys = _needed_keys(table, attributes)
    fact, grain = star[table], []
    for dim, key in FACT_KEYS[table].items():
        if key not in keys:
            continue
        if dim == "DimDate":
            fact = fact.join(F.broadcast(_attributes(star, dim, key, attributes)), key, "left")
            grain += [c for d, c in attributes if d == dim]
        else:
            grain.append(key)
    grouped = fact.groupBy(*grain).agg(*[p.aggregate().alias(n) for n, p in parts.items()])
    others = [(d, k) for d, k in FACT_KEYS[table].items() if k in keys and d != "DimDate"]
    if not others:
        return grouped
    for dim, key in others:
        grouped = grouped.join(_attributes(star, dim, key, attributes), key, "left")
    return grouped.groupBy(*columns).agg(*[F.sum(n).alias(n) for n in parts])


def _needed_keys(table: str, attributes: list[tuple[str, str]]) -> list[str]:
    keys: list[str] = []
    for dim, column in attributes:
        direct = FACT_KEYS[table].get(dim)
        via = [key for child, key in FACT_KEYS[table].items() if dim in DIM_PARENTS.get(child, {})]
        key = direct or (via[0] if via else None)
        if key is None:
            raise ValueError(f"{table} has no path to {dim}.{column}")
        if key not in keys:
            keys.append(key)
    return keys


def _attributes(star: Mapping[str, DataFrame], dim: str, key: str,
                attributes: list[tuple[str, str]]) -> DataFrame:
    """Surrogate key of a dimension with the requested attributes of it and of its parents."""
    frame = star[dim]
    own = [c for d, c in attributes if d == dim]
    parents = {p: nk for p, nk in DIM_PARENTS.get(dim, {}).items()
               if any(d == p for d, _ in attributes)}
    frame = frame.select(key, *dict.fromkeys([*own, *parents.values()]))
    for parent, natural_key in parents.items():
        wanted = [c for d, c in attributes if d == parent]
        frame = snowflake(frame, star[parent], natural_key, wanted)
    columns = [c for d, c in attributes if d == dim or d in parents]
    return frame.select(key, *columns)


def formatted(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Measures as display text, for the last step before a report only."""
    def text(name: str) -> Column:
        display, value = MEASURES[name].display, F.col(f"`{name}`")
        if display == "0.00%":
            return F.concat(F.format_number(value * 100, 2), F.lit("%"))
        return F.format_number(value, 2 if display == "0.00" else 0)
    return df.withColumns({n: text(n) for n in names})


def implicit_sums(fact: DataFrame, sums: Sequence[str], averages: Sequence[str] = ()) -> DataFrame:
    """Default aggregation of model columns: sums for amounts, averages for rates and scores."""
    return fact.agg(*[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in averages])


def count_to_date(fact: DataFrame, calendar: DataFrame, kind: str, name: str) -> DataFrame:
    """Row count from the start of the month or year to each calendar day (every day is present).

    The fact is counted per day first. The running sums work on one row per day, cut by year or month.
    """
    period = {"MTD": ["year", "month"], "YTD": ["year"]}[kind]
    daily = fact.groupBy("date_sk").agg(F.count(F.lit(1)).alias("__n"))
    days = calendar.select("date_sk", "calendar_date", "year", "month").join(daily, "date_sk", "left")
    so_far = (Window.partitionBy(*period).orderBy("calendar_date")
              .rowsBetween(Window.unboundedPreceding, 0))
    running = F.sum(F.coalesce("__n", F.lit(0))).over(so_far).cast("long")
    return days.select("calendar_date", running.alias(name))


def prior_month(monthly: DataFrame, calendar: DataFrame, month_column: str, value: str,
                name: str) -> DataFrame:
    """Value of each calendar month next to that of the month before; months without rows are NULL.

    The month spine makes the shift safe across gaps, and an equi join on the shifted month replaces a
    window over all months.
    """
    totals = monthly.groupBy(F.col(month_column).alias("__m")).agg(F.sum(value).alias("__v"))
    spine = calendar.select(F.trunc("calendar_date", "MM").alias("month_start")).distinct()
    now = totals.select(F.col("__m").alias("month_start"), F.col("__v").alias(value))
    before = totals.select(F.add_months("__m", 1).alias("month_start"), F.col("__v").alias(name))
    return spine.join(now, "month_start", "left").join(before, "month_start", "left")


# The time-intelligence measures.
TIME_MEASURES = ("Transactions MTD", "Transactions YTD", "Revenue Prior Month")


def time_measure(name: str, star: Mapping[str, DataFrame]) -> DataFrame:
    """Evaluate a time-intelligence measure on every day (to date) or month (prior month) of DimDate.

    The prior month needs the monthly revenue fact: revenue per account alone carries no date.
    """
    if name == "Revenue Prior Month":
        return prior_month(star["FactRevenue"].withColumnRenamed("total_revenue", "Total Revenue"),
                           star["DimDate"], "revenue_month", "Total Revenue", name)
    if name in TIME_MEASURES:
        return count_to_date(star["FactTransaction"], star["DimDate"], name.split()[-1], name)
    raise ValueError(f"unknown time measure: {name!r}")
