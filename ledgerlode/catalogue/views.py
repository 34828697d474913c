"""The driver's tables read as card-business entities, in Spark and as SQL with the same columns.

Customers and suppliers are parties (accounts), orders are payments and statements, order lines are
transactions, charges and fees, and events are digital activity and fraud cases.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlode.operators import ordering, scd, star
from ledgerlode.plans.gold import FACTS
from ledgerlode.sources import files

FIRST, SECOND = "2001-01-01 00:00:00", "2001-08-02 00:00:00"
CALENDAR_2024 = ("2023-12-01", "2024-12-31")
TRACKED = ["party_name", "nation_key", "segment", "balance"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def money(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def share(amount: Column, rate: str) -> Column:
    return F.round(amount * F.col(rate).cast("decimal(4,2)"), 2).cast("decimal(18,2)")


def share_total(price: str, rate: str) -> Column:
    """The sum of ``share(money(price), rate)``. Numbers with two decimals, which most are, are multiplied and summed as whole
    cents; such a double is the one nearest to its cents, so that its decimal has no others."""
    def whole(name: str) -> Column:
        return F.rint(F.col(name) * 100)

    def plain(name: str, below: float) -> Column:
        return (whole(name) / 100 == F.col(name)) & (F.abs(whole(name)) < below)

    product = whole(price).cast("long") * whole(rate).cast("long")
    rounded = F.call_function("div", product + F.when(product < 0, F.lit(-50)).otherwise(F.lit(50)), F.lit(100))
    cents = F.when(plain(price, 1e13) & plain(rate, 1e4), rounded).otherwise((share(money(price), rate) * 100).cast("long"))
    return (F.sum(cents).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def party_id(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def parties_first(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(
        party_id("C", "c_custkey").alias("party_id"), F.col("c_name").alias("party_name"),
        F.col("c_nationkey").alias("nation_key"), F.col("c_mktsegment").alias("segment"),
        money("c_acctbal").alias("balance"))


def parties_second(spark, sf) -> DataFrame:
    """The next delivery: customers active in 2001, big spenders promoted, and all suppliers."""
    spend = (table(spark, sf, "orders").where(F.col("o_orderdate") >= ntz(FIRST))
             .groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("spend")))
    active = (table(spark, sf, "customer")
              .join(spend, F.col("c_custkey") == F.col("o_custkey"))
              .select(party_id("C", "c_custkey").alias("party_id"),
                      F.col("c_name").alias("party_name"),
                      F.col("c_nationkey").alias("nation_key"),
                      F.when(F.col("spend") > 400000, F.lit("PREMIUM"))
                       .otherwise(F.col("c_mktsegment")).alias("segment"),
                      money("c_acctbal").alias("balance")))
    suppliers = table(spark, sf, "supplier").select(
        party_id("S", "s_suppkey").alias("party_id"), F.col("s_name").alias("party_name"),
        F.col("s_nationkey").alias("nation_key"), F.lit("SUPPLIER").alias("segment"),
        money("s_acctbal").alias("balance"))
    return active.unionByName(suppliers)


def party_versions(spark, sf, with_action: bool = False) -> DataFrame:
    opened = scd.merge_scd2(None, parties_first(spark, sf), ["party_id"], TRACKED, ntz(FIRST))
    return scd.merge_scd2(opened, parties_second(spark, sf), ["party_id"], TRACKED, ntz(SECOND),
                          with_action=with_action)


class Dimensions:
    """The dimensions of one query, each derived and stored once however many facts look them up."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    @cached_property
    def account(self) -> DataFrame:
        silver = files.stored(party_versions(self.spark, self.sf), "silver-party")
        keyed = ordering.surrogate_key(silver.withColumnRenamed("party_id", "account_id"),
                                       ["account_id", scd.START], "account_sk")
        return files.stored(keyed, "dim-account")

    @cached_property
    def account_keys(self) -> DataFrame:
        """Id, key and flag alone, where nothing else of the account is asked for."""
        versions = party_versions(self.spark, self.sf).select(F.col("party_id").alias("account_id"), scd.START, scd.CURRENT)
        return ordering.surrogate_key(versions, ["account_id", scd.START], "account_sk")

    @property
    def customer(self) -> DataFrame:
        return self.account.withColumnsRenamed(
            {"account_id": "customer_id", "account_sk": "customer_sk"})

    @cached_property
    def card(self) -> DataFrame:
        """A card per customer and priority with a finished order."""
        cards = (table(self.spark, self.sf, "orders").where("o_orderstatus = 'F'")
                 .select(card_id().alias("card_id"), F.col("o_orderpriority").alias("card_type"))
                 .distinct())
        silver = files.stored(scd.stamp_scd2(cards, ["card_type"], ntz(FIRST)), "silver-card")
        return ordering.surrogate_key(silver, ["card_id", scd.START], "card_sk")

    @cached_property
    def merchant(self) -> DataFrame:
        """Suppliers in credit; the others count as no longer on board."""
        merchants = table(self.spark, self.sf, "supplier").where("s_acctbal >= 0").select(
            F.col("s_suppkey").alias("merchant_id"), F.col("s_name").alias("merchant_name"),
            F.col("s_nationkey").alias("nation_key"))
        return ordering.surrogate_key(merchants, ["merchant_id"], "merchant_sk")

    def lookup(self, name: str, key: str) -> tuple[DataFrame, str]:
        if name in ("account", "customer") and "account" not in self.__dict__:
            dim = self.account_keys.withColumnsRenamed({"account_id": key, "account_sk": f"{name}_sk"})
        else:
            dim = getattr(self, name)
        return star.current_lookup(dim, key, f"{name}_sk"), key

    def resolve(self, events: DataFrame, keys, columns, calendar: DataFrame | None = None,
                date_column: str | None = None) -> DataFrame:
        """Fact rows with the keys of the dimensions that are asked for; the others are not looked up."""
        lookups = [self.lookup(name, f"{name}_id") for name in keys]
        have = {*events.columns, "date_sk", *[f"{name}_sk" for name in keys]}
        return star.resolve_fact(events, lookups, [c for c in columns if c in have], calendar, date_column)


def card_id() -> Column:
    return F.concat(party_id("C", "o_custkey"), F.lit("/"), F.col("o_orderpriority"))


def calendar(spark, sf, name="orders", column="o_orderdate") -> DataFrame:
    """Every day from the first to the last date of a table."""
    day = F.col(column).cast("date")
    return star.calendar_of(table(spark, sf, name).agg(F.min(day).alias("first"), F.max(day).alias("last")))


def shipping_calendar(spark, sf) -> DataFrame:
    """The days of charges and fees."""
    return calendar(spark, sf, "lineitem", "l_shipdate")


def transaction_headers(spark, sf) -> DataFrame:
    """What the lines of an order share."""
    home = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return table(spark, sf, "orders").join(home, "o_custkey", "left").select(
        "o_orderkey", party_id("C", "o_custkey").alias("account_id"), card_id().alias("card_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"), F.col("o_orderstatus").alias("channel"), "c_nationkey")


def transaction_lines(spark, sf, headers: DataFrame) -> DataFrame:
    seller = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return (table(spark, sf, "lineitem").join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(seller, "l_suppkey", "left")
            .select(
                F.concat_ws("-", F.col("l_orderkey").cast("string"),
                            F.col("l_linenumber").cast("string")).alias("transaction_id"),
                F.col("l_suppkey").alias("merchant_id"), money("l_extendedprice").alias("transaction_amount"),
                F.lit("GBP").alias("transaction_currency"), F.col("l_returnflag").alias("transaction_type"),
                F.col("l_linestatus").alias("transaction_status"),
                (F.col("c_nationkey") != F.col("s_nationkey")).alias("is_international_flag"),
                *[c for c in headers.columns if c not in ("o_orderkey", "c_nationkey")]))


def transactions(spark, sf) -> DataFrame:
    return transaction_lines(spark, sf, transaction_headers(spark, sf))


def payments(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").where("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("payment_id"), party_id("C", "o_custkey").alias("account_id"),
        F.col("o_orderdate").cast("date").alias("payment_date"),
        money("o_totalprice").alias("payment_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderstatus").alias("payment_status"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_autopay_flag"))


def statements(spark, sf) -> DataFrame:
    price = money("l_extendedprice")
    sums = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(price).cast("decimal(18,2)").alias("total_purchases"),
        F.sum(share(price, "l_tax")).cast("decimal(18,2)").alias("total_fees"),
        F.sum(share(price, "l_discount")).cast("decimal(18,2)").alias("total_interest"))
    orders, people = table(spark, sf, "orders"), table(spark, sf, "customer")
    day = F.col("o_orderdate").cast("date")
    return (sums.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(people, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("statement_id"),
                    party_id("C", "o_custkey").alias("account_id"),
                    day.alias("statement_date"), day.alias("statement_period_end"),
                    money("c_acctbal").alias("opening_balance"), "total_purchases",
                    money("o_totalprice").alias("total_payments"), "total_fees", "total_interest"))


def fraud_case_versions(spark, sf) -> DataFrame:
    """Error events as cases, opened in a first batch; the large ones are closed by a second."""
    first = table(spark, sf, "events").where("event_type = 'error'").select(
        F.col("event_id").alias("fraud_case_id"), party_id("C", "user_id").alias("customer_id"),
        F.col("ts").cast("date").alias("case_open_date"), F.lit("ERROR").alias("fraud_type"),
        money("value").alias("disputed_amount"),
        F.lit(0).cast("decimal(18,2)").alias("recovery_amount"), F.lit("OPEN").alias("case_status"))
    second = first.where("disputed_amount > 20").withColumns({
        "recovery_amount": money(F.floor(F.col("disputed_amount") - 20)),
        "case_status": F.lit("CLOSED")})
    tracked = ["disputed_amount", "recovery_amount", "case_status"]
    opened = scd.merge_scd2(None, first, ["fraud_case_id"], tracked, ntz("2024-02-01 00:00:00"))
    return scd.merge_scd2(opened, second, ["fraud_case_id"], tracked, ntz("2024-03-01 00:00:00"))


def collections(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("collections_id"), party_id("C", "o_custkey").alias("account_id"),
        F.col("o_orderpriority").alias("collections_stage"),
        money("o_totalprice").alias("outstanding_balance"),
        F.round(money("o_totalprice") / F.lit(2), 2).cast("decimal(18,2)")
         .alias("promise_to_pay_amount"),
        F.col("o_orderstatus").alias("collections_status"))


def _charged_lines(spark, sf, accounts: bool) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    if not accounts:
        return lines.withColumn("account_id", F.lit(None).cast("string"))
    buyers = table(spark, sf, "orders").select("o_orderkey", party_id("C", "o_custkey").alias("account_id"))
    return lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))


def interest_charges(spark, sf, accounts: bool = True) -> DataFrame:
    """Interest on returned lines."""
    return (_charged_lines(spark, sf, accounts).where("l_returnflag = 'R'")
            .select("account_id", F.col("l_shipdate").cast("date").alias("charge_date"),
                    share(money("l_extendedprice"), "l_discount").alias("interest_amount")))


def fees(spark, sf, accounts: bool = True) -> DataFrame:
    """Fees on all lines that bear no interest."""
    return (_charged_lines(spark, sf, accounts).where("l_returnflag <> 'R'")
            .select("account_id", F.col("l_shipdate").cast("date").alias("fee_date"),
                    share(money("l_extendedprice"), "l_tax").alias("fee_amount")))


def fact_transaction(dims: Dimensions, keys=("account", "card", "merchant")) -> DataFrame:
    """Account, card and day are found for the orders, before their lines, of which there are several times as many."""
    headers = transaction_headers(dims.spark, dims.sf)
    own = ["o_orderkey", "c_nationkey", "channel", "account_sk", "card_sk", "date_sk"]
    resolved = dims.resolve(headers, [k for k in keys if k != "merchant"], own,
                            calendar(dims.spark, dims.sf), "transaction_date")
    lines = transaction_lines(dims.spark, dims.sf, resolved)
    return dims.resolve(lines, [k for k in keys if k == "merchant"], FACTS[0].columns)


# --- the same entities as SQL -----------------------------------------------------------------

DIGEST = ("sha256(concat_ws('||', party_name, CAST(nation_key AS VARCHAR), segment, "
          "CAST(balance AS VARCHAR)))")
CTES: dict[str, str] = {
    "parties1": """SELECT 'C' || c_custkey AS party_id, c_name AS party_name,
        c_nationkey AS nation_key, c_mktsegment AS segment,
        CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer""",
    "parties2": f"""SELECT 'C' || c_custkey AS party_id, c_name AS party_name,
        c_nationkey AS nation_key,
        CASE WHEN spend > 400000 THEN 'PREMIUM' ELSE c_mktsegment END AS segment,
        CAST(c_acctbal AS DECIMAL(18,2)) AS balance
        FROM customer JOIN (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spend
            FROM orders WHERE o_orderdate >= TIMESTAMP '{FIRST}' GROUP BY o_custkey)
          ON c_custkey = o_custkey
        UNION ALL SELECT 'S' || s_suppkey, s_name, s_nationkey, 'SUPPLIER',
        CAST(s_acctbal AS DECIMAL(18,2)) FROM supplier""",
    "hashed1": f"SELECT *, {DIGEST} AS row_hash FROM parties1",
    "hashed2": f"SELECT *, {DIGEST} AS row_hash FROM parties2",
    "versions": f"""SELECT a.party_id, a.party_name, a.nation_key, a.segment, a.balance,
        TIMESTAMP '{FIRST}' AS effective_start_date,
        CASE WHEN b.row_hash <> a.row_hash THEN TIMESTAMP '{SECOND}' END AS effective_end_date,
        COALESCE(b.row_hash = a.row_hash, TRUE) AS is_current_flag, a.row_hash
        FROM hashed1 a LEFT JOIN hashed2 b ON a.party_id = b.party_id
        UNION ALL SELECT b.party_id, b.party_name, b.nation_key, b.segment, b.balance,
        TIMESTAMP '{SECOND}', NULL, TRUE, b.row_hash
        FROM hashed2 b LEFT JOIN hashed1 a ON a.party_id = b.party_id
        WHERE a.party_id IS NULL OR a.row_hash <> b.row_hash""",
    "dim_account": """SELECT party_id AS account_id, * EXCLUDE (party_id),
        CAST(row_number() OVER (ORDER BY party_id, effective_start_date) AS BIGINT) AS account_sk
        FROM versions""",
    "account_now": "SELECT account_id, account_sk FROM dim_account WHERE is_current_flag",
    "dim_card": """SELECT card_id, card_type,
        CAST(row_number() OVER (ORDER BY card_id) AS BIGINT) AS card_sk FROM (
        SELECT DISTINCT 'C' || o_custkey || '/' || o_orderpriority AS card_id,
        o_orderpriority AS card_type FROM orders WHERE o_orderstatus = 'F')""",
    "dim_merchant": """SELECT s_suppkey AS merchant_id, s_name AS merchant_name,
        s_nationkey AS nation_key,
        CAST(row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS merchant_sk
        FROM supplier WHERE s_acctbal >= 0""",
    "calendar": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk,
        CAST(d AS DATE) AS calendar_date, CAST(year(d) AS INTEGER) AS year,
        CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month
        FROM (SELECT unnest(generate_series(date_trunc('day', min(o_orderdate)),
            date_trunc('day', max(o_orderdate)), INTERVAL 1 DAY)) AS d FROM orders)""",
    "shipping_calendar": """SELECT CAST(d AS DATE) AS calendar_date
        FROM (SELECT unnest(generate_series(date_trunc('day', min(l_shipdate)),
            date_trunc('day', max(l_shipdate)), INTERVAL 1 DAY)) AS d FROM lineitem)""",
    "calendar24": f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk,
        CAST(d AS DATE) AS calendar_date, CAST(weekofyear(d) AS INTEGER) AS week_of_year
        FROM generate_series(TIMESTAMP '{CALENDAR_2024[0]}', TIMESTAMP '{CALENDAR_2024[1]}',
        INTERVAL 1 DAY) t(d)""",
    "transactions": """SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
        'C' || o_custkey AS account_id, 'C' || o_custkey || '/' || o_orderpriority AS card_id,
        l_suppkey AS merchant_id, CAST(o_orderdate AS DATE) AS transaction_date,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS transaction_amount,
        'GBP' AS transaction_currency, l_returnflag AS transaction_type,
        l_linestatus AS transaction_status, o_orderstatus AS channel,
        c_nationkey <> s_nationkey AS is_international_flag
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "fact_transaction": """SELECT transaction_id, account_sk, card_sk, merchant_sk, date_sk,
        transaction_amount, transaction_currency, transaction_type, transaction_status, channel,
        is_international_flag
        FROM transactions t LEFT JOIN account_now USING (account_id)
        LEFT JOIN dim_card USING (card_id) LEFT JOIN dim_merchant USING (merchant_id)
        LEFT JOIN calendar ON transaction_date = calendar_date""",
    "payments": """SELECT o_orderkey AS payment_id, 'C' || o_custkey AS account_id,
        CAST(o_orderdate AS DATE) AS payment_date,
        CAST(o_totalprice AS DECIMAL(18,2)) AS payment_amount, o_orderpriority AS payment_method,
        o_orderstatus AS payment_status, o_orderpriority = '1-URGENT' AS is_autopay_flag
        FROM orders WHERE o_orderstatus <> 'O'""",
    "statements": """SELECT o_orderkey AS statement_id, 'C' || o_custkey AS account_id,
        CAST(o_orderdate AS DATE) AS statement_date,
        CAST(o_orderdate AS DATE) AS statement_period_end,
        CAST(c_acctbal AS DECIMAL(18,2)) AS opening_balance, total_purchases,
        CAST(o_totalprice AS DECIMAL(18,2)) AS total_payments, total_fees, total_interest
        FROM (SELECT l_orderkey,
            CAST(SUM(p) AS DECIMAL(18,2)) AS total_purchases,
            CAST(SUM(ROUND(p * CAST(l_tax AS DECIMAL(4,2)), 2)) AS DECIMAL(18,2)) AS total_fees,
            CAST(SUM(ROUND(p * CAST(l_discount AS DECIMAL(4,2)), 2)) AS DECIMAL(18,2))
              AS total_interest
            FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem)
            GROUP BY l_orderkey)
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "fraud": """SELECT event_id AS fraud_case_id, 'C' || user_id AS customer_id,
        CAST(ts AS DATE) AS case_open_date, 'ERROR' AS fraud_type, v AS disputed_amount,
        CAST(CASE WHEN v > 20 THEN floor(v - 20) ELSE 0 END AS DECIMAL(18,2)) AS recovery_amount,
        CASE WHEN v > 20 THEN 'CLOSED' ELSE 'OPEN' END AS case_status
        FROM (SELECT *, CAST(value AS DECIMAL(18,2)) AS v FROM events WHERE event_type = 'error')""",
    "collections": """SELECT o_orderkey AS collections_id, 'C' || o_custkey AS account_id,
        o_orderpriority AS collections_stage,
        CAST(o_totalprice AS DECIMAL(18,2)) AS outstanding_balance,
        CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * 0.5, 2) AS DECIMAL(18,2))
          AS promise_to_pay_amount,
        o_orderstatus AS collections_status FROM orders WHERE o_orderstatus = 'F'""",
    "interest": """SELECT 'C' || o_custkey AS account_id, CAST(l_shipdate AS DATE) AS charge_date,
        ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
          AS interest_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R'""",
    "fees": """SELECT 'C' || o_custkey AS account_id, CAST(l_shipdate AS DATE) AS fee_date,
        ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS fee_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'""",
    "revenue": """SELECT account_id,
        CAST(COALESCE(i, 0) AS DECIMAL(18,2)) AS total_interest_revenue,
        CAST(COALESCE(f, 0) AS DECIMAL(18,2)) AS total_fee_revenue, account_sk,
        CAST(COALESCE(i, 0) + COALESCE(f, 0) AS DECIMAL(18,2)) AS total_revenue
        FROM (SELECT account_id, SUM(interest_amount) AS i FROM interest GROUP BY account_id)
        FULL JOIN (SELECT account_id, SUM(fee_amount) AS f FROM fees GROUP BY account_id)
          USING (account_id)
        LEFT JOIN account_now USING (account_id)""",
    "revenue_monthly": """SELECT account_id, m AS revenue_month,
        CAST(COALESCE(i, 0) AS DECIMAL(18,2)) AS total_interest_revenue,
        CAST(COALESCE(f, 0) AS DECIMAL(18,2)) AS total_fee_revenue, account_sk,
        CAST(COALESCE(i, 0) + COALESCE(f, 0) AS DECIMAL(18,2)) AS total_revenue
        FROM (SELECT account_id, CAST(date_trunc('month', charge_date) AS DATE) AS m,
                SUM(interest_amount) AS i FROM interest GROUP BY ALL)
        FULL JOIN (SELECT account_id, CAST(date_trunc('month', fee_date) AS DATE) AS m,
                SUM(fee_amount) AS f FROM fees GROUP BY ALL) USING (account_id, m)
        LEFT JOIN account_now USING (account_id)""",
}
_NEEDS = {
    "hashed1": ["parties1"], "hashed2": ["parties2"], "versions": ["hashed1", "hashed2"],
    "dim_account": ["versions"], "account_now": ["dim_account"],
    "fact_transaction": ["transactions", "account_now", "dim_card", "dim_merchant", "calendar"],
    "revenue": ["interest", "fees", "account_now"],
    "revenue_monthly": ["interest", "fees", "account_now"],
}


def sql(select: str, *needs: str) -> str:
    """The statement with the named entities, and what they build on, in front of it."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for below in _NEEDS.get(name, ()):
            add(below)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + select
