"""The whole flow, landing to gate, over two daily batches derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlode.catalogue.registry import query
from ledgerlode.catalogue.views import money, party_id, share_total, table
from ledgerlode.operators import measures
from ledgerlode.plans import gold
from ledgerlode.plans.jobs import Lake, read_gold, run_batch
from ledgerlode.sources import files
from ledgerlode.sources.config import TableConfig

_KEYS = {
    "customer": ("customer_id", 2, "DIM"), "account": ("account_id", 2, "DIM"),
    "credit_card": ("card_id", 2, "DIM"), "merchant": ("merchant_id", 1, "DIM"),
    "transaction": ("transaction_id", 1, "FACT"),
    "interest_charge": ("interest_charge_id", 1, "FACT"), "fee": ("fee_id", 1, "FACT"),
}


def config(name: str) -> TableConfig:
    key, scd_type, role = _KEYS[name]
    return TableConfig(name, "CORE", role, key, scd_type, (key,), "", f"silver_{name}",
                       f"bronze_{name}", True)


def _charges(spark, sf):
    """Orders with what their lines come to, stored once for the three tables and two days that tell it."""
    sums = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        share_total("l_extendedprice", "l_discount").alias("i"), share_total("l_extendedprice", "l_tax").alias("f"),
        F.min("l_suppkey").alias("seller"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                                               "o_orderstatus", "o_orderpriority")
    return files.stored(orders.join(sums, "o_orderkey"), "charges", None, files.CODEC)


def _extracts(spark, sf, second: bool, charges=None):
    """Source extracts of one day. The second day promotes customers and delivers the later orders."""
    people = table(spark, sf, "customer")
    split = F.lit("2000-01-01").cast("timestamp_ntz")
    of_day = F.col("o_orderdate") >= split if second else F.col("o_orderdate") < split
    orders = table(spark, sf, "orders").where(of_day)
    segment = F.col("c_mktsegment")
    if second:
        segment = F.when(F.col("c_acctbal") > 5000, F.lit("PREMIUM")).otherwise(segment)
    card = F.concat(party_id("A", "o_custkey"), F.lit("/"), F.col("o_orderpriority"))
    charges = (charges if charges is not None else _charges(spark, sf)).where(of_day)
    account, day = party_id("A", "o_custkey"), F.col("o_orderdate").cast("date")
    return {
        "customer": people.select(party_id("C", "c_custkey").alias("customer_id"),
                                  F.concat(F.lit(" "), segment).alias("customer_segment")),
        "account": people.select(
            party_id("A", "c_custkey").alias("account_id"),
            party_id("C", "c_custkey").alias("customer_id"),
            F.when(F.col("c_acctbal") >= 0, F.lit("ACTIVE")).otherwise(F.lit("CLOSED"))
             .alias("account_status")),
        "credit_card": orders.select(card.alias("card_id"),
                                     F.col("o_orderpriority").alias("card_type")).distinct(),
        "merchant": table(spark, sf, "supplier").select(
            party_id("S", "s_suppkey").alias("merchant_id"), F.col("s_name").alias("merchant_name")),
        "transaction": charges.select(
            party_id("T", "o_orderkey").alias("transaction_id"), account.alias("account_id"),
            card.alias("card_id"), party_id("S", "seller").alias("merchant_id"),
            day.alias("transaction_date"), money("o_totalprice").alias("transaction_amount"),
            F.lit("GBP").alias("transaction_currency"), F.lit("SALE").alias("transaction_type"),
            F.col("o_orderstatus").alias("transaction_status"), F.lit("POS").alias("channel"),
            F.lit(False).alias("is_international_flag")),
        "interest_charge": charges.select(
            party_id("I", "o_orderkey").alias("interest_charge_id"), account.alias("account_id"),
            day.alias("charge_date"), F.col("i").alias("interest_amount")),
        "fee": charges.select(party_id("F", "o_orderkey").alias("fee_id"),
                              account.alias("account_id"), day.alias("fee_date"),
                              F.col("f").alias("fee_amount")),
    }


@query("""WITH lines AS (SELECT l_orderkey,
      SUM(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)) AS i,
      SUM(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)) AS f
      FROM lineitem GROUP BY ALL),
    people AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 'ACTIVE' ELSE 'CLOSED' END
        AS account_status,
      CASE WHEN c_acctbal > 5000 THEN 'PREMIUM' ELSE c_mktsegment END AS customer_segment
      FROM customer)
    SELECT account_status, customer_segment, count(*) AS "Total Transactions",
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS "Total Transaction Amount",
    CAST(SUM(i + f) AS DECIMAL(38,2)) AS "Total Revenue"
    FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN people ON o_custkey = c_custkey
    GROUP BY ALL""")
def batch_job(spark, sf):
    lake = Lake(spark, files.shared_root(spark, "lake"), "daily", "2001-08-02", "2001-08-02 06:00:00")
    wanted = {"DimCustomer", "DimAccount", "DimCard", "DimMerchant"}
    options = {"dimensions": [d for d in gold.DIMENSIONS if d.name in wanted],
               "facts": [gold.FACTS[0]], "calendar": None,
               "date_partition": "month"}
    references = {"FactTransaction": gold.GATE_REFERENCES["FactTransaction"]
                  + gold.EXTENDED_REFERENCES["FactTransaction"]}
    by_month, charges = {"month_of": "transaction_date"}, _charges(spark, sf)
    for batch_id, second in (("20010801_001", False), ("20010802_001", True)):
        lake.load_ts = f"{batch_id[:4]}-{batch_id[4:6]}-{batch_id[6:8]} 06:00:00"
        tables = [(config(n), df) for n, df in _extracts(spark, sf, second, charges).items()]
        run_batch(lake, batch_id, tables, silver_options={"transaction": by_month},
                  gold_options=options, references=references)
    star = {n: read_gold(lake, n) for n in [*wanted, "FactTransaction", "FactRevenue", "DimDate"]}
    report = measures.measure_table(
        star, ["Total Transactions", "Total Transaction Amount", "Total Revenue"],
        ["DimAccount.account_status", "DimCustomer.customer_segment"])
    money_columns = ["Total Transaction Amount", "Total Revenue"]
    return report.withColumns({c: F.col(f"`{c}`").cast("decimal(38,2)") for c in money_columns})
