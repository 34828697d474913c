"""The whole gold model through the configured batch job, in bucketed catalog tables, over two deliveries.

The second delivery changes customers and their risk. One lake serves all queries of a session over a folder.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlode.catalogue.registry import query
from ledgerlode.catalogue.views import card_id, money, party_id, share_total, table
from ledgerlode.operators import measures, quality, rows
from ledgerlode.plans import gold
from ledgerlode.plans.jobs import Lake, read_gold, read_silver, run_batch, run_configured, validate_gold
from ledgerlode.sources import files
from ledgerlode.sources.config import TableConfig, table_config

FIRST, SECOND = "2023-12-31 06:00:00", "2024-01-15 06:00:00"
FRAUD_AT_EVENT = replace(
    next(f for f in gold.FACTS if f.name == "FactFraud"), name="FactFraudAtEvent",
    columns=("fraud_case_id", "customer_sk", "date_sk", "risk_grade_then"),
    at_event=(gold.AtEvent("DimRisk", "customer_id", "case_open_date", (("risk_grade", "risk_grade_then"),)),))
# (name, key, type of history, role, active)
_RECORDS = [
    ("customer", "customer_id", 2, "DIM", True), ("account", "account_id", 2, "DIM", True),
    ("credit_card", "card_id", 2, "DIM", True), ("card_product", "product_id", 2, "DIM", True),
    ("customer_risk_profile", "risk_profile_id", 2, "DIM", True), ("branch", "branch_id", 2, "DIM", True),
    ("merchant", "merchant_id", 1, "DIM", True), ("currency", "currency_code", 1, "DIM", True),
    ("campaign", "campaign_id", 1, "DIM", True), ("geography", "geography_id", 1, "DIM", True),
    ("transaction", "transaction_id", 1, "FACT", True), ("payment", "payment_id", 1, "FACT", True),
    ("statement", "statement_id", 1, "FACT", True), ("fraud_case", "fraud_case_id", 1, "FACT", True),
    ("collections", "collections_id", 1, "FACT", True), ("interest_charge", "interest_charge_id", 1, "FACT", True),
    ("fee", "fee_id", 1, "FACT", True), ("telephone_call", "call_id", 1, "FACT", False),
]
_SECOND = ("customer", "customer_risk_profile")
RICH = 5000


def charged_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with what their lines come to: seller, interest and fee. Four of the tables are made of them."""
    sums = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_suppkey").alias("seller"),
        *[share_total("l_extendedprice", rate).alias(rate) for rate in ("l_discount", "l_tax")])
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                               "o_orderpriority", "o_totalprice")
    return orders.hint("merge").join(sums, "o_orderkey")              # compressed files would let a large side be broadcast


def extract(spark: SparkSession, sf: str, name: str, second: bool = False, charged: DataFrame | None = None) -> DataFrame:
    """What the source system delivers for a table. Give ``charged``, the stored ``charged_orders``, for several tables."""
    people, orders, nations = (table(spark, sf, n) for n in ("customer", "orders", "nation"))
    rich = F.col("c_acctbal") > RICH
    account, day = party_id("A", "o_custkey").alias("account_id"), F.col("o_orderdate").cast("date")
    total = money("o_totalprice")

    def of_lines(rate: str | None = None) -> DataFrame:
        known = charged if charged is not None else charged_orders(spark, sf)
        return known if rate is None else known.withColumn("amount", F.col(rate))

    if name == "customer":
        segment = F.when(rich, F.lit("PREMIUM")).otherwise(F.col("c_mktsegment")) if second else F.col("c_mktsegment")
        return people.select(party_id("C", "c_custkey").alias("customer_id"), segment.alias("customer_segment"))
    if name == "customer_risk_profile":
        grade = F.when(F.col("c_acctbal") >= 0, F.lit("A")).otherwise(F.lit("D"))
        grade = F.when(rich, F.lit("B")).otherwise(grade) if second else grade
        return people.select(party_id("R", "c_custkey").alias("risk_profile_id"),
                             party_id("C", "c_custkey").alias("customer_id"), grade.alias("risk_grade"))
    if name == "account":
        places = nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
        return people.join(places, "c_nationkey", "left").select(
            party_id("A", "c_custkey").alias("account_id"), party_id("C", "c_custkey").alias("customer_id"),
            party_id("P", "n_regionkey").alias("product_id"),
            F.when(F.col("c_acctbal") >= 0, F.lit("ACTIVE")).otherwise(F.lit("CLOSED")).alias("account_status"))
    if name == "credit_card":
        return orders.select(card_id().alias("card_id"), F.col("o_orderpriority").alias("card_type")).distinct()
    if name == "card_product":
        return table(spark, sf, "region").select(party_id("P", "r_regionkey").alias("product_id"),
                                                 F.col("r_name").alias("product_name"))
    if name == "currency":
        return table(spark, sf, "region").select(F.substring("r_name", 1, 3).alias("currency_code"),
                                                 F.col("r_name").alias("currency_name"))
    if name in ("branch", "geography"):
        return nations.select(party_id(name[0].upper(), "n_nationkey").alias(f"{name}_id"),
                              F.col("n_name").alias(f"{name}_name"))
    if name == "merchant":
        return table(spark, sf, "supplier").select(party_id("S", "s_suppkey").alias("merchant_id"),
                                                   F.col("s_name").alias("merchant_name"))
    if name == "campaign":
        return table(spark, sf, "part").select(F.col("p_brand").alias("campaign_id")).distinct()
    if name == "transaction":
        return of_lines().select(
            party_id("T", "o_orderkey").alias("transaction_id"), account, card_id().alias("card_id"),
            party_id("S", "seller").alias("merchant_id"), day.alias("transaction_date"),
            total.alias("transaction_amount"), F.lit("GBP").alias("transaction_currency"),
            F.lit("SALE").alias("transaction_type"), F.col("o_orderstatus").alias("transaction_status"),
            F.lit("POS").alias("channel"), (F.col("o_orderkey") % 3 == 0).alias("is_international_flag"))
    if name == "payment":
        named = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority"))
        return orders.where("o_orderstatus = 'F'").select(
            party_id("Y", "o_orderkey").alias("payment_id"), account, day.alias("payment_date"),
            total.alias("payment_amount"), named.alias("payment_method"), F.lit("POSTED").alias("payment_status"),
            F.lit(False).alias("is_autopay_flag"))
    if name == "statement":
        zero = F.lit(0).cast("decimal(18,2)")
        return of_lines("l_tax").where("o_orderstatus = 'O'").select(
            party_id("M", "o_orderkey").alias("statement_id"), account, day.alias("statement_date"),
            zero.alias("opening_balance"), total.alias("closing_balance"), total.alias("total_purchases"),
            zero.alias("total_payments"), F.col("amount").alias("total_fees"), zero.alias("total_interest"),
            money(total * F.lit(0.05).cast("decimal(4,2)")).alias("minimum_payment_due"))
    if name == "fraud_case":
        value = money("value")
        return table(spark, sf, "events").where("event_type = 'error'").select(
            party_id("X", "event_id").alias("fraud_case_id"), party_id("C", "user_id").alias("customer_id"),
            F.col("ts").cast("date").alias("case_open_date"), F.lit("ERROR").alias("fraud_type"),
            value.alias("disputed_amount"), F.lit(0).cast("decimal(18,2)").alias("recovery_amount"),
            F.lit("OPEN").alias("case_status"))
    if name == "collections":
        owed = money(-F.col("c_acctbal"))
        return people.where("c_acctbal < 0").select(
            party_id("K", "c_custkey").alias("collections_id"), party_id("A", "c_custkey").alias("account_id"),
            F.lit("EARLY").alias("collections_stage"), owed.alias("outstanding_balance"),
            owed.alias("promise_to_pay_amount"), F.lit("OPEN").alias("collections_status"))
    if name in ("interest_charge", "fee"):
        date, amount, rate = (("charge_date", "interest_amount", "l_discount") if name == "interest_charge"
                              else ("fee_date", "fee_amount", "l_tax"))
        return of_lines(rate).select(party_id(name[0].upper(), "o_orderkey").alias(f"{name}_id"), account,
                                     day.alias(date), F.col("amount").alias(amount))
    raise ValueError(f"no extract for {name!r}")


_lakes: dict[tuple[str, str], tuple[Lake, DataFrame]] = {}


def whole_lake(spark: SparkSession, sf: str) -> tuple[Lake, DataFrame]:
    """The lake after both deliveries, and its configuration, read from a file of JSON records."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _lakes:
        root, database = files.shared_root(spark, "lake"), f"lake_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {database} LOCATION '{files.shared_root(spark, 'tables')}'")
        lake = Lake(spark, root, "daily", "2024-01-15", FIRST, database=database, buckets=None)
        records = [{"table_name": n, "source_system": "CORE", "layer_role": role, "primary_key": k, "scd_type": t,
                    "natural_keys": [k], "bronze_path": "", "silver_table": f"silver_{n}",
                    "bronze_table": f"bronze_{n}", "active_flag": active} for n, k, t, role, active in _RECORDS]
        text = spark.createDataFrame([(json.dumps(records, indent=1),)], "value string").coalesce(1)
        text.write.text(f"{root}/config/tables.json")
        config = table_config(spark, f"{root}/config/tables.json", f"{database}.table_config", active_only=False)
        options = {"gold_options": {"facts": [*gold.FACTS, FRAUD_AT_EVENT], "calendar": None, "key_mode": "stored",
                                    "date_partition": "month", "only_changed": True},
                   "references": {**gold.GATE_REFERENCES, "FactRevenue": [("account_sk", "DimAccount")]}}
        charged = files.stored(charged_orders(spark, sf), "charged-orders", None, files.CODEC)
        run_configured(lake, "b1", config, lambda c: extract(spark, sf, c.table_name, charged=charged), **options)
        lake.load_ts = SECOND
        # By now the configuration is a table of the catalog, which goes before the file.
        config.write.saveAsTable(f"{database}.table_config")
        config = table_config(spark, f"{root}/config/missing.json", f"{database}.table_config", active_only=False)
        run_configured(lake, "b2", config, lambda c: extract(spark, sf, c.table_name, second=True), only=_SECOND, **options)
        _lakes[key] = lake, config
    return _lakes[key]


_CHANGED = f"(SELECT count(*) FROM customer WHERE c_acctbal > {RICH})"
_COUNTS = {
    "DimCustomer": f"(SELECT count(*) FROM customer) + {_CHANGED}", "DimRisk": f"(SELECT count(*) FROM customer) + {_CHANGED}",
    "DimAccount": "(SELECT count(*) FROM customer)",
    "DimCard": "(SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders))",
    "DimProduct": "(SELECT count(*) FROM region)", "DimCurrency": "(SELECT count(DISTINCT r_name[:3]) FROM region)",
    "DimBranch": "(SELECT count(*) FROM nation)", "DimGeography": "(SELECT count(*) FROM nation)",
    "DimMerchant": "(SELECT count(*) FROM supplier)", "DimCampaign": "(SELECT count(DISTINCT p_brand) FROM part)",
    "FactTransaction": "(SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))",
    "FactPayment": "(SELECT count(*) FROM orders WHERE o_orderstatus = 'F')",
    "FactStatement": "(SELECT count(*) FROM orders WHERE o_orderstatus = 'O' AND o_orderkey IN (SELECT l_orderkey FROM lineitem))",
    "FactFraud": "(SELECT count(*) FROM events WHERE event_type = 'error')",
    "FactFraudAtEvent": "(SELECT count(*) FROM events WHERE event_type = 'error')",
    "FactCollections": "(SELECT count(*) FROM customer WHERE c_acctbal < 0)",
    "FactRevenue": "(SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))",
    "DimDate": """(SELECT date_diff('day', min(d), max(d)) + 1 FROM (
        SELECT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
        UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'error'))""",
}


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST({c} AS BIGINT) AS n_rows" for n, c in _COUNTS.items()))
def gold_counts(spark, sf):
    lake, _ = whole_lake(spark, sf)
    return rows.union_batches(*[read_gold(lake, n).agg(F.count(F.lit(1)).alias("n_rows"))
                                .select(F.lit(n).alias("table_name"), "n_rows") for n in _COUNTS])


_NOW = {"customer": "customer", "account": "customer", "customer_risk_profile": "customer", "card_product": "region",
        "branch": "nation", "geography": "nation", "merchant": "supplier"}
_ROWS = ({n: f"(SELECT count(*) FROM {t})" for n, t in _NOW.items()}
         | {n: _COUNTS[f] for n, f in (("credit_card", "DimCard"), ("currency", "DimCurrency"), ("campaign", "DimCampaign"),
                                       ("transaction", "FactTransaction"), ("payment", "FactPayment"),
                                       ("statement", "FactStatement"), ("fraud_case", "FactFraud"),
                                       ("collections", "FactCollections"), ("interest_charge", "FactTransaction"),
                                       ("fee", "FactTransaction"))})


@query(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{role}' AS layer_role, {str(active).upper()} AS active_flag, "
    f"{2 if n in _SECOND else 1 if active else 0}::BIGINT AS n_batches, "
    f"CAST({_ROWS.get(n, 'NULL')} AS BIGINT) AS n_rows, CAST(NULL AS VARCHAR) AS error"
    for n, _, _, role, active in _RECORDS) + """ UNION ALL SELECT 'no_such_table', NULL, NULL, 0, NULL,
    'no configuration for tables [''no_such_table'']'""")
def config_driven_run(spark, sf):
    lake, config = whole_lake(spark, sf)
    log = spark.read.parquet(lake.path("control", "pipeline_execution_log"))
    loads = (log.where("layer = 'SILVER' AND status = 'SUCCESS'").groupBy("table_name")
                .agg(F.count_distinct("batch_id").alias("n_batches")))
    stored = rows.union_batches(*[read_silver(lake, r.silver_table).agg(F.count(F.lit(1)).alias("n_rows"))
                                  .select(F.lit(r.table_name).alias("table_name"), "n_rows")
                                  for r in config.where("active_flag").collect()])
    known = config.join(loads, "table_name", "left").join(stored, "table_name", "left").select(
        "table_name", "layer_role", "active_flag", F.coalesce("n_batches", F.lit(0)).alias("n_batches"), "n_rows",
        F.lit(None).cast("string").alias("error"))
    try:
        run_configured(lake, "b3", config, lambda c: extract(spark, sf, c.table_name), only=["no_such_table"])
        error = None
    except ValueError as unknown:
        error = str(unknown)
    return known.unionByName(spark.createDataFrame([("no_such_table", None, None, 0, None, error)], known.schema))


@query(f"""SELECT 'X' || event_id AS fraud_case_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_sk,
    CASE WHEN CAST(CAST(ts AS DATE) AS TIMESTAMP) < TIMESTAMP '{FIRST}' THEN NULL
         WHEN CAST(CAST(ts AS DATE) AS TIMESTAMP) >= TIMESTAMP '{SECOND}' AND c_acctbal > {RICH} THEN 'B'
         WHEN c_acctbal >= 0 THEN 'A' ELSE 'D' END AS risk_grade_then, c_mktsegment AS segment_first
    FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'error'""")
def fact_fraud_at_event(spark, sf):
    lake, _ = whole_lake(spark, sf)
    people = read_gold(lake, "DimCustomer")
    keys = people.where("is_current_flag").select("customer_sk", "customer_id")
    first = people.where(F.col("effective_start_date") == F.lit(FIRST).cast("timestamp")).select(
        "customer_id", F.col("customer_segment").alias("segment_first"))
    return (read_gold(lake, "FactFraudAtEvent").join(keys, "customer_sk").join(first, "customer_id")
            .select("fraud_case_id", "date_sk", "risk_grade_then", "segment_first"))


_CHECKED = [("NULL_RATE", "FactPayment", "payment_method", None, "FactPayment", "o_orderpriority = '4-NOT SPECIFIED'", 0.02),
            ("NULL_RATE", "FactPayment", "payment_amount", None, "FactPayment", "FALSE", 0.02),
            ("REFERENTIAL_INTEGRITY", "FactPayment", "account_sk", "DimAccount", "FactPayment", "FALSE", 0.001)]


@query("SELECT *, bool_or(NOT passed) OVER () AS stopped FROM (" + " UNION ALL ".join(
    f"""SELECT '{kind}' AS check_type, '{fact}' AS fact_table, '{column}' AS fk_column,
    {f"'{dim}'" if dim else 'CAST(NULL AS VARCHAR)'} AS dim_table, count(*) AS total_rows,
    count(*) FILTER (WHERE {bad}) AS orphan_rows, round(count(*) FILTER (WHERE {bad}) / count(*), 9) AS orphan_rate,
    CAST({limit} AS DOUBLE) AS threshold, count(*) FILTER (WHERE {bad}) <= {limit} * count(*) AS passed
    FROM orders WHERE o_orderstatus = 'F'""" for kind, fact, column, dim, _, bad, limit in _CHECKED) + ")")
def null_gate(spark, sf):
    lake, _ = whole_lake(spark, sf)
    try:
        validate_gold(lake, "nulls", {"FactPayment": gold.GATE_REFERENCES["FactPayment"]},
                      not_null={"FactPayment": ("payment_method", "payment_amount")})
        stopped = False
    except quality.DataQualityError as failed:
        stopped = '"fk_column":"payment_method"' in str(failed)
    stored = rows.of_batch(files.read_batches(spark, lake.path("control", "dq_validation_summary")), "nulls")
    return stored.select("check_type", "fact_table", "fk_column", "dim_table", "total_rows", "orphan_rows",
                         F.round("orphan_rate", 9).alias("orphan_rate"), "threshold", "passed",
                         F.lit(stopped).alias("stopped"))


@query("""SELECT product_name, format('{:,.2f}', sum(p)) AS "Total Transaction Amount",
    format('{:,}', count(*)) AS "Total Transactions",
    format('{:,.2f}', 100.0 * count(*) FILTER (WHERE o_orderkey % 3 = 0) / count(*)) || '%' AS "International Transaction %"
    FROM (SELECT r_name AS product_name, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS p
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) GROUP BY ALL""")
def measures_by_product(spark, sf):
    lake, _ = whole_lake(spark, sf)
    star = {n: read_gold(lake, n) for n in ("FactTransaction", "DimAccount", "DimProduct")}
    names = ["Total Transaction Amount", "Total Transactions", "International Transaction %"]
    return measures.formatted(measures.measure_table(star, names, ["DimProduct.product_name"]), names)


_STEPS = [("landing", "LANDING"), ("bronze", "BRONZE"), ("silver", "SILVER")]
_LOG = """SELECT step || '_' || t || '_b1_' || status AS log_id, step AS notebook_name, layer, t AS table_name,
    'b1' AS batch_id, status, CASE WHEN status = 'SUCCESS' THEN n_read END AS rows_read,
    CASE WHEN status = 'SUCCESS' THEN n_written END AS rows_written, CASE WHEN status = 'FAILED' THEN
    'account: ' || (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1))
    || ' keys occur more than once' END AS error_message FROM (
    SELECT * FROM (SELECT 'customer' AS t, count(*) AS n_read, count(*) AS n_written FROM customer),
      (VALUES ('landing', 'LANDING'), ('bronze', 'BRONZE'), ('silver', 'SILVER')) s(step, layer),
      (VALUES ('STARTED'), ('SUCCESS')) u(status)
    UNION ALL SELECT * FROM (SELECT 'account' AS t, count(*) AS n_read, count(*) AS n_written FROM orders),
      (VALUES ('landing', 'LANDING', 'STARTED'), ('landing', 'LANDING', 'SUCCESS')) s(step, layer, status)
    UNION ALL SELECT * FROM (SELECT 'account' AS t, count(*) AS n_read,
      count(DISTINCT (o_custkey, o_orderstatus)) AS n_written FROM orders),
      (VALUES ('bronze', 'BRONZE', 'STARTED'), ('bronze', 'BRONZE', 'SUCCESS'), ('silver', 'SILVER', 'STARTED'),
       ('silver', 'SILVER', 'FAILED')) s(step, layer, status))"""


@query(_LOG)
def run_log_rows(spark, sf):
    """What a batch wrote into its log whose table of accounts holds keys twice."""
    lake = Lake(spark, files.shared_root(spark, "lake"), "daily", "2001-08-02", "2001-08-02 06:00:00")
    config = {n: TableConfig(n, "CORE", role, k, t, (k,), "", f"silver_{n}", f"bronze_{n}", True)
              for n, k, t, role, _ in _RECORDS}
    accounts = table(spark, sf, "orders").select(party_id("A", "o_custkey").alias("account_id"), "o_orderstatus")
    try:
        run_batch(lake, "b1", [(config["customer"], extract(spark, sf, "customer")), (config["account"], accounts)])
    except quality.DataQualityError:
        pass
    log = spark.read.parquet(lake.path("control", "pipeline_execution_log"))
    return log.select("log_id", "notebook_name", "layer", "table_name", "batch_id", "status", "rows_read", "rows_written",
                      "error_message")
