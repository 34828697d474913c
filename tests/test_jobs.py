"""The daily batch on small card-business tables: layers, reruns, quarantine, gate, run log."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlode.catalogue import batches, whole
from ledgerlode.operators import quality, scd
from ledgerlode.operators.scd import scd2_violations
from ledgerlode.plans import gold, jobs
from ledgerlode.schemas import entity_schema
from ledgerlode.sources import files
from ledgerlode.sources.config import TableConfig


def cfg(name, key, scd_type=1, active=True):
    return TableConfig(name, "CORE", "DIM", key, scd_type, (key,), "", f"silver_{name}",
                       f"bronze_{name}", active)


@pytest.fixture()
def lake(spark, tmp_path):
    return jobs.Lake(spark, str(tmp_path / "lake"), "daily", "2026-07-18", "2026-07-18 02:00:00")


CUSTOMER = cfg("customer", "customer_id", 2)


def customers(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, customer_segment string")


def load(lake, config, batch, df, **options):
    jobs.land(lake, config, batch, df)
    jobs.load_bronze(lake, config, batch)
    return jobs.to_silver(lake, config, batch, **options)


def test_layers_and_history(spark, lake):
    load(lake, CUSTOMER, "b1", customers(spark, [(" c1", "A "), ("c1", "A"), ("c2", "A"), (None, "A")]))
    first = jobs.read_silver(lake, "silver_customer", history=True)
    assert first.count() == 2 and first.where("is_current_flag").count() == 2
    rejected = spark.read.parquet(lake.path("control", "dq_quarantine_customer"))
    assert rejected.count() == 1
    lake.load_ts = "2026-07-19 02:00:00"
    load(lake, CUSTOMER, "b2", customers(spark, [("c1", "B"), ("c3", "A")]))
    lake.load_ts = "2026-07-20 02:00:00"
    load(lake, CUSTOMER, "b3", customers(spark, [("c1", "C")]))
    history = jobs.read_silver(lake, "silver_customer", history=True)
    assert history.where("customer_id = 'c1'").count() == 3
    assert sorted(r.customer_segment for r in jobs.read_silver(lake, "silver_customer").collect()) == [
        "A", "A", "C"]
    assert tuple(scd2_violations(history, ["customer_id"]).first()) == (3, 0, 0, 0, 0)


def test_rerun_of_a_batch(spark, lake):
    df = customers(spark, [("c1", "A"), ("c2", "B")])
    for _ in range(2):
        load(lake, CUSTOMER, "b1", df)
    bronze = files.read_batches(spark, lake.path("bronze", "bronze_customer"))
    assert bronze.count() == 2
    assert jobs.read_silver(lake, "silver_customer", history=True).count() == 2


def test_bronze_without_a_contract_keeps_what_landed(spark, lake):
    rows = [("k", 51.5074, 5, dt.datetime(2024, 1, 1, 13), 12.345, "a", None, "b"),
            ("k", 51.5074, 5, dt.datetime(2024, 1, 1, 13), 12.345, "a", "b", None)]
    df = spark.createDataFrame(rows, "visit_id string, latitude double, visits int, seen_date timestamp, "
                                     "total_x double, a string, b string, c string")
    visit = cfg("visit", "visit_id")
    jobs.land(lake, visit, "b1", df)
    assert jobs.load_bronze(lake, visit, "b1") == {"rows_read": 2, "rows_written": 2}
    bronze = spark.read.parquet(lake.path("bronze", "bronze_visit")).select(*df.columns)
    assert bronze.schema == df.schema and set(bronze.collect()) == set(df.collect())


def test_empty_batches(spark, lake):
    rows, none = customers(spark, [("c1", "A"), ("c2", "B")]), customers(spark, [])
    assert load(lake, CUSTOMER, "b0", none) == {"rows_read": 0, "rows_written": 0, "rows_clean": 0}
    load(lake, CUSTOMER, "b1", rows)
    assert load(lake, CUSTOMER, "b2", none)["rows_read"] == 0
    assert jobs.read_silver(lake, "silver_customer").count() == 2
    jobs.land(lake, CUSTOMER, "b1", none)
    jobs.load_bronze(lake, CUSTOMER, "b1")
    assert files.read_batches(spark, lake.path("bronze", "bronze_customer")).count() == 0


def test_corrected_delivery_replaces_the_version_of_its_time(spark, lake):
    load(lake, CUSTOMER, "b1", customers(spark, [("c1", "A")]))
    lake.load_ts = "2026-07-19 02:00:00"
    for segment in ("B", "C"):
        load(lake, CUSTOMER, "b2", customers(spark, [("c1", segment)]))
    history = jobs.read_silver(lake, "silver_customer", history=True)
    assert sorted(r.customer_segment for r in history.collect()) == ["A", "C"]
    assert tuple(scd2_violations(history, ["customer_id"]).first()) == (1, 0, 0, 0, 0)


def test_duplicate_keys_stop_the_table(spark, lake):
    df = customers(spark, [("c1", "A"), ("c1", "B")])
    with pytest.raises(quality.DataQualityError):
        load(lake, CUSTOMER, "b1", df)
    assert load(lake, CUSTOMER, "b1", df, on_duplicate="latest")["rows_written"] == 1


def test_bronze_keeps_a_contract_and_accepts_new_columns(spark, lake):
    fee = cfg("fee", "fee_id")
    jobs.land(lake, fee, "b1", spark.createDataFrame([("f1", "2.5", "2026-07-01")],
                                                     "fee_id string, fee_amount string, fee_date string"))
    jobs.load_bronze(lake, fee, "b1", entity_schema(["fee_id", "fee_amount", "fee_date"]))
    jobs.to_silver(lake, fee, "b1")
    load(lake, fee, "b2", spark.createDataFrame(
        [("f1", "3", "2026-07-01", "why"), ("f2", "4", "2026-07-02", None)],
        "fee_id string, fee_amount string, fee_date string, fee_reason string"))
    silver = jobs.read_silver(lake, "silver_fee")
    assert {r.fee_id: (r.fee_amount, r.fee_date, r.fee_reason) for r in silver.collect()} == {
        "f1": (D("3.00"), dt.date(2026, 7, 1), "why"), "f2": (D("4.00"), dt.date(2026, 7, 2), None)}


def test_upsert_by_month_touches_only_its_months(spark, lake):
    fee = cfg("fee", "fee_id")
    schema = entity_schema(["fee_id", "fee_amount", "fee_date"])
    day = dt.date
    first = [("f1", D("1.00"), day(2026, 1, 5)), ("f2", D("2.00"), day(2026, 2, 5)),
             ("f3", D("3.00"), day(2026, 3, 5)), ("f4", D("4.00"), None)]
    by_month = {"month_of": "fee_date"}
    load(lake, fee, "b1", spark.createDataFrame(first, schema), **by_month)
    # f1 moves to February and leaves January empty; f2 changes in place.
    second = [("f1", D("9.00"), day(2026, 2, 6)), ("f2", D("8.00"), day(2026, 2, 5))]
    load(lake, fee, "b2", spark.createDataFrame(second, schema), **by_month)
    silver = jobs.read_silver(lake, "silver_fee")
    assert {r.fee_id: (r.fee_amount, r.fee_date) for r in silver.collect()} == {
        "f1": (D("9.00"), day(2026, 2, 6)), "f2": (D("8.00"), day(2026, 2, 5)),
        "f3": (D("3.00"), day(2026, 3, 5)), "f4": (D("4.00"), None)}
    rewritten = files.child_names(spark, lake.path("silver", "silver_fee") + "/v=000002")
    assert [n for n in rewritten if "=" in n] == ["silver_month=202601", "silver_month=202602"]
    third = [("f4", D("5.00"), None), ("f5", D("6.00"), day(2026, 4, 1))]
    load(lake, fee, "b3", spark.createDataFrame(third, schema), keys_stay=True, **by_month)
    assert jobs.read_silver(lake, "silver_fee").count() == 5


def test_masked_before_silver(spark, lake):
    df = spark.createDataFrame([("c1", "AB123456C")], "customer_id string, national_insurance_no string")
    load(lake, CUSTOMER, "b1", df, masks={"national_insurance_no": "token"})
    assert jobs.read_silver(lake, "silver_customer").first().national_insurance_no != "AB123456C"


ROWS = {
    "customer": ("customer_id", 2, "customer_id customer_segment", [("c1", "A"), ("c2", "B")]),
    "account": ("account_id", 2, "account_id customer_id account_status",
                [("a1", "c1", "ACTIVE"), ("a2", "c2", "CLOSED")]),
    "transaction": ("transaction_id", 1,
                    "transaction_id card_id account_id merchant_id transaction_date transaction_amount "
                    "transaction_currency transaction_type transaction_status channel "
                    "is_international_flag",
                    [("t1", "k1", "a1", "m1", dt.date(2026, 7, 1), D("10.00"), "GBP", "SALE", "OK",
                      "POS", True),
                     ("t2", "k1", "a1", "m1", dt.date(2026, 7, 2), D("20.00"), "GBP", "SALE", "OK",
                      "POS", False)]),
    "credit_card": ("card_id", 2, "card_id account_id", [("k1", "a1")]),
    "merchant": ("merchant_id", 1, "merchant_id merchant_name", [("m1", "Shop")]),
    "interest_charge": ("interest_charge_id", 1,
                        "interest_charge_id account_id charge_date interest_amount",
                        [("i1", "a1", dt.date(2026, 7, 1), D("1.00"))]),
    "fee": ("fee_id", 1, "fee_id account_id fee_date fee_amount",
            [("f1", "a2", dt.date(2026, 7, 1), D("12.00"))]),
    "payment": ("payment_id", 1, "payment_id account_id payment_date payment_amount payment_method "
                                 "payment_status is_autopay_flag",
                [("p1", "a1", dt.date(2026, 7, 3), D("5.00"), "DD", "OK", True)]),
    "statement": ("statement_id", 1,
                  "statement_id account_id statement_date opening_balance closing_balance "
                  "total_purchases total_payments total_fees total_interest minimum_payment_due",
                  [("s1", "a1", dt.date(2026, 7, 18), *[D("1.00")] * 7)]),
    "fraud_case": ("fraud_case_id", 2, "fraud_case_id customer_id case_open_date fraud_type "
                                       "disputed_amount recovery_amount case_status",
                   [("fc1", "c1", dt.date(2026, 7, 5), "CNP", D("10.00"), D("1.00"), "OPEN")]),
    "collections": ("collections_id", 2, "collections_id account_id collections_stage "
                                         "outstanding_balance promise_to_pay_amount collections_status",
                    [("co1", "a2", "EARLY_ARREARS", D("7.00"), D("3.00"), "OPEN")]),
    "card_product": ("product_id", 2, "product_id product_name", [("p", "Gold")]),
    "customer_risk_profile": ("risk_profile_id", 2, "risk_profile_id customer_id risk_grade",
                              [("r1", "c1", "A")]),
    "branch": ("branch_id", 2, "branch_id branch_name", [("br1", "London")]),
    "currency": ("currency_code", 1, "currency_code currency_name", [("GBP", "Pound")]),
    "campaign": ("campaign_id", 1, "campaign_id campaign_name", [("cm1", "Spring")]),
    "geography": ("geography_id", 1, "geography_id country_name", [("g1", "UK")]),
}


def batch(spark, changes=None, only=None):
    out = []
    for name, (key, scd_type, columns, rows) in {**ROWS, **(changes or {})}.items():
        if only is None or name in only:
            out.append((cfg(name, key, scd_type),
                        spark.createDataFrame(rows, entity_schema(columns.split()))))
    return out


def part(dimensions, fact):
    """Gold options and references for one fact and its dimensions."""
    options = {"dimensions": [d for d in gold.DIMENSIONS if d.name in dimensions],
               "facts": [f for f in gold.FACTS if f.name == fact], "revenue": None,
               "date_partition": "month"}
    return {"gold_options": options, "references": {fact: gold.GATE_REFERENCES[fact]}}


def test_full_batch_to_gate(spark, lake):
    results = jobs.run_batch(lake, "20260718_001", batch(spark),
                             gold_options={"date_partition": "month", "revenue": "account"})
    assert {r["status"] for r in results} == {"SUCCESS"} and len(results) == len(ROWS)
    for fact in gold.FACTS:
        stored = jobs.read_gold(lake, fact.name)
        assert set(fact.columns) <= set(stored.columns)
    txn = jobs.read_gold(lake, "FactTransaction")
    assert txn.where("account_sk = 1 and card_sk = 1 and merchant_sk = 1").count() == 2
    revenue = {r.account_id: r.total_revenue for r in jobs.read_gold(lake, "FactRevenue").collect()}
    assert revenue == {"a1": D("1.00"), "a2": D("12.00")}
    assert jobs.read_gold(lake, "DimDate").count() == 5844
    summary = spark.read.parquet(lake.path("control", "dq_validation_summary"))
    assert summary.count() == 6 and summary.where("passed").count() == 6
    log = spark.read.parquet(lake.path("control", "pipeline_execution_log"))
    steps = len(ROWS) * 3 + 2
    assert log.where("status = 'STARTED'").count() == log.where("status = 'SUCCESS'").count() == steps
    assert log.where("layer = 'BRONZE' and table_name = 'transaction' and status = 'SUCCESS'").select(
        "rows_read", "rows_written").first() == (2, 2)


def test_gate_blocks_orphans_after_storing_the_summary(spark, lake):
    orphan = {"credit_card": ("card_id", 2, "card_id account_id", [("other", "a1")])}
    only = ("transaction", "account", "credit_card", "merchant")
    with pytest.raises(quality.DataQualityError, match="1 of 2"):
        jobs.run_batch(lake, "b1", batch(spark, orphan, only),
                       **part(("DimAccount", "DimCard", "DimMerchant"), "FactTransaction"))
    summary = spark.read.parquet(lake.path("control", "dq_validation_summary"))
    assert [r.fk_column for r in summary.where("not passed").collect()] == ["card_sk"]
    log = spark.read.parquet(lake.path("control", "pipeline_execution_log"))
    assert log.where("status = 'FAILED' and layer = 'VALIDATION'").count() == 1


def test_failed_table_lets_others_load_but_not_gold(spark, lake):
    bad = customers(spark, [("c1", "A"), ("c1", "B")])
    good = spark.createDataFrame([("m1", "Shop")], "merchant_id string, merchant_name string")
    off = cfg("currency", "currency_code", active=False)
    with pytest.raises(quality.DataQualityError, match="customer"):
        jobs.run_batch(lake, "b1", [(CUSTOMER, bad), (cfg("merchant", "merchant_id"), good),
                                    (off, good)])
    assert jobs.read_silver(lake, "silver_merchant").count() == 1
    assert jobs.read_silver(lake, "silver_currency") is None
    assert not files.path_exists(spark, lake.path("gold", "DimDate"))
    log = spark.read.parquet(lake.path("control", "pipeline_execution_log"))
    failed = log.where("status = 'FAILED'").collect()
    assert [r.table_name for r in failed] == ["customer"] and failed[0].error_message


def test_missing_landing_partition_is_recorded(spark, lake):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.load_bronze(lake, CUSTOMER, "never_landed")
    assert lake.log[-1]["status"] == "FAILED"
    lake.flush_log()
    assert lake.log == []


def test_later_batch_with_new_versions_keeps_fact_grain(spark, lake):
    only, job = ("customer", "fraud_case"), part(("DimCustomer",), "FactFraud")
    jobs.run_batch(lake, "b1", batch(spark, only=only), **job)
    lake.load_ts = "2026-07-19 02:00:00"
    columns = ROWS["fraud_case"][2]
    changed = {"fraud_case": ("fraud_case_id", 2, columns, [
        ("fc1", "c1", dt.date(2026, 7, 5), "CNP", D("10.00"), D("1.00"), "CLOSED")])}
    job["gold_options"]["key_mode"] = "hash"
    jobs.run_batch(lake, "b2", batch(spark, changed, only), **job)
    assert jobs.read_silver(lake, "silver_fraud_case", history=True).count() == 2
    fact = jobs.read_gold(lake, "FactFraud")
    assert [r.case_status for r in fact.collect()] == ["CLOSED"]
    assert fact.where(F.col("customer_sk").isNull()).count() == 0


def test_gold_that_nothing_changed_stays(spark, lake):
    options = {"date_partition": "month", "only_changed": True, "calendar": None}
    names = [t.name for t in (*gold.DIMENSIONS, *gold.FACTS)] + ["FactRevenue", "DimDate"]

    def stored():
        return {n: sorted(jobs.read_gold(lake, n).inputFiles()) for n in names}

    jobs.run_batch(lake, "b1", batch(spark), gold_options=options)
    first, lake.load_ts = stored(), "2026-07-19 02:00:00"
    changed = {"account": ("account_id", 2, ROWS["account"][2], [("a0", "c1", "ACTIVE"), ("a1", "c1", "CLOSED")])}
    with pytest.raises(ValueError, match="unknown grain"):           # a build that stops half-way is done again
        jobs.run_batch(lake, "b2", batch(spark, changed, ("account",)), gold_options={**options, "revenue": "no such"})
    jobs.build_gold(lake, "b3", **options)
    second = stored()
    assert {n for n in names if first[n] != second[n]} == {
        "DimAccount", "FactTransaction", "FactPayment", "FactStatement", "FactCollections", "FactRevenue"}
    kept = {n: sorted(map(str, jobs.read_gold(lake, n).collect())) for n in names}
    jobs.build_gold(lake, "b4", date_partition="month", calendar=None)
    assert {n: sorted(map(str, jobs.read_gold(lake, n).collect())) for n in names} == kept
    assert all(a != b for a, b in zip(second.values(), stored().values()))


def test_keys_that_the_profile_counted_are_not_counted_again(spark, lake, monkeypatch):
    seen = []

    def guard(source, keys, on_duplicate="error", newest=None):
        seen.append(on_duplicate)
        return unique(source, keys, on_duplicate, newest)

    unique = scd.unique_source
    monkeypatch.setattr(scd, "unique_source", guard)
    load(lake, CUSTOMER, "b1", customers(spark, [("c1", "A"), (" c1", "A "), ("c2", "B")]))
    load(lake, CUSTOMER, "b2", customers(spark, [("c1", "A"), ("c1", "B")]), on_duplicate="latest")
    assert seen == ["checked", "latest"]
    assert sorted(r.customer_id for r in jobs.read_silver(lake, "silver_customer").collect()) == ["c1", "c2"]


def test_lines_are_summed_once_for_three_tables(spark):
    sf = "/root/testdata/sf0.001"
    out = batches._extracts(spark, sf, False)
    made = [out[n] for n in ("transaction", "interest_charge", "fee")]
    assert not [f for df in made for f in df.inputFiles() if "lineitem" in f]
    charged = whole.charged_orders(spark, sf)
    for name in ("transaction", "statement", "interest_charge", "fee"):
        given = whole.extract(spark, sf, name, charged=files.stored(charged, "charged"))
        assert not [f for f in given.inputFiles() if "lineitem" in f]
        assert sorted(map(str, given.collect())) == sorted(map(str, whole.extract(spark, sf, name).collect()))


def test_dimensions_of_many_rows_are_not_broadcast(spark, lake, monkeypatch):
    plans, write = {}, files.overwrite_path

    def overwrite(df, path, *more):
        plans[path.rsplit("/", 1)[-1]] = df._jdf.queryExecution().executedPlan().toString()
        write(df, path, *more)

    monkeypatch.setattr(files, "overwrite_path", overwrite)
    many = spark.range(60_000).select(F.concat(F.lit("a"), "id").alias("account_id"), F.lit("c1").alias("customer_id"),
                                      F.lit("ACTIVE").alias("account_status"))
    job = part(("DimAccount",), "FactPayment")
    job["gold_options"]["only_changed"] = True
    jobs.run_batch(lake, "b1", [(cfg("account", "account_id", 2), many), *batch(spark, only=("payment",))], **job)
    assert plans["FactPayment"].count("BroadcastHashJoin") == 1 and "SortMergeJoin" in plans.pop("FactPayment")
    assert jobs.read_gold(lake, "DimAccount").inputFiles() and jobs.read_gold(lake, "FactPayment").first().account_sk
    lake.load_ts = "2026-07-19 02:00:00"                   # now the dimension stays as it is
    jobs.run_batch(lake, "b2", batch(spark, only=("payment",)), **job)
    assert plans["FactPayment"].count("BroadcastHashJoin") == 1 and "SortMergeJoin" in plans["FactPayment"]


def test_lines_and_orders_are_not_broadcast(spark):
    plan = whole.charged_orders(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_maintenance(spark, lake):
    load(lake, CUSTOMER, "b1", customers(spark, [("c1", "A"), ("c2", "A")]))
    lake.load_ts = "2026-07-19 02:00:00"
    load(lake, CUSTOMER, "b2", customers(spark, [("c1", "B")]))
    before = sorted(map(str, jobs.read_silver(lake, "silver_customer", history=True).collect()))
    assert jobs.maintain_silver(lake, CUSTOMER, ["customer_id"], 2) == 2
    after = sorted(map(str, jobs.read_silver(lake, "silver_customer", history=True).collect()))
    assert before == after
    assert jobs.expire_landing(lake, CUSTOMER, "2026-07-20") == 0
    assert jobs.expire_landing(lake, CUSTOMER, "2026-09-01") == 1
