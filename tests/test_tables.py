"""Merges into bucketed tables, kept surrogate keys, Z-order and schemas that grow."""

import datetime as dt
import random
import uuid
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F, types as T

from ledgerlode.operators import evolve, ordering, rows, scd, zorder
from ledgerlode.plans import incremental, jobs
from ledgerlode.sources import bronze, files, keymap, tables
from ledgerlode.sources.config import TableConfig

KINDS = "k string, v string, w int"


@pytest.fixture()
def database(spark):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def at(day):
    return F.lit(f"2026-01-{day:02d}").cast("timestamp")


def test_merge_reads_the_table_without_a_shuffle_and_rewrites_touched_buckets_only(spark, database):
    target = incremental.Target(f"{database}.party", ("k",), 8)
    first = spark.createDataFrame([(f"k{i}", "a", i) for i in range(200)], KINDS)
    incremental.merge_type2(target, first, ["v", "w"], at(1), "b1")
    before = set(spark.table(target.name).inputFiles())
    second = spark.createDataFrame([("k1", "b", 1), ("k7", "a", 7), ("new", "n", 0)], KINDS)
    done = incremental.merge_type2(target, second, ["v", "w"], at(2), "b2")
    after = set(spark.table(target.name).inputFiles())
    assert 0 < len(done.buckets) <= 3 and len(after - before) == len(done.buckets)
    assert {f.split("key_bucket=")[1].split("/")[0] for f in after - before} == set(map(str, done.buckets))
    dealt = scd.stamp_scd2(scd.unique_source(tables.with_bucket(second, ["k"], 8), ["k"]), ["v", "w"], at(3))
    plan = scd.scd2_actions(tables.read_buckets(spark, target.name, done.buckets), dealt, ["k"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    table_side = text[text.index("SortMergeJoin"):]
    assert text.count("Exchange") == 1 and "Bucketed: true" in text and "key_bucket" in text
    assert table_side.index("Bucketed: true") < table_side.index("Exchange")


def test_three_batches_and_reruns_agree_with_the_plain_merge(spark, database):
    draw = random.Random(3)
    target, plain = incremental.Target(f"{database}.party", ("k",), 4), None
    for day in range(1, 5):
        batch = spark.createDataFrame([(f"k{i}", draw.choice("ab"), i % 3) for i in draw.sample(range(60), 25)], KINDS)
        for _ in range(2 if day % 2 else 1):
            incremental.merge_type2(target, batch, ["v", "w"], at(day), f"b{day}")
        plain = files.stored(scd.merge_scd2(plain, batch, ["k"], ["v", "w"], at(day), "strict"), "plain")
    history = incremental.read_history(spark, target)
    assert sorted(map(str, history.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    checked = scd.scd2_violations(history, ["k"]).first()
    assert checked.keys_checked > 25 and tuple(checked)[1:] == (0, 0, 0, 0)
    assert incremental.merge_type2(target, batch.limit(0), ["v", "w"], at(9), "b9") == incremental.Merged((), 0)


def test_type1_merge_keeps_columns_that_a_batch_lacks_and_takes_new_ones(spark, database):
    target = incremental.Target(f"{database}.fee", ("k",), 4)
    incremental.merge_type1(target, spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], KINDS))
    incremental.merge_type1(target, spark.createDataFrame([("a", 9, "why"), ("c", 3, None)], "k string, w int, reason string"))
    got = {r.k: (r.v, r.w, r.reason) for r in incremental.read_current(spark, target).collect()}
    assert got == {"a": ("x", 9, "why"), "b": ("y", 2, None), "c": (None, 3, None)}
    with pytest.raises(Exception, match="duplicate key"):
        incremental.merge_type1(target, spark.createDataFrame([("a", 1), ("a", 2)], "k string, w int"))


def test_job_over_bucketed_silver(spark, database, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path), "daily", "2026-07-18", "2026-07-18 02:00:00", database=database, buckets=4)
    cfg = TableConfig("customer", "CORE", "DIM", "k", 2, ("k",), "", "silver_customer", "bronze_customer", True)
    for day, batch in (("18", [("a", "x", 1), ("b", "y", 2)]), ("19", [("a", "z", 1), ("c", "y", 2)])):
        lake.load_ts = f"2026-07-{day} 02:00:00"
        jobs.land(lake, cfg, day, spark.createDataFrame(batch, KINDS))
        jobs.load_bronze(lake, cfg, day)
        jobs.to_silver(lake, cfg, day)
    assert sorted(r.v for r in jobs.read_silver(lake, "silver_customer").collect()) == ["y", "y", "z"]
    assert jobs.read_silver(lake, "silver_customer", history=True).count() == 4


def test_buckets_follow_the_bytes_and_one_shuffle_deals_a_batch(spark, database, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "BUCKET_BYTES", 20_000)
    staged = []

    def stage(df, *more):
        staged.append(df)
        return deal(df, *more)

    deal = tables.stage_bucketed
    monkeypatch.setattr(tables, "stage_bucketed", stage)
    lake = jobs.Lake(spark, str(tmp_path), "daily", "2026-07-18", "2026-07-18 02:00:00", database=database, buckets=None)
    for name, n in (("large", 3000), ("small", 3)):
        cfg = TableConfig(name, "CORE", "FACT", "k", 1, ("k",), "", f"silver_{name}", f"bronze_{name}", True)
        batch = spark.range(n).selectExpr("concat(' k', id) as k", "sha2(string(id), 256) as v", "int(id) as w")
        jobs.land(lake, cfg, "b", batch.unionByName(batch.limit(2)).unionByName(batch.limit(1).withColumn("k", F.trim("k"))))
        jobs.load_bronze(lake, cfg, "b")
        assert bronze.read_bronze(spark, lake.path("bronze", f"bronze_{name}")).count() == n + 1
        jobs.to_silver(lake, cfg, "b")
        assert sorted(r.w for r in jobs.read_silver(lake, f"silver_{name}").collect()) == list(range(n))
    assert tables.buckets_of(spark, f"{database}.silver_large") > 4 > tables.buckets_of(spark, f"{database}.silver_small")
    assert all(df._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1 for df in staged)
    assert not [t for t in spark.catalog.listTables(database) if t.name.startswith("stage")]


def test_a_batch_of_distinct_keys_is_dealt_only_and_the_first_one_meets_no_table(spark, database, tmp_path, monkeypatch):
    staged, merged = [], []
    deal, replace = tables.stage_bucketed, tables.replace_buckets
    monkeypatch.setattr(tables, "stage_bucketed", lambda df, *more: staged.append(df) or deal(df, *more))
    monkeypatch.setattr(tables, "replace_buckets", lambda df, name: merged.append((name, df)) or replace(df, name))
    lake = jobs.Lake(spark, str(tmp_path), "daily", "2026-07-18", "2026-07-18 02:00:00", database=database, buckets=4)
    for name, kind in (("one", 1), ("two", 2)):
        cfg = TableConfig(name, "CORE", "FACT", "k", kind, ("k",), "", f"silver_{name}", f"bronze_{name}", True)
        for day, batch in (("18", [(" a", "x ", 1), ("b", "y", 2)]), ("19", [("a", "z", 1), ("a ", "z", 1), ("c", "y", 2)])):
            lake.load_ts = f"2026-07-{day} 02:00:00"
            jobs.land(lake, cfg, day, spark.createDataFrame(batch, KINDS))
            jobs.load_bronze(lake, cfg, day)
            assert jobs.to_silver(lake, cfg, day)["rows_clean"] == 2
        assert sorted((r.k, r.v) for r in jobs.read_silver(lake, f"silver_{name}").collect()) == [
            ("a", "z"), ("b", "y"), ("c", "y")]
        plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in staged]
        assert ["Aggregate" in p for p in plans] == [False, False, True]
        staged.clear()
    joins = [(name.split(".")[1], "Join" in df._jdf.queryExecution().optimizedPlan().toString()) for name, df in merged]
    assert joins == [("silver_one", False), ("silver_one", True), ("silver_two", False), ("silver_two_closed", True),
                     ("silver_two", True)]
    assert not [t for t in spark.catalog.listTables(database) if t.name.startswith("stage")]


def test_change_between_nullable_columns_opens_a_version(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path), "daily", "2026-07-18", "2026-07-18 02:00:00")
    cfg = TableConfig("customer", "CORE", "DIM", "k", 2, ("k",), "", "silver_customer", "bronze_customer", True)
    for day, batch in (("18", [("a", "x", None)]), ("19", [("a", None, "x")])):
        lake.load_ts = f"2026-07-{day} 02:00:00"
        jobs.land(lake, cfg, day, spark.createDataFrame(batch, "k string, v string, u string"))
        jobs.load_bronze(lake, cfg, day)
        jobs.to_silver(lake, cfg, day)
    assert jobs.read_silver(lake, "silver_customer", history=True).count() == 2


def test_keys_stay_when_earlier_ones_arrive_late(spark, database):
    def load(values):
        df = spark.createDataFrame([(v,) for v in values], "k string")
        return {r.k: r.sk for r in keymap.assign_keys(df, ["k"], "sk", f"{database}.keys", 4, ranges=3).collect()}

    assert load(["m", "p", "m", None]) == {"m": 1, "p": 2, None: None}
    assert load(["z", "a", "p"]) == {"a": 3, "p": 2, "z": 4}
    assert load(["m", "z"]) == {"m": 1, "z": 4}
    assert load([]) == {}
    plan = spark.createDataFrame([("a",)], "k string").join(spark.table(f"{database}.keys").hint("merge"), "k", "left")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_key_maps_are_not_broadcast(spark, database, monkeypatch):
    plans, keep = [], ordering.stored

    def stored(df, *more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, *more)

    monkeypatch.setattr(ordering, "stored", stored)

    def assigned(names):
        df = files.stored(spark.createDataFrame([(n,) for n in names], "k string"), "names")
        return keymap.assign_keys(df, ["k"], "sk", f"{database}.known", 4, ranges=3)

    assigned(["a", "b"])
    later = assigned(["b", "c", None])
    plans.append(later._jdf.queryExecution().optimizedPlan().toString())
    # Without the hint adaptive execution broadcasts a map, as it runs, that is small enough when shuffled.
    assert len(plans) == 3 and all("rightHint=(strategy=merge)" in p for p in plans[1:])
    assert {r.k: r.sk for r in later.collect()} == {"b": 2, "c": 3, None: None}


def test_range_rank_and_interleaving(spark):
    bounds = [3, 5, 5, 9]
    got = {r.v: r.r for r in spark.createDataFrame([(v,) for v in (None, 0, 3, 4, 5, 8, 9, 99)], "v int")
           .select("v", zorder.range_rank(F.col("v"), bounds).alias("r")).collect()}
    assert got == {None: 0, 0: 0, 3: 1, 4: 1, 5: 3, 8: 3, 9: 4, 99: 4}
    z = spark.range(64).select(zorder.interleaved([F.col("id") % 8, F.floor(F.col("id") / 8)], 3).alias("z")).collect()
    want = [sum(((i % 8 >> b & 1) << 2 * b) + ((i // 8 >> b & 1) << 2 * b + 1) for b in range(3)) for i in range(64)]
    assert [r.z for r in z] == want


def test_zorder_prunes_on_both_keys(spark, tmp_path):
    draw = random.Random(5)
    data = [(draw.randrange(1000), f"s{draw.randrange(1000):04d}", i) for i in range(8000)] + [(7, "hot", i) for i in range(4000)]
    df = files.stored(spark.createDataFrame([*data, (None, None, -1)], "a int, b string, c int"), "z")
    path = str(tmp_path / "z")
    files.overwrite_path(zorder.clustered(df, ["a", "b"], 400, bits=4), path, partition_by=["zone"])
    back = spark.read.parquet(path)
    assert back.count() == 12_001 and back.select("a", "b", "c").exceptAll(df).count() == 0
    zones = zorder.zone_map(back, ["a", "b"])
    read = zorder.zones_to_read(zones, {"a": [100, 900], "b": ["s0100", "s0900"]}).collect()
    assert all(0 < r.n_zones <= 0.5 * r.total for r in read) and read[0].total > 15


@pytest.mark.parametrize("known, landed, want", [
    ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("int", "double", "double"), ("float", "double", "double"),
    ("bigint", "double", "decimal(38,18)"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "decimal(30,15)", "decimal(34,15)"),
    ("decimal(38,0)", "decimal(38,18)", "decimal(38,18)"), ("decimal(10,2)", "double", "decimal(38,18)"),
    ("date", "timestamp", "timestamp"), ("timestamp", "date", "timestamp"), ("string", "int", "string"),
    ("int", "string", "int"), ("boolean", "int", "boolean"), ("array<int>", "array<int>", "array<int>")])
def test_wider_types(known, landed, want):
    kind = lambda text: T.StructType.fromDDL(f"x {text}")["x"].dataType
    assert evolve.wider(kind(known), kind(landed)) == kind(want)


@pytest.mark.parametrize("kind, target, kept, lost", [
    ("double", "int", [5.0, -3.0, None], [5.75, 3e10, float("nan")]),
    ("bigint", "int", [5, -2**31], [2**31]), ("double", "decimal(38,18)", [0.1, 1e15], [1e30, 1e-30]),
    ("bigint", "double", [2**53, 2**60], [2**53 + 1]), ("decimal(10,4)", "decimal(10,2)", [D("1.2500")], [D("1.2560")]),
    ("string", "int", ["5", " 7 ", None], ["5.75", "n/a", "", "99999999999"]),
    ("string", "decimal(18,2)", ["5.75", "3"], ["5.756", "x"]), ("string", "date", ["2026-01-02"], ["2026-01-02 13:00:00", "soon"]),
    ("string", "double", ["0.1", "1e5"], ["one"]), ("string", "boolean", ["true"], ["maybe"]),
    ("timestamp", "date", [dt.datetime(2026, 1, 2)], [dt.datetime(2026, 1, 2, 13)]), ("int", "string", [5], [])])
def test_only_casts_that_keep_the_value(spark, kind, target, kept, lost):
    df = spark.createDataFrame([(v,) for v in [*kept, *lost]], f"x {kind}")
    good, bad = evolve.fit(df, T.StructType.fromDDL(f"x {target}"))
    assert good.count() == len(kept) and bad.count() == len(lost)
    assert all(r.misfits == ["x"] for r in bad.collect())
    if lost:
        with pytest.raises(Exception, match="does not hold|CAST_INVALID_INPUT|CAST_OVERFLOW"):
            rows.enforce_schema(df, T.StructType.fromDDL(f"x {target}")).collect()


def test_bronze_loses_no_value(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path), "daily", "2026-07-18", "2026-07-18 02:00:00")
    cfg = TableConfig("fee", "CORE", "FACT", "k", 1, ("k",), "", "silver_fee", "bronze_fee", True)

    def load(batch, data, schema):
        jobs.land(lake, cfg, batch, spark.createDataFrame(data, schema))
        return jobs.load_bronze(lake, cfg, batch)

    load("b1", [("a", 5), ("b", None)], "k string, x int")
    load("b2", [("c", 5.75, "new")], "k string, x double, y string")
    assert load("b3", [("d", "7.5"), ("e", "n/a")], "k string, x string") == {"rows_read": 2, "rows_written": 1}
    load("b4", [], "k string, x int")
    both = bronze.read_bronze(spark, lake.path("bronze", "bronze_fee"))
    assert {(r.k, r.x, r.y, r.batch_id) for r in both.collect()} == {
        ("a", 5.0, None, "b1"), ("b", None, None, "b1"), ("c", 5.75, "new", "b2"), ("d", 7.5, None, "b3")}
    refused = spark.read.parquet(lake.path("control", "bronze_quarantine_fee") + "/batch_id=b3")
    assert [(r.k, r.x, r.misfits) for r in refused.collect()] == [("e", "n/a", ["x"])]
    # A batch that comes again, right this time, leaves nothing in quarantine.
    load("b2", [("c", 6)], "k string, x int")
    load("b3", [("d", 7), ("e", 8)], "k string, x int")
    assert spark.read.parquet(lake.path("control", "bronze_quarantine_fee") + "/batch_id=b3").count() == 0
    assert bronze.known_schema(spark, lake.path("bronze", "bronze_fee"))["x"].dataType == T.DoubleType()
    assert bronze.read_bronze(spark, lake.path("bronze", "bronze_fee")).agg(F.sum("x")).first()[0] == 26.0
