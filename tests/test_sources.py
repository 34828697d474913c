import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from ledgerlode.catalogue import layers
from ledgerlode.schemas import RUN_LOG_SCHEMA
from ledgerlode.sources import config, files, tables, versions

ROW = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])


@pytest.fixture()
def rows(frame):
    return frame([("a", 1), ("b", 2), ("c", None)], ROW)


def test_dispatcher_refuses_bad_requests(spark):
    with pytest.raises(ValueError, match="unknown source format"):
        files.read_source(spark, "sftp", "x")
    with pytest.raises(ValueError, match="explicit schema"):
        files.read_source(spark, "csv", "x")
    with pytest.raises(ValueError, match="url and dbtable"):
        files.read_source(spark, "jdbc", options={"url": "jdbc:none"})


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json", "xml"])
def test_formats(spark, rows, tmp_path, fmt):
    options = {"csv": {"header": "true"}, "xml": {"rowTag": "row"}}.get(fmt, {})
    rows.write.format(fmt).options(**options).save(str(tmp_path / "d"))
    back = files.read_source(spark, fmt, str(tmp_path / "d"), ROW)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_text_source_fails_on_bad_value(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,n\na,one\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILED_READ"):
        files.read_source(spark, "csv", str(tmp_path), ROW).collect()


def test_fallback(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "second"))
    found = files.read_first_existing(spark, "parquet",
                                      [str(tmp_path / "first"), str(tmp_path / "second")])
    assert found.count() == 3
    with pytest.raises(AnalysisException):
        files.read_first_existing(spark, "parquet", [str(tmp_path / "x"), str(tmp_path / "y")])


def test_catalog_tables(spark, rows):
    name = "t_ledgerlode_sink"
    spark.sql(f"drop table if exists {name}")
    try:
        assert tables.create_table(spark.createDataFrame([], ROW), name)
        assert not tables.create_table(spark.createDataFrame([], ROW), name)
        assert files.table_exists(spark, name) and spark.table(name).count() == 0
        tables.append_rows(rows, name)
        tables.append_rows(rows, name)
        assert files.read_source(spark, "table", name).count() == 6
        tables.append_rows(rows.withColumn("more", F.lit(1)), name)
        assert spark.table(name).where("more is null").count() == 6 and spark.table(name).count() == 9
        tables.overwrite_rows(rows.withColumn("d", F.lit(20200101)), name, partition_by=["d"])
        assert spark.table(name).count() == 3 and "d" in spark.table(name).columns
        tables.replace_rows(rows.limit(1).withColumn("d", F.lit(20200102)), name, ["d"])
        tables.replace_rows(rows.limit(2).withColumn("d", F.lit(20200101)), name, ["d"])
        assert {r.d: r["count"] for r in spark.table(name).groupBy("d").count().collect()} == {20200101: 2, 20200102: 1}
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    finally:
        spark.sql(f"drop table if exists {name}")


def test_batch_overwrite_replaces_only_that_batch(spark, rows, tmp_path):
    path = str(tmp_path / "bronze")
    batch = lambda b, df: files.replace_partitions(
        df.withColumn("batch_id", F.lit(b)), path, ["batch_id"])
    batch("20260718", rows)
    batch("20260719_001", rows.withColumn("extra", F.lit("x")))
    batch("20260718", rows.limit(1))
    back = files.read_batches(spark, path)
    assert dict([(f.name, f.dataType.simpleString())
                 for f in back.schema])["batch_id"] == "string"
    assert {r.batch_id: r["count"] for r in back.groupBy("batch_id").count().collect()} == {
        "20260718": 1, "20260719_001": 3}
    assert back.where("extra = 'x'").count() == 3


def test_null_partition_value(spark, rows, tmp_path):
    path = str(tmp_path / "f")
    files.overwrite_path(rows.withColumn("date_sk", F.col("n")), path, partition_by=["date_sk"])
    assert spark.read.parquet(path).where("date_sk is null").count() == 1


def test_counter_on_write(rows, tmp_path):
    df, seen = files.counted(rows)
    files.overwrite_path(df, str(tmp_path / "x"))
    assert files.observed(seen) == 3


def test_compaction_spreads_a_hot_key(spark, tmp_path):
    df = spark.range(4000).selectExpr("if(id % 2 = 0, -1, id) as k", "id")
    path = str(tmp_path / "c")
    files.overwrite_path(files.compact(df, ["k"], 8), path)
    back = spark.read.parquet(path)
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert back.count() == 4000 and len(sizes) == 8 and max(sizes) < 1000


def test_retention(spark, frame, tmp_path):
    import datetime as dt
    df = frame([(dt.date(2026, 6, 17),), (dt.date(2026, 6, 18),), (None,)], "ingestion_date date")
    assert files.retained(df, "ingestion_date", "2026-07-18", 30).count() == 1
    root = str(tmp_path / "land")
    df.dropna().withColumn("v", F.lit(1)).write.partitionBy("ingestion_date").parquet(root)
    old = files.expired_partitions(spark, root, "2026-07-18", 30)
    assert [p.rsplit("/", 1)[1] for p in old] == ["ingestion_date=2026-06-17"]
    assert files.drop_partitions(spark, old) == 1
    assert spark.read.parquet(root).count() == 1
    assert files.expired_partitions(spark, str(tmp_path / "none"), "2026-07-18", 30) == []


def test_shared_root_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = files.shared_root(spark, "x"), files.shared_root(spark, "x")
    assert first != second
    assert base is None or first.startswith(base.rstrip("/") + "/x-")


def test_versions_ignore_uncommitted_writes(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    assert versions.read_current(spark, root) is None
    assert versions.write_version(rows, root) == 1
    rows.limit(0).write.parquet(f"{root}/v=000002")          # a write that never committed
    assert versions.read_current(spark, root).count() == 3
    current = versions.read_current(spark, root)
    assert versions.write_version(current.where("n = 1"), root) == 2
    assert versions.read_current(spark, root).count() == 1


def test_partitioned_versions(spark, frame, tmp_path):
    root, schema = str(tmp_path / "p"), "id string, m string"
    versions.write_version(frame([("a", "202601"), ("b", "202602"), ("c", None)], schema), root, "m")
    part = versions.read_current(spark, root, only=["m=202601"])
    assert [r.id for r in part.collect()] == ["a"]
    moved = frame([("a", "202602"), ("b", "202602")], schema)
    versions.write_version(moved, root, "m", touched=["m=202601", "m=202602"])
    now = versions.read_current(spark, root)
    assert sorted((r.id, r.m) for r in now.collect()) == [("a", "202602"), ("b", "202602"), ("c", None)]
    assert versions.read_current(spark, root, only=["m=209901"]) is None


CONFIG = [
    {"table_name": "a", "source_system": "S", "layer_role": "DIM", "primary_key": "id", "scd_type": 2,
     "natural_keys": ["id"], "bronze_path": "p", "silver_table": "silver_a",
     "bronze_table": "bronze_a", "active_flag": True},
    {"table_name": "b", "source_system": "S", "layer_role": "FACT", "primary_key": "id", "scd_type": 1,
     "natural_keys": ["id"], "bronze_path": "p", "silver_table": "silver_b",
     "bronze_table": "bronze_b", "active_flag": False},
]


def test_config(spark, tmp_path):
    path = str(tmp_path / "table_config.json")
    with open(path, "w") as out:
        json.dump(CONFIG, out, indent=2)
    active = config.table_config(spark, path)
    assert [r.table_name for r in active.collect()] == ["a"]
    everything = config.table_config(spark, path, active_only=False)
    assert everything.count() == 2
    assert config.table_config(spark, path, layer_role="FACT").count() == 0
    record = config.config_of(everything, "b")
    assert record.scd_type == 1 and record.natural_keys == ("id",)
    with pytest.raises(ValueError, match="no configuration"):
        config.config_of(active, "b")
    with pytest.raises(ValueError):
        config.table_config(spark, table="t_absent")


def test_config_prefers_the_table(spark, tmp_path):
    path = str(tmp_path / "c.json")
    with open(path, "w") as out:
        json.dump(CONFIG[:1], out)
    spark.sql("drop table if exists t_meta_config")
    try:
        config.table_config(spark, path).withColumn("source_system", F.lit("T")).write.saveAsTable(
            "t_meta_config")
        row = config.table_config(spark, path, "t_meta_config").first()
        assert row.source_system == "T"
    finally:
        spark.sql("drop table if exists t_meta_config")


def test_control_schema_has_no_surprises():
    assert len(RUN_LOG_SCHEMA) == 13


def test_files_that_one_task_reads_whole_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(files, "WHOLE_FILE_ROWS", 20)
    out = layers.read_formats(spark, "/root/testdata/sf0.001")
    n = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()
    assert len([f for f in out.inputFiles() if f.endswith(".xml")]) >= n // 20
    assert {(r.fmt, r["count"]) for r in out.groupBy("fmt").count().collect()} == {
        (f, n) for f in ("parquet", "orc", "csv", "json", "xml")}
