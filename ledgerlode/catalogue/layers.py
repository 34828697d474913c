"""Queries over the landing, bronze and silver row operators."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ledgerlode.catalogue.registry import query
from ledgerlode.catalogue.views import money, ntz, table
from ledgerlode.functions.exprs import date_key, row_digest
from ledgerlode.operators import rows
from ledgerlode.plans.jobs import Lake, land, load_bronze
from ledgerlode.sources import files
from ledgerlode.sources.config import TableConfig

LOAD = "2001-08-02 06:00:00"


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")


def _stamped(spark, sf):
    return rows.stamp_audit(_orders(spark, sf), "CORE", F.date_format("o_orderdate", "yyyy"),
                            "daily", ntz(LOAD), "orders.parquet")


ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus,
    CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
    o_orderpriority FROM orders"""
RECORD_HASH = """sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
    o_orderstatus, CAST(o_totalprice AS VARCHAR), CAST(o_orderdate AS VARCHAR), o_orderpriority))"""


@query(f"""SELECT *, 'CORE' AS source_system, strftime(o_orderdate, '%Y') AS batch_id,
    'daily' AS pipeline_name, TIMESTAMP '{LOAD}' AS load_timestamp, 'orders.parquet' AS file_name,
    TIMESTAMP '{LOAD}' AS ingestion_timestamp, {RECORD_HASH} AS record_hash FROM ({ORDERS})""")
def audit_stamp(spark, sf):
    return _stamped(spark, sf)


@query(f"SELECT *, TIMESTAMP '{LOAD}' AS silver_load_timestamp FROM ({ORDERS})")
def silver_stamp(spark, sf):
    return rows.stamp_silver(rows.drop_audit(_stamped(spark, sf)), ntz(LOAD))


def _nullable_people(spark, sf):
    """Customers in debt have no segment, customers with a round thousand of debt no name."""
    balance = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey", F.when(balance >= -500, F.col("c_name")).alias("c_name"),
        F.when(balance >= 0, F.col("c_mktsegment")).alias("c_mktsegment"), "c_nationkey",
        money("c_acctbal").alias("c_acctbal"))


PEOPLE = """(SELECT c_custkey, CASE WHEN c_acctbal >= -500 THEN c_name END AS c_name,
    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment, c_nationkey,
    CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer)"""
_HASHED = ["c_name", "c_mktsegment", "c_nationkey", "c_acctbal"]
_STRICT = ", ".join(
    f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in _HASHED)


@query(f"""SELECT c_custkey, sha256(concat_ws('||', c_name, c_mktsegment,
    CAST(c_nationkey AS VARCHAR), CAST(c_acctbal AS VARCHAR))) AS record_hash FROM {PEOPLE}""")
def record_hash_compat(spark, sf):
    return _nullable_people(spark, sf).select("c_custkey", row_digest(_HASHED).alias("record_hash"))


@query(f"SELECT c_custkey, sha256(concat_ws('||', {_STRICT})) AS record_hash FROM {PEOPLE}")
def record_hash_strict(spark, sf):
    return _nullable_people(spark, sf).select(
        "c_custkey", row_digest(_HASHED, "strict").alias("record_hash"))


@query(f"""SELECT * FROM (SELECT *, strftime(o_orderdate, '%Y') AS batch_id FROM ({ORDERS}))
    WHERE batch_id = '1998'""")
def batch_filter(spark, sf):
    root = files.shared_root(spark, "batches")
    batches = _orders(spark, sf).withColumn("batch_id", F.date_format("o_orderdate", "yyyy"))
    files.replace_partitions(batches.hint("rebalance", "batch_id"), root, ["batch_id"])
    return rows.of_batch(files.read_batches(spark, root, batches.schema), "1998")


def _keyed(spark, sf):
    return table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("c_custkey"), "c_name",
        F.col("c_nationkey"))


_KEYED = """(SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS c_custkey, c_name, c_nationkey
    FROM customer)"""


@query(f"SELECT * FROM {_KEYED} WHERE c_custkey IS NOT NULL")
def pk_split_good(spark, sf):
    return rows.split_quarantine(_keyed(spark, sf), ["c_custkey"])[0]


@query(f"SELECT * FROM {_KEYED} WHERE c_custkey IS NULL")
def pk_split_quarantine(spark, sf):
    return rows.split_quarantine(_keyed(spark, sf), ["c_custkey"])[1]


_TARGET = T.StructType([T.StructField("o_orderkey", T.LongType()),
                        T.StructField("o_totalprice", T.DecimalType(18, 2)),
                        T.StructField("o_orderdate", T.DateType())])


def _as_text(spark, sf):
    priced = _orders(spark, sf)
    suffix = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(" GBP")).otherwise(F.lit(""))
    return priced.select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                         F.concat(F.col("o_totalprice").cast("string"), suffix).alias("o_totalprice"),
                         F.col("o_orderdate").cast("string").alias("o_orderdate"),
                         "o_orderpriority")


_AS_TEXT = f"""(SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) ||
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' GBP' ELSE '' END AS o_totalprice,
    CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM ({ORDERS}))"""


@query(f"""SELECT TRY_CAST(o_orderkey AS BIGINT) AS o_orderkey,
    TRY_CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
    TRY_CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM {_AS_TEXT}
    WHERE TRY_CAST(o_totalprice AS DECIMAL(18,2)) IS NOT NULL""")
def enforce_schema(spark, sf):
    return rows.enforce_schema(_as_text(spark, sf), _TARGET, "quarantine")[0]


@query(f"""SELECT * FROM {_AS_TEXT} WHERE TRY_CAST(o_totalprice AS DECIMAL(18,2)) IS NULL""")
def enforce_schema_quarantine(spark, sf):
    return rows.enforce_schema(_as_text(spark, sf), _TARGET, "quarantine")[1]


@query("""SELECT c_custkey, trim('  ' || c_name || ' ') AS c_name,
    upper(trim(' ' || lower(c_mktsegment))) AS c_mktsegment FROM customer""")
def trim_upper(spark, sf):
    padded = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("c_mktsegment"))
    return rows.standardise_text(padded, upper=["c_mktsegment"])


@query("""SELECT c_custkey, repeat('*', 4) || right(c_name, 4) AS c_name,
    substr(sha256(CAST(c_acctbal AS VARCHAR)), 1, 32) AS c_acctbal,
    CAST(NULL AS VARCHAR) AS c_nationkey,
    regexp_replace(regexp_replace(regexp_replace(c_mktsegment, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'),
    '[0-9]', 'n', 'g') AS c_mktsegment
    FROM (SELECT * REPLACE (CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal) FROM customer)""")
def mask_columns(spark, sf):
    people = table(spark, sf, "customer").withColumn("c_acctbal", money("c_acctbal"))
    return rows.mask_columns(people, {"c_name": "tail", "c_acctbal": "token", "c_nationkey": "null",
                                      "c_mktsegment": "shape"})


@query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_custkey IN (
    SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')""")
def entitled_rows(spark, sf):
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    entitlement = (table(spark, sf, "customer")
                   .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
                   .select(F.col("c_custkey").alias("o_custkey"), F.col("r_name").alias("role")))
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return rows.entitled_rows(orders, entitlement, ["o_custkey"], "role", "EUROPE")


@query("""SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_quantity AS INTEGER) AS l_quantity,
    CAST(l_discount AS DECIMAL(4,2)) AS l_discount, sha256(concat_ws('||', l_returnflag, l_linestatus,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR)))
    AS record_hash FROM lineitem""")
def dedup_hash(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").alias("l_quantity"),
        F.col("l_discount").cast("decimal(4,2)").alias("l_discount"))
    stamped = rows.stamp_audit(lines, "CORE", "b1", "daily", ntz(LOAD), "lineitem.parquet")
    return rows.dedup_by_hash(stamped).select(*lines.columns, "record_hash")


@query("SELECT DISTINCT trim(text) AS text, lang FROM documents")
def dedup_business(spark, sf):
    texts = table(spark, sf, "documents").select(
        "text", "lang", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("file_name"))
    return rows.dedup_business(rows.standardise_text(texts))


@query("""SELECT DISTINCT trim(text) AS text, lang, CAST(n_chars AS BIGINT) AS n_chars FROM documents
    WHERE lang IS NOT NULL""")
def cleanse_documents(spark, sf):
    return rows.cleanse(table(spark, sf, "documents").select("text", "lang", "n_chars"), ["lang"])


@query("SELECT DISTINCT p_brand, p_type, p_size FROM part")
def distinct_tuples(spark, sf):
    return table(spark, sf, "part").select("p_brand", "p_type", "p_size").distinct()


@query("""SELECT o_orderkey, o_orderstatus, NULL AS o_orderpriority FROM orders
    WHERE o_orderdate < TIMESTAMP '1998-01-01' UNION ALL BY NAME
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def union_batches(spark, sf):
    orders = table(spark, sf, "orders")
    cut = ntz("1998-01-01 00:00:00")
    early = orders.where(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderstatus")
    late = orders.where(F.col("o_orderdate") >= cut).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority")
    return rows.union_batches(early, late)


@query("""SELECT event_id, user_id, CASE WHEN event_type IN ('view', 'click') THEN 'mobile' ELSE 'web'
    END AS feed FROM events""")
def channel_split(spark, sf):
    events = table(spark, sf, "events").withColumn(
        "channel", F.when(F.col("event_type").isin("view", "click"), F.lit("MOBILE_APP"))
        .otherwise(F.lit("WEB")))
    mobile, web = rows.split_channel(events, "channel", "MOBILE_APP")
    columns = ["event_id", "user_id"]
    return mobile.select(*columns, F.lit("mobile").alias("feed")).unionByName(
        web.select(*columns, F.lit("web").alias("feed")))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem""")
def compact_cluster(spark, sf):
    root = files.shared_root(spark, "compact")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    files.overwrite_path(files.compact(lines, ["l_suppkey", "l_partkey"], files.file_count(lines)), root)
    return spark.read.schema(lines.schema).parquet(root)


@query(f"SELECT * FROM ({ORDERS}) WHERE o_orderdate >= DATE '2001-08-01' - 1095")
def retention_cut(spark, sf):
    return files.retained(_orders(spark, sf), "o_orderdate", "2001-08-01", 1095)


_FORMATS = ("parquet", "orc", "csv", "json", "xml")


@query(" UNION ALL ".join(f"SELECT '{f}' AS fmt, * FROM customer" for f in _FORMATS))
def read_formats(spark, sf):
    root = files.shared_root(spark, "formats")
    people = table(spark, sf, "customer")
    schema = people.schema
    parts = []
    for fmt in _FORMATS:
        path = f"{root}/{fmt}"
        writer = people.write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", "true")
        if fmt == "xml":
            # A reader takes a file of XML whole, so no file may grow with the table.
            writer = writer.options(rowTag="row", maxRecordsPerFile=files.WHOLE_FILE_ROWS)
        writer.save(path)
        found = files.read_first_existing(spark, fmt, [f"{root}/missing/{fmt}", path], schema)
        parts.append(found.select(F.lit(fmt).alias("fmt"), *people.columns))
    return rows.union_batches(*parts)


@query("""SELECT 'append' AS sink, o_orderstatus, 2 * count(*) AS n_rows FROM orders GROUP BY ALL
    UNION ALL SELECT 'overwrite', o_orderstatus, count(*) FROM orders GROUP BY ALL
    UNION ALL SELECT 'partitioned', o_orderstatus, count(*) FROM orders GROUP BY ALL
    UNION ALL SELECT 'partitioned null date', o_orderstatus, count(*) FROM orders
    WHERE o_orderpriority = '1-URGENT' GROUP BY ALL""")
def sink_roundtrip(spark, sf):
    root = files.shared_root(spark, "sinks")
    orders = _orders(spark, sf)
    dated = orders.withColumn("date_sk", F.when(
        F.col("o_orderpriority") != "1-URGENT", date_key(F.trunc("o_orderdate", "year"))))
    for _ in range(2):
        files.overwrite_path(orders, f"{root}/overwrite")
        files.append_path(orders, f"{root}/append")
    files.overwrite_path(dated, f"{root}/partitioned", partition_by=["date_sk"])

    def counts(sink, df):
        return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(sink).alias("sink"), "o_orderstatus", "n_rows")

    by_date = spark.read.parquet(f"{root}/partitioned")
    return rows.union_batches(
        counts("append", spark.read.parquet(f"{root}/append")),
        counts("overwrite", spark.read.parquet(f"{root}/overwrite")),
        counts("partitioned", by_date),
        counts("partitioned null date", by_date.where("date_sk is null")))


@query("""SELECT batch_id, o_orderstatus, count(*) AS n_rows, count(DISTINCT record_hash) AS n_hashes
    FROM (SELECT 'b1' AS batch_id, o_orderstatus, o_orderkey AS record_hash FROM orders UNION ALL
    SELECT 'b2', o_orderstatus, o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY ALL""")
def bronze_rerun(spark, sf):
    cfg = TableConfig("orders", "CORE", "FACT", "o_orderkey", 1, ("o_orderkey",), "", "silver_orders",
                      "bronze_orders", True)
    lake = Lake(spark, files.shared_root(spark, "lake"), "daily", "2001-08-02", LOAD)
    orders = _orders(spark, sf)
    deliveries = [("b1", orders.unionByName(orders)), ("b1", orders),
                  ("b2", orders.where("o_orderstatus <> 'P'"))]
    for batch_id, df in deliveries:
        land(lake, cfg, batch_id, df)
        load_bronze(lake, cfg, batch_id, orders.schema)
    bronze = files.read_batches(spark, lake.path("bronze", "bronze_orders"))
    return bronze.groupBy("batch_id", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("record_hash").alias("n_hashes"))
