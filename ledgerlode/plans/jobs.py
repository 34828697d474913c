"""Batch jobs from landing to the gate. Each step is a function of a lake, a table and a batch."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerlode.functions.exprs import col
from ledgerlode.operators import evolve, pit, quality, rows, scd, star, zorder
from ledgerlode.operators.ordering import surrogate_key
from ledgerlode.plans import gold, incremental
from ledgerlode.sources import bronze, files, keymap, tables, versions
from ledgerlode.sources.config import TableConfig

LANDING_DAYS = 30            # fixed value: retention of the landing layer


@dataclass
class Lake:
    """Where the layers live, and what is constant over a batch.

    With a ``database`` the silver tables are bucketed tables of the session catalog, which a batch merges into bucket by
    bucket; the other layers stay under ``root``. Without ``buckets`` a table's first batch decides by its bytes how many
    it gets. ``digest_mode`` is that of the stored record hash; changes are
    found by ``change_mode``, which no two different rows share.
    """

    spark: SparkSession
    root: str
    pipeline: str
    ingestion_date: str
    load_ts: str
    fmt: str = "parquet"
    digest_mode: str = "compat"
    change_mode: str = "strict"
    parallel: int = 8            # tables loaded at a time
    database: str | None = None
    buckets: int | None = incremental.BUCKETS
    log: list[dict] = field(default_factory=list)

    def path(self, layer: str, table: str = "") -> str:
        return "/".join(p for p in (self.root, layer, table) if p)

    def target(self, table: str, keys: Sequence[str] = (), batch: DataFrame | None = None) -> incremental.Target:
        buckets = self.buckets or (1 if batch is None else files.file_count(batch, incremental.BUCKET_BYTES))
        return incremental.Target(f"{self.database}.{table}", tuple(keys), buckets)

    def note(self, step: str, layer: str, table: str, batch_id: str, status: str, **more) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.log.append({"pipeline_name": self.pipeline, "notebook_name": step, "layer": layer,
                         "table_name": table, "batch_id": batch_id, "status": status,
                         "start_time": more.pop("start_time", now), "end_time": now, **more})

    def flush_log(self) -> None:
        """One append for all events since the last one, in place of one small file per event."""
        if self.log:
            events = quality.run_log(self.spark, self.log).coalesce(1)
            files.append_path(events, self.path("control", "pipeline_execution_log"), self.fmt)
            self.log.clear()

    def each(self, work: Callable, items: Iterable) -> list:
        """Apply independent Spark work to every item, several at a time: one small table alone does
        not fill a cluster. The first failure is raised."""
        with ThreadPoolExecutor(self.parallel) as pool:
            return list(pool.map(work, items))


def _step(lake: Lake, step: str, layer: str, table: str, batch_id: str, work) -> dict[str, int]:
    """Run one unit of work between its log events; a failure is logged and raised again."""
    begun = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    lake.note(step, layer, table, batch_id, "STARTED", start_time=begun)
    try:
        counts = work()
    except Exception as error:
        lake.note(step, layer, table, batch_id, "FAILED", start_time=begun,
                  error_message=str(error))
        raise
    lake.note(step, layer, table, batch_id, "SUCCESS", start_time=begun,
              rows_read=counts.get("rows_read"), rows_written=counts.get("rows_written"))
    return counts


def land(lake: Lake, cfg: TableConfig, batch_id: str, source: DataFrame) -> dict[str, int]:
    """Copy a source extract into its landing partition; landing again replaces it."""
    def work():
        target = files.landing_path(lake.path("landing"), cfg.source_system, cfg.table_name,
                                    lake.ingestion_date, batch_id)
        df, seen = files.counted(source)
        files.overwrite_path(df, target, lake.fmt)
        n = files.observed(seen)
        return {"rows_read": n, "rows_written": n}
    return _step(lake, "landing", "LANDING", cfg.table_name, batch_id, work)


def load_bronze(lake: Lake, cfg: TableConfig, batch_id: str,
                schema: T.StructType | None = None) -> dict[str, int]:
    """Landing partition to bronze: one row of each kind, stamp, replace the batch.

    The types are those of the given contract, else the table's types so far widened by those landed, so no value is
    changed by a cast; rows with a value that the type cannot hold go to quarantine as they came. Each batch keeps
    the types it was stored with (``sources.bronze``). A batch without rows is stored as one, and replaces what an
    earlier delivery of it left.
    """
    def work():
        spark, target = lake.spark, lake.path("bronze", cfg.bronze_table)
        landed = files.read_landing(spark, lake.path("landing"), cfg.source_system, cfg.table_name,
                                    lake.ingestion_date, batch_id, lake.fmt)
        known = bronze.known_schema(spark, target, leave_out=batch_id)
        contract = schema or evolve.widened(known, landed.schema)
        whole, misfits = evolve.fit(landed, contract)
        landed, read = files.counted(landed, "read")
        typed, _ = evolve.fit(landed, contract)
        refused = f"{lake.path('control', f'bronze_quarantine_{cfg.table_name}')}/batch_id={batch_id}"
        if any(f.name in contract.names and contract[f.name].dataType != f.dataType for f in landed.schema):
            files.overwrite_path(misfits, refused, lake.fmt)
        else:                                        # nothing is cast; what an earlier delivery left there goes
            files.discard(spark, refused)
        # Rows repeat each other only when all their columns agree; the stored digest may skip nulls.
        # One hash per row tells in advance whether any do, so that else no row is moved.
        if quality.has_repeats(whole):
            typed = typed.dropDuplicates()
        stamped = rows.stamp_audit(typed, cfg.source_system, batch_id, lake.pipeline, lake.load_ts,
                                   f"{cfg.table_name}.{lake.fmt}", lake.digest_mode)
        unique, written = files.counted(stamped, "written")
        files.overwrite_path(unique.drop("batch_id"), f"{target}/batch_id={batch_id}", lake.fmt)
        bronze.record_schema(spark, target, batch_id, typed.schema)
        return {"rows_read": files.observed(read), "rows_written": files.observed(written)}
    return _step(lake, "bronze", "BRONZE", cfg.table_name, batch_id, work)


def to_silver(lake: Lake, cfg: TableConfig, batch_id: str, upper: Iterable[str] = (),
              masks: Mapping[str, str] | None = None, on_duplicate: str = "error",
              first_start: str | None = None, month_of: str | None = None,
              keys_stay: bool = False) -> dict[str, int]:
    """One bronze batch into its silver table: quarantine, cleanse, profile, merge by SCD type.

    Reads the partition of the batch and, of the silver table, the current rows only. For a large
    type 1 table, ``month_of`` names a date column by whose month the table is laid out; the merge then
    reads and rewrites only the months that the batch touches (see ``_upsert_months``).
    """
    keys = list(cfg.natural_keys or (cfg.primary_key,))

    stages: list[str] = []

    def work():
        spark = lake.spark
        batch = spark.read.format(lake.fmt).load(
            f"{lake.path('bronze', cfg.bronze_table)}/batch_id={batch_id}")
        _, rejected = rows.split_quarantine(batch, keys)
        quarantine = lake.path("control", f"dq_quarantine_{cfg.table_name}")
        files.overwrite_path(rejected, f"{quarantine}/batch_id={batch_id}", lake.fmt)
        # The cleansed batch is scanned several times below; stored, it is cleansed once. Dealt by key it is cleansed,
        # profiled and merged with one shuffle.
        stage, target = lake.path("stage", f"{cfg.table_name}/batch_id={batch_id}"), None
        trimmed = rows.drop_audit(rows.standardise_text(rows.split_quarantine(batch, keys)[0], upper))
        if lake.database:
            target = lake.target(cfg.silver_table, keys, batch)
            n = incremental.buckets_for(spark, target)

            def staged(df: DataFrame) -> DataFrame:
                stages.append(f"{lake.database}.stage_{cfg.table_name}_{uuid.uuid4().hex}")
                return tables.stage_bucketed(rows.mask_columns(df, masks) if masks else df, stages[-1], keys, n)

            dealt = trimmed.repartition(n, *[col(k) for k in keys])
            clean = staged(dealt)
            profile = quality.dq_profile(clean, cfg.table_name, keys).first()
            if profile.duplicate_pk_groups:          # rows repeat each other only where keys do
                clean = staged(dealt.distinct())
                profile = quality.dq_profile(clean, cfg.table_name, keys).first()
        else:
            clean = trimmed.distinct() if quality.has_repeats(trimmed) else trimmed
            if masks:
                clean = rows.mask_columns(clean, masks)
            files.overwrite_path(clean, stage, lake.fmt)
            clean = spark.read.format(lake.fmt).schema(clean.schema).load(stage)
            profile = quality.dq_profile(clean, cfg.table_name, keys).first()
        _await_gold(lake, cfg.silver_table)
        if profile.duplicate_pk_groups and on_duplicate == "error":
            raise quality.DataQualityError(
                f"{cfg.table_name}: {profile.duplicate_pk_groups} keys occur more than once")
        guard = on_duplicate if profile.duplicate_pk_groups else "checked"
        columns = [c for c in clean.columns if c != tables.BUCKET]
        tracked = [c for c in columns if c not in keys]
        source = rows.stamp_silver(clean, lake.load_ts)
        newest = [F.xxhash64(*columns)]
        if lake.database:
            written = _merge_buckets(lake, cfg, target, batch_id, source, tracked, guard, newest, first_start)
            return {"rows_read": batch.count(), "rows_written": written, "rows_clean": profile.total_rows}
        target = lake.path("silver", cfg.silver_table)
        if cfg.scd_type != 2 and month_of:
            written = _upsert_months(lake, target, source, keys, month_of, keys_stay, guard,
                                     newest)
        else:
            current = versions.read_current(spark, target, lake.fmt)
            if cfg.scd_type == 2:
                merged = scd.merge_scd2(current, source, keys, tracked, lake.load_ts,
                                        lake.change_mode, guard, newest, first_start)
            else:
                merged = scd.merge_scd1(current, source, keys, guard, newest)
            merged, seen = files.counted(merged, "silver")
            versions.write_version(merged, target, scd.CURRENT if cfg.scd_type == 2 else None,
                                   lake.fmt)
            written = files.observed(seen)
        files.discard(spark, stage)
        return {"rows_read": batch.count(), "rows_written": written,
                "rows_clean": profile.total_rows}
    try:
        return _step(lake, "silver", "SILVER", cfg.table_name, batch_id, work)
    finally:
        for table in stages:
            lake.spark.sql(f"DROP TABLE IF EXISTS {table}")


def _merge_buckets(lake: Lake, cfg: TableConfig, target: incremental.Target, batch_id: str, source: DataFrame,
                   tracked: list[str], on_duplicate: str, newest: Sequence[Column], first_start: str | None) -> int:
    if cfg.scd_type == 2:
        return incremental.merge_type2(target, source, tracked, lake.load_ts, batch_id, lake.change_mode,
                                       on_duplicate, newest, first_start).rows
    return incremental.merge_type1(target, source, on_duplicate, newest).rows


_PENDING = "gold_pending"


def _await_gold(lake: Lake, silver: str) -> None:
    """Mark a silver table, before it changes, as one that the gold tables on it have yet to follow."""
    files.touch(lake.spark, f"{lake.path('control', _PENDING)}/{silver}")


MONTH = "silver_month"


def _upsert_months(lake: Lake, target: str, source: DataFrame, keys: Sequence[str], date_column: str,
                   keys_stay: bool, on_duplicate: str, newest: Sequence[Column]) -> int:
    """Type 1 merge that rewrites the touched months of a table laid out by month.

    Touched are the months of the batch and every month in which the table holds one of its keys under
    another date; the latter are found by a semi join over the key and month columns alone. With
    ``keys_stay`` the caller vouches that a key never changes its month, and that join is left out.
    """
    spark = lake.spark
    source = source.withColumn(MONTH, F.date_format(date_column, "yyyyMM"))
    touched = source.select(MONTH)
    current = versions.read_current(spark, target, lake.fmt)
    if current is not None and not keys_stay:
        held = current.select(*keys, MONTH).join(source.select(*keys), keys, "left_semi")
        touched = touched.unionByName(held.select(MONTH))
    names = [f"{MONTH}={row[MONTH] or '__HIVE_DEFAULT_PARTITION__'}"
             for row in touched.distinct().collect()]        # at most one row per calendar month
    part = versions.read_current(spark, target, lake.fmt, only=names)
    merged, seen = files.counted(scd.merge_scd1(part, source, keys, on_duplicate, newest), "months")
    merged = merged.hint("rebalance", MONTH)
    versions.write_version(merged, target, MONTH, lake.fmt, touched=names)
    return files.observed(seen)


def read_silver(lake: Lake, table: str, history: bool = False) -> DataFrame | None:
    if lake.database:
        read = incremental.read_history if history else incremental.read_current
        return read(lake.spark, lake.target(table))
    read = versions.read_history if history else versions.read_current
    df = read(lake.spark, lake.path("silver", table), lake.fmt)
    return None if df is None else df.drop(MONTH)


def read_gold(lake: Lake, table: str) -> DataFrame:
    return lake.spark.read.format(lake.fmt).load(lake.path("gold", table))


def build_gold(lake: Lake, batch_id: str,
               dimensions: Sequence[gold.Dimension] = tuple(gold.DIMENSIONS),
               facts: Sequence[gold.Fact] = tuple(gold.FACTS), revenue: str | None = "account",
               calendar: tuple[str, str] | None = (star.CALENDAR_START, star.CALENDAR_END),
               key_mode: str = "sequence", date_partition: str = "day", only_changed: bool = False) -> dict[str, int]:
    """Dimensions, calendar, facts and revenue from silver. Facts read current rows only, so a fraud or
    collections case with two versions stays one fact row.

    Without a ``calendar`` it spans the dates of the facts. ``key_mode`` ``stored`` takes surrogate keys from maps in the
    catalog that only grow (it needs a ``database``). ``date_partition`` is the grain of the fact directories: ``day``
    (column ``date_sk``) suits facts with gigabytes per day, ``month`` (an added column ``month_sk``) smaller ones.

    With ``only_changed`` gold tables stay as they are whose silver tables, and the dimensions they look up, no
    batch has written since their last build by these options. A build that stopped is done again in full.
    """
    def work():
        waiting = files.child_names(lake.spark, lake.path("control", _PENDING))

        def stale(name: str, silver: Iterable[str], below: Iterable[str] = ()) -> bool:
            return (not only_changed or not files.path_exists(lake.spark, f"{lake.path('gold', name)}/_SUCCESS")
                    or not {*silver, *below}.isdisjoint({*waiting, *built_dimensions}))

        built_dimensions: set[str] = set()
        if calendar or stale("DimDate", [f.silver for f in facts if f.date_column]):
            days = star.dim_date(lake.spark, *calendar) if calendar else star.calendar_of(_bounds(lake, facts))
            files.overwrite_path(days, lake.path("gold", "DimDate"), lake.fmt)
        days = read_gold(lake, "DimDate")

        def dimension(d: gold.Dimension) -> int:
            silver = read_silver(lake, d.silver, history=d.history)
            order = [d.natural_key, scd.START] if d.history else [d.natural_key]
            if key_mode == "stored":
                n = tables.buckets_of(lake.spark, lake.target(d.silver).name)
                keyed = keymap.assign_keys(silver, order, d.sk, f"{lake.database}.key_map_{d.name.lower()}", n)
            else:
                keyed = surrogate_key(silver, order, d.sk, key_mode)
            return store(keyed, d.name)

        def store(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> int:
            df, seen = files.counted(df, name)
            files.overwrite_path(df, lake.path("gold", name), lake.fmt, partition_by)
            return files.observed(seen)

        def lookup(name: str) -> tuple[DataFrame, str]:
            d = next(d for d in dimensions if d.name == name)
            known = star.current_lookup(read_gold(lake, name), d.natural_key, d.sk)
            return star.joined_by_rows(known, sizes[name]), d.natural_key

        def at_event(events: DataFrame, e: gold.AtEvent) -> DataFrame:
            """The fact's rows with what the dimension said at their time, instead of what it says now."""
            versions_ = read_gold(lake, e.dimension).select(
                e.key, scd.START, scd.END, *[F.col(c).alias(name) for c, name in e.columns])
            return pit.pit_join(events, star.joined_by_rows(versions_, sizes[e.dimension]), [e.key], e.event_time,
                                scd.START, scd.END, [name for _, name in e.columns], "join")

        def below(f: gold.Fact) -> list[str]:
            return [*f.dimensions, *[e.dimension for e in f.at_event]]

        def fact(f: gold.Fact) -> int:
            events = read_silver(lake, f.silver)
            for e in f.at_event:
                events = at_event(events, e)
            df = star.resolve_fact(events, [lookup(n) for n in f.dimensions], f.columns, days, f.date_column)
            partition_by = f.partition_by
            if partition_by and date_partition == "month":
                df = df.withColumn("month_sk", F.floor(F.col("date_sk") / 100).cast("int"))
                partition_by = ("month_sk",)
            return store(df, f.name, partition_by)

        def earnings(by: str) -> int:
            return store(star.fact_revenue(
                read_silver(lake, "silver_interest_charge"), read_silver(lake, "silver_fee"),
                lookup("DimAccount")[0], by=by), "FactRevenue")

        due = [d for d in dimensions if stale(d.name, [d.silver])]
        written = lake.each(dimension, due)
        built_dimensions.update(d.name for d in due)
        built = [(fact, f) for f in facts if stale(f.name, [f.silver], below(f))]
        if revenue and stale("FactRevenue", ["silver_interest_charge", "silver_fee"], ["DimAccount"]):
            built.append((earnings, revenue))
        sizes = {d.name: n for d, n in zip(due, written)}
        for name in {n for job, f in built for n in (below(f) if job is fact else ["DimAccount"])} - sizes.keys():
            sizes[name] = read_gold(lake, name).count()
        written += lake.each(lambda job: job[0](job[1]), built)
        for name in waiting:
            files.discard(lake.spark, f"{lake.path('control', _PENDING)}/{name}")
        return {"rows_written": sum(written)}
    return _step(lake, "gold", "GOLD", "ALL_DIMENSIONS_AND_FACTS", batch_id, work)


def _bounds(lake: Lake, facts: Sequence[gold.Fact]) -> DataFrame:
    """One row with the first and the last date of all dated facts."""
    dated = [read_silver(lake, f.silver).agg(F.min(f.date_column).cast("date").alias("first"),
                                             F.max(f.date_column).cast("date").alias("last"))
             for f in facts if f.date_column]
    return rows.union_batches(*dated).agg(F.min("first").alias("first"), F.max("last").alias("last"))


def validate_gold(lake: Lake, batch_id: str,
                  references: Mapping[str, Sequence[tuple[str, str]]] = gold.GATE_REFERENCES,
                  limit: float = quality.ORPHAN_RATE_LIMIT, not_null: Mapping[str, Sequence[str]] | None = None,
                  null_limit: float = quality.NULL_RATE_LIMIT) -> dict[str, int]:
    """Referential checks of the facts, and NULL rates of the columns in ``not_null``, in one gate; the summary is
    stored first, then a failed check raises."""
    def work():
        checks = quality.union_checks(
            [quality.orphan_checks(read_gold(lake, fact), fact, pairs, limit) for fact, pairs in references.items()]
            + [quality.null_checks(read_gold(lake, fact), fact, columns, null_limit)
               for fact, columns in (not_null or {}).items()])
        summary = quality.summary_rows(checks, batch_id, lake.load_ts)
        path = lake.path("control", "dq_validation_summary")
        files.replace_partitions(summary.coalesce(1), path, ["batch_id"], lake.fmt)
        stored = files.read_batches(lake.spark, path, fmt=lake.fmt)
        stored = rows.of_batch(stored, batch_id)
        quality.dq_gate(stored)
        return {"rows_written": stored.count()}
    return _step(lake, "validation", "VALIDATION", "GOLD_LAYER", batch_id, work)


def expire_landing(lake: Lake, cfg: TableConfig, as_of: str, days: int = LANDING_DAYS) -> int:
    """Delete landing partitions older than the retention; returns how many."""
    path = f"{lake.path('landing')}/{cfg.source_system}/{cfg.table_name}"
    return files.drop_partitions(lake.spark, files.expired_partitions(lake.spark, path, as_of, days))


def maintain_silver(lake: Lake, cfg: TableConfig, keys: Sequence[str], file_count: int | None = None) -> int:
    """Rewrite the current state clustered by ``keys``, then delete replaced states; returns how many
    directories went. The number of files follows the bytes where none is given. For plain and history tables, at a
    time without running jobs."""
    target = lake.path("silver", cfg.silver_table)
    current = versions.read_current(lake.spark, target, lake.fmt)
    history = scd.CURRENT if scd.CURRENT in current.columns else None
    count = file_count or files.file_count(current)
    versions.write_version(files.compact(current, keys, count), target, history, lake.fmt)
    return files.drop_partitions(lake.spark, versions.superseded(lake.spark, target))


def cluster_gold(lake: Lake, fact: str, keys: Sequence[str], target: str, file_bytes: int = files.FILE_BYTES) -> int:
    """A copy of a gold fact in Z-order of ``keys``, in directories ``zone=<n>`` of about ``file_bytes`` each, under
    ``target``; returns the number of zones."""
    df = read_gold(lake, fact)
    rows_per_zone = max(1, df.count() // files.file_count(df, file_bytes))
    files.overwrite_path(zorder.clustered(df, keys, rows_per_zone), target, lake.fmt, [zorder.ZONE])
    return len([n for n in files.child_names(lake.spark, target) if n.startswith(f"{zorder.ZONE}=")])


def publish(lake: Lake, name: str, table: str, partition_by: Sequence[str] = ()) -> None:
    """A gold table as a table of the session catalog: replaced as a whole, or, with partition columns, partition by
    partition."""
    df = read_gold(lake, name)
    if partition_by:
        tables.replace_rows(df, table, partition_by)
    else:
        tables.overwrite_rows(df, table)


def run_configured(lake: Lake, batch_id: str, config: DataFrame, extract: Callable[[TableConfig], DataFrame],
                   only: Sequence[str] = (), **options) -> list[dict]:
    """``run_batch`` over the records of a configuration. ``only`` names some of its tables; a name that it does not
    have is an error before anything is loaded."""
    records = {r.table_name: TableConfig.of(r) for r in config.collect()}       # one row per table
    unknown = sorted(set(only) - set(records))
    if unknown:
        raise ValueError(f"no configuration for tables {unknown}")
    chosen = [records[n] for n in (only or sorted(records))]
    return run_batch(lake, batch_id, [(c, extract(c)) for c in chosen if c.active_flag], **options)


def run_batch(lake: Lake, batch_id: str, tables: Sequence[tuple[TableConfig, DataFrame]],
              silver_options: Mapping[str, dict] | None = None,
              gold_options: Mapping | None = None,
              references: Mapping[str, Sequence[tuple[str, str]]] = gold.GATE_REFERENCES,
              not_null: Mapping[str, Sequence[str]] | None = None) -> list[dict]:
    """All active tables to silver, then gold, then the gate.

    A failing table is recorded and the others still load; gold and the gate run only when every table
    succeeded. The run log is appended once, also when the batch fails.
    """
    def load(item: tuple[TableConfig, DataFrame]) -> dict:
        cfg, source = item
        try:
            land(lake, cfg, batch_id, source)
            load_bronze(lake, cfg, batch_id)
            to_silver(lake, cfg, batch_id, **(silver_options or {}).get(cfg.table_name, {}))
        except Exception as error:  # noqa: BLE001  (logged by its step; the batch fails below)
            return {"table_name": cfg.table_name, "status": "FAILED", "error": str(error)}
        return {"table_name": cfg.table_name, "status": "SUCCESS"}

    try:
        results = lake.each(load, [t for t in tables if t[0].active_flag])
        failed = [r["table_name"] for r in results if r["status"] == "FAILED"]
        if failed:
            raise quality.DataQualityError(f"gold not built, tables failed: {failed}")
        build_gold(lake, batch_id, **(gold_options or {}))
        validate_gold(lake, batch_id, references, not_null=not_null)
    finally:
        lake.flush_log()
    return results
