"""End-to-end jobs: batch ingest, write-audit-publish, back-fill, maintenance.

Each job is a plain function over DataFrames and paths; every heavy step is a
Spark plan.  Driver-side work is limited to deciding (a gate result, a
snapshot id) from one-row aggregates.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cdc import normalize_event_ts, stamp_ingestion
from ..functions.flatten import flatten
from ..functions.rest import rest_pack
from ..operators import history as h
from ..operators import layout as lay
from ..operators import quality as qc
from ..operators.merge import latest_per_key, snapshot_upsert
from ..schemas import ORDER_COLUMNS
from ..session import cut_lineage
from ..sources.daytable import DayTable
from ..sources.raw import raw_scan

ABSENT_TYPES = {"amount": "double", "event_ts": "timestamp_ntz"}


def prepare_snapshot(raw: DataFrame, run_ts: str | None = None,
                     file_tiebreak: bool = True) -> tuple[DataFrame, DataFrame]:
    """Landed documents → typed order rows + rows with unusable timestamps.

    flatten (O16) → event_ts text to timestamp (O20) → ingestion stamp (O19) →
    one row per key (O26; newest event_ts, then landed file) → `_rest` (O17).
    """
    df = raw.drop("dt")
    if file_tiebreak:  # landed file path breaks event_ts ties (later file wins)
        df = df.withColumn("_src_path", F.col("_metadata.file_path"))
    flat = normalize_event_ts(flatten(df))
    bad = flat.where(F.col("_bad_event_ts").isNotNull()) if "_bad_event_ts" in flat.columns \
        else flat.limit(0)
    good = flat.where(F.col("_bad_event_ts").isNull()).drop("_bad_event_ts") \
        if "_bad_event_ts" in flat.columns else flat
    good = stamp_ingestion(good, run_ts)
    order = ["event_ts", "_src_path"] if "_src_path" in good.columns else ["event_ts"]
    good = latest_per_key(good, "order_id", order).drop("_src_path")
    for c in ORDER_COLUMNS:             # a field that no document of the day has
        if c not in good.columns:
            good = good.withColumn(c, F.lit(None).cast(ABSENT_TYPES.get(c, "string")))
    return rest_pack(good, ORDER_COLUMNS).select(*ORDER_COLUMNS, "_rest"), bad


def ingest_batch(spark: SparkSession, raw_root: str, target: DataFrame,
                 date: str | None = None, run_ts: str | None = None,
                 dead_letters: str | None = None) -> DataFrame:
    """Daily snapshot ingest (O61): raw JSON of one day (or all) merged into ``target``.

    Documents without a readable time are not merged; they are written to ``dead_letters``
    when a path is given (a rerun replaces them).
    """
    raw = raw_scan(spark, raw_root, date)
    source, bad = prepare_snapshot(raw, run_ts)
    if dead_letters:
        bad.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(dead_letters)
    return snapshot_upsert(target, source, "order_id", order_by=None)


def ingest_day(spark: SparkSession, raw_root: str, table: DayTable, date: str, run_ts: str | None = None,
               dead_letters: str | None = None, max_null_rate: float = 0.05) -> int:
    """One landed day into the stored table (O61, O64, O04): the new version's number.

    A day that wasn't landed raises ``MissingDay``.  The merged days are staged, checked (repeated keys, null rates of key, time
    and status) and published by the table's pointer, so readers see all of the day or nothing, and a repeated run leaves the
    same table.  Documents without a readable time go to ``dead_letters``, which a repeated run replaces.
    """
    source, bad = prepare_snapshot(raw_scan(spark, raw_root, date, must_exist=True), run_ts)
    if dead_letters:
        bad.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{dead_letters.rstrip('/')}/dt={date}")

    def gate(before: DataFrame, staged: DataFrame) -> DataFrame:
        return qc.quality_report(before, staged, [table.key], [table.key, table.ts, "status"], max_change=float("inf"), max_null_rate=max_null_rate, materialize=False)

    return table.upsert(source, check=gate)


def backfill_days(spark: SparkSession, raw_root: str, table: DayTable, start: str, end: str, columns: list[str], branch: str | None = None) -> int | None:
    """Re-ingest the raw days [start, end) on a branch of the table and merge it (O65): main's new version, or None when a conflict blocks it.

    A row takes main's place unless main's is newer.  What main gained meanwhile is merged with the branch by key and column.
    """
    branch = branch or f"backfill/{start}-{uuid.uuid4().hex[:8]}"
    raw = raw_scan(spark, raw_root, dates=(start, end)).drop("dt")
    flat = normalize_event_ts(flatten(raw.withColumn("_src_path", F.col("_metadata.file_path"))))
    if "_bad_event_ts" in flat.columns:
        flat = flat.where(F.col("_bad_event_ts").isNull())
    new = latest_per_key(flat.where(F.col(table.key).isNotNull()), table.key, [table.ts, "_src_path"]).select(*columns)
    table.branch(branch)
    held = table.read(branch=branch).groupBy(table.key).agg(F.max(table.ts).alias("_held"))
    fresh = new.join(held, table.key, "left").where(F.col("_held").isNull() | (F.col(table.ts) >= F.col("_held"))).drop("_held")
    table.upsert(fresh, branch)
    return table.merge(branch)


def write_audit_publish(staged: DataFrame, previous: DataFrame, main_path: str,
                        key: list[str], attributes: list[str], mode: str = "overwrite",
                        partition_by: str | None = None, **thresholds) -> tuple[bool, DataFrame]:
    """Stage → check → publish only if every check passed.

    ``staged`` is normally read from a staging path, so readers of
    ``main_path`` never see it before the gate opens.  Returns the decision
    and the report.
    """
    report = qc.quality_report(previous, staged, key, attributes, materialize=False, **thresholds)
    report = report.cache()
    ok = qc.all_passed(report)
    if ok:
        w = staged.write.mode(mode)
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(main_path)
    return ok, report.withColumn("published", F.lit(ok))


def backfill(spark: SparkSession, raw_root: str, main_path: str, staging_path: str,
             start: str, end: str, columns: list[str]) -> bool:
    """Re-ingest the raw days [start, end) into staging, audit, then replace the
    affected ``event_date`` partitions of main (O65).

    Landing day and event day differ, and a row may move between days, so each
    affected day is rebuilt whole: the new rows (one per key, the newest landed
    one, unless main has a newer one) and main's rows of those days under other keys.  A
    day is affected when it gets a row or loses one.  Rows without a readable time
    go to ``dead_letters`` below the run's staging folder, which is new each time.
    """
    run = f"{staging_path.rstrip('/')}/run-{uuid.uuid4().hex[:12]}"
    raw = raw_scan(spark, raw_root, dates=(start, end)).drop("dt")
    flat = normalize_event_ts(flatten(raw.withColumn("_src_path", F.col("_metadata.file_path"))))
    if "_bad_event_ts" in flat.columns:
        flat.where(F.col("_bad_event_ts").isNotNull()).write.parquet(f"{run}/dead_letters")
        flat = flat.where(F.col("_bad_event_ts").isNull())
    new = latest_per_key(flat.where(F.col("order_id").isNotNull()), "order_id", ["event_ts", "_src_path"]).select(*columns)
    main = spark.read.parquet(main_path)
    held = main.join(new.select("order_id"), "order_id", "left_semi")
    newest = held.groupBy("order_id").agg(F.max("event_ts").alias("_held_ts"))
    new = cut_lineage(new.join(newest, "order_id", "left")
                      .where(F.col("_held_ts").isNull() | (F.col("event_ts") >= F.col("_held_ts"))).drop("_held_ts"), "backfill-new")
    keys = new.select("order_id")
    days = cut_lineage(new.select(F.to_date("event_ts").alias("event_date"))
                       .unionByName(main.join(keys, "order_id", "left_semi").select("event_date")).distinct(), "backfill-days")
    day = days.select(F.col("event_date").alias("_day"))
    before = main.join(day, main["event_date"].eqNullSafe(day["_day"]), "left_semi")
    rows = before.join(keys, "order_id", "left_anti").drop("event_date").unionByName(new, allowMissingColumns=True)
    lay.write_days(rows, f"{run}/rows")
    staged = spark.read.schema(main.schema).parquet(f"{run}/rows")
    # Days may gain any number of rows but lose none; keys are unique and have a time.
    report = qc.quality_report(before, staged, ["order_id"], ["order_id", "event_ts"],
                               max_change=float("inf"), max_null_rate=0.0, materialize=False)
    if not qc.all_passed(report) or staged.count() < before.count():
        return False
    # dynamic overwrite: only the staged days are replaced in main
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("event_date").parquet(main_path))
    # A day that lost its last row has nothing to be replaced by: its folder goes (at most a few thousand days).
    emptied = days.join(staged.select("event_date").distinct(), "event_date", "left_anti").where(F.col("event_date").isNotNull()).collect()
    for r in emptied:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{main_path}/event_date={r['event_date']}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return True


def maintenance_run(spark: SparkSession, table: str, data_path: str, commits: DataFrame,
                    out_root: str, target_bytes: int, retention_days: int,
                    tag_policy: list[tuple[str, str]], now: str,
                    partition_col: str | None = None) -> DataFrame:
    """Per table: compact files → tag snapshots → expire (tag before expire).

    Returns one report row per step.
    """
    files_before = lay.file_stats(spark, data_path).count()
    new_path = lay.compact_files(spark, data_path, out_root, partition_col, target_bytes)
    files_after = lay.file_stats(spark, new_path).count()
    tags = h.tag_snapshots(spark, commits, tag_policy)
    t = commits.withColumn("table_name", F.lit(table))
    retention = spark.createDataFrame([(table, retention_days)], "table_name string, retention_days int")
    expired = h.expire_snapshots(t, retention,
                                 tags.select(F.lit(table).alias("table_name"), "snapshot_id"), now)
    n_tags, n_expired = tags.count(), expired.count()
    return spark.createDataFrame(
        [(table, "compact_files_before", files_before), (table, "compact_files_after", files_after),
         (table, "tags", n_tags), (table, "expired_snapshots", n_expired)],
        "table_name string, step string, value long")
