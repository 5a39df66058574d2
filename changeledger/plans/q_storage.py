"""Queries: partitioned / bucketed / ordered / sized writes, compaction, orphans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import layout as lay
from ..operators import history as h
from ..schemas import RETENTION_DAYS, TARGET_FILE_BYTES
from ..session import work_path
from ..sources import testdata as td
from . import jobs
from . import oracle as O
from .q_changes import upserted
from .registry import register

DAYS_SQL = O.with_(O.EV, O.CDC_FLAT) + """
SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS rows,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount
FROM cdc_flat GROUP BY 1"""

DAY_MERCHANT_SQL = O.with_(O.EV, O.CDC_FLAT) + """
SELECT CAST(event_ts AS DATE) AS event_date, merchant_id, count(*) AS rows
FROM cdc_flat GROUP BY 1, 2"""


def _per_day(df):
    return df.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"),
                                        F.sum(F.col("amount").cast("decimal(18,2)"))
                                         .cast("double").alias("sum_amount"))


@register("table_create_days", DAYS_SQL)
def q_table_create_days(spark, sf_dir):
    path = work_path(spark, "merchant-events-days")
    lay.write_days(td.cdc_flat(spark, sf_dir), path)
    return _per_day(spark.read.parquet(path))


@register("table_create_days_bucket", DAY_MERCHANT_SQL)
def q_table_create_days_bucket(spark, sf_dir):
    path = work_path(spark, "merchant-events-bucketed")
    name = "merchant_events_" + path.rsplit("-", 1)[-1]
    lay.write_days_bucketed(td.cdc_flat(spark, sf_dir), path, name)
    return spark.table(name).groupBy("event_date", "merchant_id").agg(F.count(F.lit(1)).alias("rows"))


@register("write_distributed", DAY_MERCHANT_SQL)
def q_write_distributed(spark, sf_dir):
    path = work_path(spark, "merchant-events-dist")
    lay.write_distributed(td.cdc_flat(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("event_date", "merchant_id") \
                .agg(F.count(F.lit(1)).alias("rows"))


@register("write_replace", O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED)
          + "SELECT * FROM upserted")
def q_write_replace(spark, sf_dir):
    path = work_path(spark, "orders-replace")
    lay.write_replace(td.orders_src(spark, sf_dir).select(*td.ORDER_FIELDS), path)
    fresh = upserted(spark, sf_dir)
    staged = work_path(spark, "orders-replace-next")     # never read and overwrite one path
    lay.write_replace(fresh, staged)
    lay.write_replace(spark.read.parquet(staged), path)
    return spark.read.parquet(path)


@register("write_ordered", O.with_(O.EV, O.CDC_FLAT) + "SELECT seq, order_id, event_ts FROM cdc_flat")
def q_write_ordered(spark, sf_dir):
    path = work_path(spark, "merchant-events-ordered")
    lay.write_ordered(td.cdc_flat(spark, sf_dir), path)
    return spark.read.parquet(path).select("seq", "order_id", "event_ts")


@register("compact_files", O.with_(O.EV, O.CDC_FLAT) + """
SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS rows FROM cdc_flat GROUP BY 1""")
def q_compact_files(spark, sf_dir):
    """Many small files per day rewritten into few; content must not change."""
    path = work_path(spark, "merchant-events-small")
    lay.write_days(td.cdc_flat(spark, sf_dir), path, max_records=50)
    new = lay.compact_files(spark, path, work_path(spark, "merchant-events-compact"), "event_date",
                            TARGET_FILE_BYTES["payments.merchant_events"])
    return spark.read.parquet(new).groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))


@register("compaction_candidates")
def q_compaction_candidates(spark, sf_dir):
    path = work_path(spark, "merchant-events-small")
    lay.write_days(td.cdc_flat(spark, sf_dir), path, max_records=50)
    files = lay.file_stats(spark, path, "event_date")
    return lay.compaction_candidates(files, TARGET_FILE_BYTES["payments.merchant_events"], "event_date")


@register("file_sizing")
def q_file_sizing(spark, sf_dir):
    path = work_path(spark, "orders-sized")
    lay.write_sized(td.orders_src(spark, sf_dir), path, max_records=1000)
    files = lay.file_stats(spark, path)
    counts = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path")) \
                  .agg(F.count(F.lit(1)).alias("rows"))
    return files.join(counts, "path")


@register("orphan_files")
def q_orphan_files(spark, sf_dir):
    """Snapshot 1 files become orphans once snapshot 2 (compacted) is the live version."""
    root = work_path(spark, "orders-table")
    lay.write_sized(td.orders_src(spark, sf_dir), f"{root}/data/s1", max_records=2000)
    live = lay.compact_files(spark, f"{root}/data/s1", f"{root}/data", None,
                             TARGET_FILE_BYTES["payments.orders"])
    live_paths = spark.read.parquet(live).select(F.col("_metadata.file_path").alias("path"))
    listing = lay.file_stats(spark, f"{root}/data")
    return h.orphan_files(listing, live_paths)


@register("maintenance_run")
def q_maintenance_run(spark, sf_dir):
    log = td.cdc_flat(spark, sf_dir)
    path = work_path(spark, "merchant-events-maint")
    lay.write_days(log, path, max_records=100)
    return jobs.maintenance_run(
        spark, "payments.merchant_events", path, h.commits_by_day(log),
        work_path(spark, "merchant-events-maint-out"),
        TARGET_FILE_BYTES["payments.merchant_events"], RETENTION_DAYS["payments.merchant_events"],
        [("latest", "latest")], "2024-02-01 00:00:00", "event_date")


@register("file_sizing_facts", O.with_(O.ORDERS_SRC) + "SELECT count(*) AS total_rows, true AS within_limit FROM orders_src")
def q_file_sizing_facts(spark, sf_dir):
    """All rows are written, and no file holds more than the limit."""
    path = work_path(spark, "orders-sized-facts")
    lay.write_sized(td.orders_src(spark, sf_dir), path, max_records=1000)
    files = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("rows"))
    return files.agg(F.sum("rows").alias("total_rows"), (F.max("rows") <= 1000).alias("within_limit"))


@register("orphan_rows", O.with_(O.ORDERS_SRC) + "SELECT count(*) AS live_rows, count(*) AS orphan_rows FROM orders_src")
def q_orphan_rows(spark, sf_dir):
    """Rows in the files of the live version, and in those that the orphan report names (the version before)."""
    root = work_path(spark, "orders-table-rows")
    lay.write_sized(td.orders_src(spark, sf_dir), f"{root}/data/s1", max_records=2000)
    live = lay.compact_files(spark, f"{root}/data/s1", f"{root}/data", None, TARGET_FILE_BYTES["payments.orders"])
    live_paths = spark.read.parquet(live).select(F.col("_metadata.file_path").alias("path"))
    orphans = h.orphan_files(lay.file_stats(spark, f"{root}/data"), live_paths).select(h.plain_path(F.col("path")).alias("_plain"))
    every = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data") \
        .select(h.plain_path(F.col("_metadata.file_path")).alias("_plain")).groupBy("_plain").agg(F.count(F.lit(1)).alias("rows"))
    named = every.join(orphans.withColumn("_orphan", F.lit(True)), "_plain", "left")
    return named.agg(F.sum(F.when(F.col("_orphan").isNull(), F.col("rows"))).alias("live_rows"),
                     F.sum(F.when(F.col("_orphan"), F.col("rows"))).alias("orphan_rows"))


@register("compaction_flags", O.with_(O.EV, O.CDC_FLAT) + """
SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS rows FROM cdc_flat GROUP BY 1 HAVING count(*) > 50""")
def q_compaction_flags(spark, sf_dir):
    """Days of more rows than a file may hold have several small files, and all of them are flagged."""
    path = work_path(spark, "merchant-events-flags")
    lay.write_days(td.cdc_flat(spark, sf_dir), path, max_records=50)
    flagged = lay.compaction_candidates(lay.file_stats(spark, path, "event_date"),
                                        TARGET_FILE_BYTES["payments.merchant_events"], "event_date") \
        .where("compact").select(F.col("event_date").cast("date").alias("event_date"))
    rows = spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("rows")).where("rows > 50")
    return rows.join(flagged, "event_date")


@register("maintenance_facts", O.with_(O.EV, O.CDC_FLAT) + f"""
SELECT 1 AS tags, count(*) FILTER (WHERE day + 1 < TIMESTAMP '2024-02-01 00:00:00'
                                   - INTERVAL {RETENTION_DAYS["payments.merchant_events"]} DAY AND day < newest) AS expired,
       true AS no_more_files
FROM (SELECT DISTINCT CAST(event_ts AS DATE) AS day, max(CAST(event_ts AS DATE)) OVER () AS newest FROM cdc_flat)""")
def q_maintenance_facts(spark, sf_dir):
    """What a maintenance run reports: tags, expired snapshots, and no more files than before."""
    report = q_maintenance_run(spark, sf_dir)

    def value(step):
        return F.max(F.when(F.col("step") == step, F.col("value")))

    return report.agg(value("tags").cast("int").alias("tags"), value("expired_snapshots").alias("expired"),
                      (value("compact_files_after") <= value("compact_files_before")).alias("no_more_files"))
