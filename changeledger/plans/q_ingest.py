"""Queries: raw landing and scanning, flattening, `_rest`, parsing, batch ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cdc
from ..functions.flatten import flatten
from ..functions.rest import rest_entries, rest_pack, rest_value
from ..operators import layout as lay
from ..operators import merge as mg
from ..schemas import ORDER_COLUMNS
from ..session import listing_parallelism, work_path
from ..sources import paged
from ..sources import raw as rw
from ..sources import testdata as td
from ..sources.daytable import DayTable
from . import jobs
from . import oracle as O
from .registry import register

RUN_TS = "2024-02-01 00:00:00"
MARK = "2024-01-25 00:00:00"
SCAN_DATE = "1998-08-02"
ISO = "strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f')"

NESTED_FLAT_SQL = """SELECT order_id, merchant_id, status, amount, currency, event_ts, o_orderkey, o_orderpriority,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS billing_address_city,
       CASE WHEN o_orderkey % 3 <> 0 THEN status END AS billing_card_brand,
       CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS n_items
FROM orders_src"""

REST_SQL = """rest AS (
  SELECT order_id, 'o_orderkey' AS key, CAST(o_orderkey AS VARCHAR) AS value FROM orders_src
  WHERE o_orderkey IS NOT NULL
  UNION ALL SELECT order_id, 'o_orderpriority', o_orderpriority FROM orders_src WHERE o_orderpriority IS NOT NULL
  UNION ALL SELECT order_id, 'billing_address_city', o_orderpriority FROM orders_src
  WHERE o_orderkey % 3 <> 0 AND o_orderpriority IS NOT NULL
  UNION ALL SELECT order_id, 'billing_card_brand', status FROM orders_src WHERE o_orderkey % 3 <> 0
  UNION ALL SELECT order_id, 'items', CAST(to_json([{'sku': 'sku-' || CAST(o_orderkey % 50 AS VARCHAR),
                                                     'quantity': CAST(o_orderkey % 5 + 1 AS INTEGER)}]) AS VARCHAR)
  FROM orders_src WHERE o_orderkey % 2 = 0)"""


def _packed(spark, sf_dir):
    return rest_pack(flatten(td.nested_docs(spark, sf_dir)), ORDER_COLUMNS)


@register("flatten_structs", O.with_(O.ORDERS_SRC) + NESTED_FLAT_SQL)
def q_flatten_structs(spark, sf_dir):
    flat = flatten(td.nested_docs(spark, sf_dir))
    return flat.withColumn("n_items", F.when(F.col("items").isNotNull(), F.size("items"))).drop("items")


@register("rest_pack", O.with_(O.ORDERS_SRC, REST_SQL) + "SELECT * FROM rest")
def q_rest_pack(spark, sf_dir):
    return rest_entries(_packed(spark, sf_dir), "order_id")


@register("rest_unpack", O.with_(O.ORDERS_SRC) + """
SELECT order_id, CASE WHEN o_orderkey % 3 <> 0 THEN status END AS card_brand,
       CAST(NULL AS VARCHAR) AS coupon FROM orders_src""")
def q_rest_unpack(spark, sf_dir):
    return _packed(spark, sf_dir).select(
        "order_id", rest_value("billing_card_brand").alias("card_brand"),
        rest_value("marketing_coupon").alias("coupon"))


@register("stamp_ingestion", O.with_(O.ORDERS_SRC)
          + f"SELECT order_id, TIMESTAMP '{RUN_TS}' AS ingestion_ts FROM orders_src")
def q_stamp_ingestion(spark, sf_dir):
    return cdc.stamp_ingestion(td.orders_src(spark, sf_dir), RUN_TS).select("order_id", "ingestion_ts")


@register("normalize_event_ts", O.with_(O.EV) + """
SELECT event_id AS seq, CASE WHEN k = 71 THEN NULL ELSE ts END AS event_ts,
       CASE WHEN k = 71 THEN 'not-a-time' END AS bad_event_ts FROM ev""")
def q_normalize_event_ts(spark, sf_dir):
    e = td.read_table(spark, sf_dir, "events")
    text = e.select(F.col("event_id").alias("seq"),
                    F.when(td.prop_k() == 71, F.lit("not-a-time"))
                     .otherwise(td.iso(F.col("ts"))).alias("event_ts"))
    return cdc.normalize_event_ts(text).withColumnRenamed("_bad_event_ts", "bad_event_ts")


@register("parse_envelope", O.with_(O.EV, O.CDC_FLAT) + f"""
SELECT seq, op AS operationType, CASE WHEN op <> 'delete' THEN order_id END AS doc_order_id,
       order_id AS key_id, {ISO} AS clusterTime FROM cdc_flat""")
def q_parse_envelope(spark, sf_dir):
    env = cdc.parse_envelope(td.envelopes(spark, sf_dir).select("seq", "value"))
    return env.select("seq", "operationType",
                      F.col("fullDocument.order_id").alias("doc_order_id"),
                      F.col("documentKey._id").alias("key_id"), "clusterTime")


@register("cdc_project", O.with_(O.EV, O.CDC_FLAT) + """
SELECT seq, order_id, op,
       CASE WHEN op <> 'delete' THEN merchant_id END AS merchant_id,
       CASE WHEN op <> 'delete' THEN status END AS status,
       CASE WHEN op <> 'delete' THEN amount END AS amount,
       CASE WHEN op <> 'delete' THEN currency END AS currency,
       event_ts FROM cdc_flat""")
def q_cdc_project(spark, sf_dir):
    env = td.envelopes(spark, sf_dir).select("seq", "value")
    return cdc.good_changes(cdc.cdc_project(cdc.parse_envelope(env)))


@register("cdc_source_fulldoc", O.with_(O.EV, O.CDC_FLAT) + """
SELECT f.seq, f.order_id, 'update' AS op, f.merchant_id, f.status, f.amount, f.currency,
       CASE WHEN ev.k % 3 <> 0 THEN f.event_ts END AS event_ts
FROM cdc_flat f JOIN ev ON f.seq = ev.event_id WHERE f.op <> 'delete'""")
def q_cdc_source_fulldoc(spark, sf_dir):
    docs = cdc.parse_full_documents(td.full_documents(spark, sf_dir))
    return cdc.good_changes(cdc.cdc_project(docs))


@register("dead_letter", O.with_(O.EV) + """
SELECT event_id AS seq,
       CASE WHEN k = 13 THEN 'malformed' WHEN k = 42 THEN 'null_operation'
            WHEN k = 57 THEN 'unknown_operation' ELSE 'bad_timestamp' END AS reason
FROM ev WHERE k IN (13, 42, 57) OR (k = 71 AND event_type <> 'error')""")
def q_dead_letter(spark, sf_dir):
    env = td.envelopes(spark, sf_dir, corrupt=True).select("seq", "value")
    projected = cdc.cdc_project(cdc.parse_envelope(env))
    return cdc.dead_letters(projected).select("seq", "reason")


@register("topic_route", """
SELECT concat_ws('.', 'payments', 'cdc', event_type) AS topic, count(*) AS events
FROM events GROUP BY 1""")
def q_topic_route(spark, sf_dir):
    e = td.read_table(spark, sf_dir, "events")
    return e.groupBy(cdc.topic_for("payments", F.col("event_type")).alias("topic")) \
            .agg(F.count(F.lit(1)).alias("events"))


@register("incremental_extract", O.with_(O.EV, O.CDC_FLAT)
          + f"SELECT * FROM cdc_flat WHERE event_ts > TIMESTAMP '{MARK}'")
def q_incremental_extract(spark, sf_dir):
    return rw.incremental_extract(td.cdc_flat(spark, sf_dir), MARK)


@register("high_water_mark", O.with_(O.EV, O.CDC_FLAT) + f"""
SELECT coalesce(max(event_ts), TIMESTAMP '{MARK}') AS mark FROM cdc_flat WHERE event_ts > TIMESTAMP '{MARK}'""")
def q_high_water_mark(spark, sf_dir):
    return rw.high_water_mark(rw.incremental_extract(td.cdc_flat(spark, sf_dir), MARK), MARK)


@register("provenance_columns", """
SELECT 'events.parquet' AS source_file, 'changeledger-ingest' AS job_name, 'run-0001' AS run_id,
       count(*) AS rows FROM events""")
def q_provenance_columns(spark, sf_dir):
    e = rw.with_provenance(td.read_table(spark, sf_dir, "events"), "changeledger-ingest", "run-0001")
    return e.groupBy("source_file", "job_name", "run_id").agg(F.count(F.lit(1)).alias("rows"))


@register("seed_orders", """
SELECT 'seed-' || CAST(c_custkey AS VARCHAR) AS order_id,
       'm-' || CAST(c_custkey % 5 AS VARCHAR) AS merchant_id,
       (['created', 'approved', 'refunded'])[CAST(c_custkey % 3 + 1 AS INTEGER)] AS status,
       CAST(10.0 AS DOUBLE) + CAST((c_custkey * 37) % 49001 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS amount,
       'USD' AS currency,
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(c_custkey % 1440 AS BIGINT)) AS event_ts
FROM customer""")
def q_seed_orders(spark, sf_dir):
    return rw.seed_orders(td.read_table(spark, sf_dir, "customer"))


# ------------------------------------------------------------- raw landing
@register("raw_land", "SELECT CAST(o_orderdate AS DATE) AS dt, count(*) AS docs FROM orders GROUP BY 1")
def q_raw_land(spark, sf_dir):
    root = work_path(spark, "raw-orders")
    rw.raw_land(td.nested_docs(spark, sf_dir), root)
    with listing_parallelism(spark):
        landed = spark.read.schema("order_id string").json(root)
    return landed.groupBy("dt").agg(F.count(F.lit(1)).alias("docs"))


@register("raw_scan", O.with_(O.ORDERS_SRC) + f"""
SELECT order_id, status, amount, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS billing_city
FROM orders_src WHERE CAST(event_ts AS DATE) = DATE '{SCAN_DATE}'""")
def q_raw_scan(spark, sf_dir):
    root = work_path(spark, "raw-orders")
    rw.raw_land(td.nested_docs(spark, sf_dir), root)
    day = rw.raw_scan(spark, root, SCAN_DATE)
    return day.select("order_id", "status", "amount", F.col("billing.address.city").alias("billing_city"))


INGEST_SQL = O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST) + f"""
SELECT coalesce(s.order_id, t.order_id) AS order_id,
       coalesce(s.merchant_id, t.merchant_id) AS merchant_id,
       CASE WHEN s.order_id IS NOT NULL THEN s.status ELSE t.status END AS status,
       CASE WHEN s.order_id IS NOT NULL THEN s.amount ELSE t.amount END AS amount,
       CASE WHEN s.order_id IS NOT NULL THEN s.currency ELSE t.currency END AS currency,
       CASE WHEN s.order_id IS NOT NULL THEN s.event_ts ELSE t.event_ts END AS event_ts,
       CASE WHEN s.order_id IS NOT NULL THEN TIMESTAMP '{RUN_TS}'
            ELSE TIMESTAMP '2001-08-01 00:00:00' END AS ingestion_ts,
       CASE WHEN s.order_id IS NOT NULL THEN 1 ELSE 0 END AS n_rest,
       s.src_file AS rest_src_file
FROM orders_src t FULL OUTER JOIN delta_latest s ON t.order_id = s.order_id"""


@register("ingest_batch", INGEST_SQL)
def q_ingest_batch(spark, sf_dir):
    """Yesterday's table + today's landed snapshot documents (with duplicates) → table."""
    root = work_path(spark, "raw-delta")
    rw.raw_land(td.orders_delta(spark, sf_dir), root)
    target = td.orders_src(spark, sf_dir).select(*td.ORDER_FIELDS) \
        .withColumn("ingestion_ts", F.lit("2001-08-01 00:00:00").cast("timestamp_ntz"))
    target = rest_pack(target, ORDER_COLUMNS)
    out = jobs.ingest_batch(spark, root, target, run_ts=RUN_TS)
    return out.select(*ORDER_COLUMNS, F.size("_rest").alias("n_rest"),
                      rest_value("src_file").alias("rest_src_file"))


RUN_DATE = "2001-08-02"


@register("ingest_day", INGEST_SQL)
def q_ingest_day(spark, sf_dir):
    """The landed snapshot of a run date into the stored table, twice; a date that wasn't landed fails."""
    root = work_path(spark, "raw-run")
    rw.raw_land_run(td.orders_delta(spark, sf_dir), root, RUN_DATE)
    target = td.orders_src(spark, sf_dir).select(*td.ORDER_FIELDS) \
        .withColumn("ingestion_ts", F.lit("2001-08-01 00:00:00").cast("timestamp_ntz"))
    table = DayTable(spark, work_path(spark, "ingested-orders"), unit="month")
    table.create(rest_pack(target, ORDER_COLUMNS).select(*ORDER_COLUMNS, "_rest"))
    try:
        jobs.ingest_day(spark, root, table, "2001-08-03", RUN_TS)
        raise AssertionError("a missing day was ingested")
    except rw.MissingDay:
        pass
    for _ in range(2):
        jobs.ingest_day(spark, root, table, RUN_DATE, RUN_TS)
    return table.read().select(*ORDER_COLUMNS, F.size("_rest").alias("n_rest"), rest_value("src_file").alias("rest_src_file"))


BACKFILL = ("1996-01-01", "1996-02-01")


@register("backfill_branch", O.with_(O.ORDERS_SRC)
          + "SELECT order_id, merchant_id, status, amount, currency, event_ts FROM orders_src")
def q_backfill_branch(spark, sf_dir):
    """Main misses January 1996; those days are re-ingested from raw on the side and published."""
    raw_root, main = work_path(spark, "raw-orders"), work_path(spark, "main-orders")
    rw.raw_land(td.nested_docs(spark, sf_dir), raw_root)
    full = td.orders_src(spark, sf_dir).select(*td.ORDER_FIELDS)
    lo, hi = (F.lit(b).cast("timestamp_ntz") for b in BACKFILL)
    gap = full.where(~((F.col("event_ts") >= lo) & (F.col("event_ts") < hi)))
    lay.write_days(gap, main)
    ok = jobs.backfill(spark, raw_root, main, work_path(spark, "staging-orders"),
                       BACKFILL[0], BACKFILL[1], td.ORDER_FIELDS)
    if not ok:
        raise RuntimeError("backfill blocked by quality checks")
    with listing_parallelism(spark):
        return spark.read.parquet(main).select(*td.ORDER_FIELDS)


@register("backfill_days", O.with_(O.ORDERS_SRC)
          + "SELECT order_id, merchant_id, status, amount, currency, event_ts FROM orders_src")
def q_backfill_days(spark, sf_dir):
    """The stored table misses January 1996; a branch gets those days from raw and is merged into main."""
    raw_root = work_path(spark, "raw-orders")
    rw.raw_land(td.nested_docs(spark, sf_dir), raw_root)
    full = td.orders_src(spark, sf_dir).select(*td.ORDER_FIELDS)
    lo, hi = (F.lit(b).cast("timestamp_ntz") for b in BACKFILL)
    table = DayTable(spark, work_path(spark, "backfilled-orders"), unit="month")
    table.create(full.where(~((F.col("event_ts") >= lo) & (F.col("event_ts") < hi))))
    if jobs.backfill_days(spark, raw_root, table, *BACKFILL, td.ORDER_FIELDS) is None:
        raise RuntimeError("backfill blocked by conflicts")
    return table.read().select(*td.ORDER_FIELDS)


WAP_SQL = O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED).rstrip() + """,
checks AS (
  SELECT 'row_count_delta' AS check_name,
         CAST(abs((SELECT count(*) FROM upserted) - (SELECT count(*) FROM orders_src)) AS DOUBLE)
           / (SELECT count(*) FROM orders_src) AS value, CAST(0.5 AS DOUBLE) AS threshold
  UNION ALL SELECT 'null_rate:order_id', avg(CASE WHEN order_id IS NULL THEN 1.0 ELSE 0.0 END), 0.05 FROM upserted
  UNION ALL SELECT 'null_rate:merchant_id', avg(CASE WHEN merchant_id IS NULL THEN 1.0 ELSE 0.0 END), 0.05 FROM upserted
  UNION ALL SELECT 'null_rate:event_ts', avg(CASE WHEN event_ts IS NULL THEN 1.0 ELSE 0.0 END), 0.05 FROM upserted
  UNION ALL SELECT 'duplicate_keys', CAST(count(*) AS DOUBLE), 0.0 FROM (
    SELECT order_id FROM upserted GROUP BY order_id HAVING count(*) > 1))
SELECT check_name, value, threshold, value <= threshold AS passed,
       bool_and(value <= threshold) OVER () AS published FROM checks"""


@register("write_audit_publish", WAP_SQL)
def q_write_audit_publish(spark, sf_dir):
    """Upserted snapshot staged, checked against yesterday's table, published when green."""
    previous = td.orders_src(spark, sf_dir).select(*td.ORDER_FIELDS)
    staging, main = work_path(spark, "staging"), work_path(spark, "main")
    mg.snapshot_upsert(previous, td.orders_delta(spark, sf_dir), "order_id",
                       ["event_ts", "src_file"]).write.mode("overwrite").parquet(staging)
    staged = spark.read.parquet(staging)
    _, report = jobs.write_audit_publish(staged, previous, main, ["order_id"],
                                         ["order_id", "merchant_id", "event_ts"])
    return report


_CUSTOMER = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]


@register("paged_extract", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal, row_number() OVER () - 1 AS document_no FROM customer")
def q_paged_extract(spark, sf_dir):
    """A collection read by its pages, each document with its place."""
    reader = spark.read.format(paged.register(spark)).option("pageSize", 100).option("pagesPerTask", 3)
    return reader.load(f"{sf_dir}/customer.parquet").select(*_CUSTOMER, "document_no")


@register("paged_stream_resume", "SELECT o_orderkey, o_custkey, o_totalprice, 1 AS times FROM orders")
def q_paged_stream_resume(spark, sf_dir):
    """A stream of pages that stops, resumes by its token when more was landed, and reads each document once."""
    src, out, ckpt = (work_path(spark, n) for n in ("paged-in", "paged-out", "paged-ckpt"))
    orders = td.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    name = paged.register(spark)
    for part in range(2):
        some = orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == part)
        some.repartition(3, "o_orderkey").write.parquet(f"{src}/landed={part}")
        q = (spark.readStream.format(name).option("path", src).option("pageSize", 500).load()
             .writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return spark.read.parquet(out).groupBy("o_orderkey", "o_custkey", "o_totalprice").agg(F.count(F.lit(1)).cast("int").alias("times"))
