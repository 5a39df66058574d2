"""Queries: change-log replay, merges, erasure, tombstones, late events, aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cdc import good_changes
from ..operators import aggregates as agg
from ..operators import changes as ch
from ..operators import merge as mg
from ..session import cut_lineage
from ..sources import testdata as td
from ..streaming.cdc_stream import project_records
from . import oracle as O
from .registry import register

CUT = "2024-01-20 00:00:00"
DELTA_ORDER = ["event_ts", "src_file"]


def upserted(spark, sf_dir):
    target = td.orders_src(spark, sf_dir).select(*td.ORDER_FIELDS)
    return mg.snapshot_upsert(target, td.orders_delta(spark, sf_dir), "order_id", DELTA_ORDER)


@register("cdc_replay", O.with_(O.EV, O.CDC_FLAT, O.replay("cdc_flat", "st"))
          + "SELECT * FROM st")
def q_cdc_replay(spark, sf_dir):
    return ch.replay(td.cdc_flat(spark, sf_dir))


@register("cdc_merge", O.with_(O.EV, O.CDC_FLAT, O.replay("cdc_flat", "st"))
          + "SELECT * FROM st")
def q_cdc_merge(spark, sf_dir):
    """State before the cut, then the rest of the log applied as one batch."""
    log = td.cdc_flat(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp_ntz")
    state = ch.replay(log.where(F.col("event_ts") < cut))
    return ch.cdc_merge(state, log.where(F.col("event_ts") >= cut))


@register("compact_log", O.with_(O.EV, O.CDC_FLAT, O.replay("cdc_flat", "st"))
          + "SELECT * FROM st")
def q_compact_log(spark, sf_dir):
    """Base folded up to the last seq before the cut; the tail merged onto it (merge-on-read)
    equals the full replay."""
    log = td.cdc_flat(spark, sf_dir)
    s = log.where(F.col("event_ts") < F.lit(CUT).cast("timestamp_ntz")).agg(F.max("seq")).first()[0]
    base = ch.compact_log(log, s)
    base_state = base.drop("seq", "op")
    return ch.cdc_merge(base_state, log.where(F.col("seq") > s))


@register("compact_log_base", O.with_(
    O.EV, O.CDC_FLAT,
    f"pre AS (SELECT * FROM cdc_flat WHERE event_ts < TIMESTAMP '{CUT}')",
    O.replay("pre", "st")) + f"""
SELECT (SELECT max(seq) FROM pre) AS seq, order_id, 'update' AS op, merchant_id, status, amount,
       currency, event_ts FROM st""")
def q_compact_log_base(spark, sf_dir):
    log = td.cdc_flat(spark, sf_dir)
    s = log.where(F.col("event_ts") < F.lit(CUT).cast("timestamp_ntz")).agg(F.max("seq")).first()[0]
    return ch.compact_log(log, s)


@register("stream_tombstones", O.with_(O.EV, O.CDC_FLAT) + """
SELECT order_id, deleted_seq FROM (
  SELECT order_id, max(CASE WHEN op = 'delete' THEN seq END) AS deleted_seq,
         max(CASE WHEN op IN ('insert', 'update', 'replace') THEN seq END) AS last_up
  FROM cdc_flat GROUP BY order_id)
WHERE deleted_seq IS NOT NULL AND (last_up IS NULL OR last_up < deleted_seq)""")
def q_stream_tombstones(spark, sf_dir):
    return ch.tombstones(td.cdc_flat(spark, sf_dir))


ERASE_SQL = """erase AS (SELECT 'ord-' || CAST(c_custkey AS VARCHAR) AS order_id
  FROM customer WHERE c_mktsegment = 'MACHINERY'),
kept AS (SELECT * FROM cdc_flat WHERE order_id NOT IN (SELECT order_id FROM erase))"""


@register("erase_keys", O.with_(O.EV, O.CDC_FLAT, ERASE_SQL, O.replay("kept", "st"))
          + "SELECT * FROM st")
def q_erase_keys(spark, sf_dir):
    """Erasure list from the customer table, applied to the log, then replayed."""
    c = td.read_table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "MACHINERY")
    erase = c.select(F.concat(F.lit("ord-"), F.col("c_custkey").cast("string")).alias("order_id"))
    return ch.replay(ch.erase_keys(td.cdc_flat(spark, sf_dir), erase))


# arrival = event time + (k mod 10) hours; a compaction at CUT folds what arrived before it
LATE_SQL = f"""arr AS (
  SELECT f.*, ev.ts + to_hours(CAST(ev.k % 10 AS BIGINT)) AS arrival
  FROM cdc_flat f JOIN ev ON f.seq = ev.event_id),
base_seq AS (SELECT max(seq) AS s FROM arr WHERE arrival < TIMESTAMP '{CUT}')"""


def _arrivals(spark, sf_dir):
    log = td.cdc_flat_k(spark, sf_dir)
    return log.withColumn(
        "arrival", F.col("event_ts") + F.make_dt_interval(F.lit(0), (F.col("k") % 10).cast("int"))
    ).drop("k")


@register("cdc_late_events", O.with_(O.EV, O.CDC_FLAT, LATE_SQL) + f"""
SELECT seq, order_id, op FROM arr
WHERE arrival >= TIMESTAMP '{CUT}' AND seq <= (SELECT s FROM base_seq)""")
def q_cdc_late_events(spark, sf_dir):
    arr = _arrivals(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp_ntz")
    s = arr.where(F.col("arrival") < cut).agg(F.max("seq")).first()[0]
    tail = arr.where(F.col("arrival") >= cut)
    return ch.late_events(tail, s).select("seq", "order_id", "op")


# the records of a key lie in four partitions, whose offsets run against the clock
COMPOSITE_SQL = """placed AS (SELECT * REPLACE (row_number() OVER (ORDER BY event_ts, seq % 4, 1000000000 - seq) AS seq) FROM cdc_flat)"""


@register("cdc_composite_order", O.with_(O.EV, O.CDC_FLAT, COMPOSITE_SQL, O.replay("placed", "st")) + "SELECT * FROM st")
def q_cdc_composite_order(spark, sf_dir):
    """Events of a key from several partitions fold by clock, partition and offset."""
    env = td.envelopes(spark, sf_dir)
    records = env.select(F.col("order_id").alias("key"), "value", (F.col("seq") % 4).cast("int").alias("partition"), (1_000_000_000 - F.col("seq")).alias("offset"))
    return ch.replay(good_changes(project_records(records, order="cluster")))


@register("latest_per_key", O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST)
          + "SELECT * FROM delta_latest")
def q_latest_per_key(spark, sf_dir):
    return mg.latest_per_key(td.orders_delta(spark, sf_dir), "order_id", DELTA_ORDER)


@register("snapshot_upsert", O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED)
          + "SELECT * FROM upserted")
def q_snapshot_upsert(spark, sf_dir):
    return upserted(spark, sf_dir)


@register("merchant_totals", O.with_(O.ORDERS_SRC) + """
SELECT merchant_id, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount,
       count(*) AS order_count
FROM orders_src GROUP BY merchant_id""")
def q_merchant_totals(spark, sf_dir):
    return agg.merchant_totals(td.orders_src(spark, sf_dir))


@register("merchant_totals_refresh", O.with_(
    O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED) + """
SELECT merchant_id, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount,
       count(*) AS order_count
FROM upserted GROUP BY merchant_id""")
def q_merchant_totals_refresh(spark, sf_dir):
    """Stored totals of yesterday's table refreshed for merchants the delta touched."""
    before = td.orders_src(spark, sf_dir).select(*td.ORDER_FIELDS)
    delta = td.orders_delta(spark, sf_dir)
    stored = cut_lineage(agg.merchant_totals(before), "merchant-totals")   # the stored aggregate
    now = cut_lineage(upserted(spark, sf_dir), "orders-now")               # the table after the merge
    touched = agg.touched_groups(before, delta)
    return agg.merchant_totals_refresh(stored, now, touched)


@register("raw_projection", O.with_(O.EV, O.CDC_FLAT, O.replay("cdc_flat", "st"))
          + "SELECT order_id, merchant_id, status, event_ts FROM st")
def q_raw_projection(spark, sf_dir):
    return agg.raw_projection(ch.replay(td.cdc_flat(spark, sf_dir)))


SILVER_SQL = """silver AS (
  SELECT order_id, merchant_id, status, CAST(CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount,
         upper(currency) AS currency, event_ts, CAST(event_ts AS DATE) AS event_date
  FROM upserted
  WHERE order_id IS NOT NULL AND event_ts IS NOT NULL AND amount IS NOT NULL AND amount >= 0
    AND status IN ('created', 'approved', 'refunded'))"""


@register("silver_orders", O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED,
                                   SILVER_SQL) + "SELECT * FROM silver")
def q_silver_orders(spark, sf_dir):
    return agg.silver_orders(upserted(spark, sf_dir))


@register("gold_daily", O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED,
                                SILVER_SQL) + """
SELECT event_date, merchant_id, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount,
       count(*) AS order_count, sum(CASE WHEN status = 'refunded' THEN 1 ELSE 0 END) AS refunded_count
FROM silver GROUP BY event_date, merchant_id""")
def q_gold_daily(spark, sf_dir):
    return agg.gold_daily(agg.silver_orders(upserted(spark, sf_dir)))
