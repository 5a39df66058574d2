"""Queries: data-quality checks and the gated report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as qc
from ..sources import testdata as td
from . import oracle as O
from .q_changes import upserted
from .registry import register

ATTRS = ["merchant_id", "status", "amount", "event_ts"]

ROW_DELTA_SQL = """rcd AS (
  SELECT p.n AS previous_rows, c.n AS current_rows,
         CASE WHEN p.n = 0 THEN (CASE WHEN c.n = 0 THEN 0.0 ELSE 1.0 END)
              ELSE abs(c.n - p.n) / p.n END AS change_ratio
  FROM (SELECT count(*) AS n FROM orders_src) p, (SELECT count(*) AS n FROM upserted) c)"""

NULLS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate FROM {{src}}"
    for c in ATTRS)

MISSING_SQL = """days AS (SELECT DISTINCT CAST({col} AS DATE) AS dt FROM {src}),
missing AS (
  SELECT CAST(g.d AS DATE) AS missing_dt
  FROM generate_series((SELECT min(dt) FROM days)::TIMESTAMP, (SELECT max(dt) FROM days)::TIMESTAMP,
                       INTERVAL 1 DAY) AS g(d)
  WHERE CAST(g.d AS DATE) NOT IN (SELECT dt FROM days))"""


@register("row_count_delta", O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED,
                                     ROW_DELTA_SQL) + """
SELECT previous_rows, current_rows, CAST(change_ratio AS DOUBLE) AS change_ratio,
       CAST(0.5 AS DOUBLE) AS threshold, change_ratio <= 0.5 AS passed FROM rcd""")
def q_row_count_delta(spark, sf_dir):
    return qc.row_count_delta(td.orders_src(spark, sf_dir), upserted(spark, sf_dir), 0.5)


@register("null_rates", O.with_(O.EV, O.CDC_FLAT) + NULLS_SQL.format(src="cdc_flat"))
def q_null_rates(spark, sf_dir):
    return qc.null_rates(td.cdc_flat(spark, sf_dir), ATTRS)


@register("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf_dir):
    return qc.duplicate_keys(td.read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("partition_presence", O.with_(MISSING_SQL.format(col="o_orderdate", src="orders"))
          + "SELECT missing_dt FROM missing")
def q_partition_presence(spark, sf_dir):
    """Order days between the first and last order date that have no orders."""
    o = td.read_table(spark, sf_dir, "orders")
    return qc.partition_presence(o.select(F.to_date("o_orderdate").alias("dt")))


@register("quality_report", O.with_(
    O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED, ROW_DELTA_SQL,
    f"nr AS ({NULLS_SQL.format(src='upserted')})",
    MISSING_SQL.format(col="event_ts", src="upserted")) + """
SELECT 'row_count_delta' AS check_name, CAST(change_ratio AS DOUBLE) AS value, CAST(0.5 AS DOUBLE) AS threshold,
       change_ratio <= 0.5 AS passed FROM rcd
UNION ALL
SELECT 'null_rate:' || column_name, null_rate, 0.05, null_rate <= 0.05 FROM nr
UNION ALL
SELECT 'duplicate_keys', CAST(count(*) AS DOUBLE), 0.0, count(*) <= 0 FROM (
  SELECT order_id FROM upserted GROUP BY order_id HAVING count(*) > 1)
UNION ALL
SELECT 'missing_days', CAST(count(*) AS DOUBLE), 0.0, count(*) <= 0 FROM missing""")
def q_quality_report(spark, sf_dir):
    return qc.quality_report(td.orders_src(spark, sf_dir), upserted(spark, sf_dir),
                             ["order_id"], ATTRS, day_col="event_ts")
