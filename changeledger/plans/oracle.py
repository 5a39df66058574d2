"""Independent DuckDB SQL for every registered query.

The fixtures of ``sources.testdata`` are rebuilt here as CTEs over the same
parquet tables; each query's SQL states the operator's meaning directly
(joins, FILTERed arg_max, window ranks) rather than mirroring the Spark plan.
"""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

ORDERS_SRC = """orders_src AS (
  SELECT 'ord-' || CAST(o_orderkey AS VARCHAR) AS order_id,
         'm-' || CAST(o_custkey AS VARCHAR) AS merchant_id,
         CASE o_orderstatus WHEN 'O' THEN 'created' WHEN 'F' THEN 'approved' ELSE 'refunded' END AS status,
         o_totalprice AS amount, 'USD' AS currency, CAST(o_orderdate AS TIMESTAMP) AS event_ts,
         o_orderkey, o_orderpriority
  FROM orders)"""

ORDERS_DELTA = """orders_delta AS (
  SELECT order_id, merchant_id, 'refunded' AS status, amount + 1 AS amount, currency,
         event_ts + INTERVAL 1 DAY AS event_ts, 'delta-2.json' AS src_file
  FROM orders_src WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT order_id, merchant_id, 'stale', amount, currency, event_ts, 'delta-1.json'
  FROM orders_src WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT 'ord-new-' || CAST(c_custkey AS VARCHAR), 'm-' || CAST(c_custkey AS VARCHAR), 'created',
         c_acctbal, 'USD', TIMESTAMP '2001-08-02 00:00:00', 'delta-2.json'
  FROM customer WHERE c_mktsegment = 'AUTOMOBILE')"""

# newest version per key: greatest (event_ts, src_file)
DELTA_LATEST = """delta_latest AS (
  SELECT order_id, merchant_id, status, amount, currency, event_ts, src_file FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_ts DESC, src_file DESC) AS rn
    FROM orders_delta) WHERE rn = 1)"""

UPSERTED = """upserted AS (
  SELECT coalesce(s.order_id, t.order_id) AS order_id,
         CASE WHEN s.order_id IS NOT NULL THEN s.merchant_id ELSE t.merchant_id END AS merchant_id,
         CASE WHEN s.order_id IS NOT NULL THEN s.status ELSE t.status END AS status,
         CASE WHEN s.order_id IS NOT NULL THEN s.amount ELSE t.amount END AS amount,
         CASE WHEN s.order_id IS NOT NULL THEN s.currency ELSE t.currency END AS currency,
         CASE WHEN s.order_id IS NOT NULL THEN s.event_ts ELSE t.event_ts END AS event_ts
  FROM (SELECT order_id, merchant_id, status, amount, currency, event_ts FROM orders_src) t
  FULL OUTER JOIN delta_latest s ON t.order_id = s.order_id)"""

EV = f"ev AS (SELECT *, {K} AS k FROM events)"

CDC_FLAT = """cdc_flat AS (
  SELECT event_id AS seq, 'ord-' || CAST(user_id AS VARCHAR) AS order_id,
         CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END AS op,
         'm-' || CAST(user_id % 16 AS VARCHAR) AS merchant_id,
         CASE WHEN k % 7 <> 0 THEN event_type END AS status,
         CASE WHEN k % 5 <> 0 THEN value END AS amount,
         'USD' AS currency, ts AS event_ts
  FROM ev)"""

COMMITS = """commits AS (
  SELECT dense_rank() OVER (ORDER BY day) AS snapshot_id,
         CAST(day AS TIMESTAMP) + INTERVAL 1 DAY AS committed_at,
         'append' AS operation, added_rows,
         sum(added_rows) OVER (ORDER BY day) AS total_rows
  FROM (SELECT CAST(event_ts AS DATE) AS day, count(*) AS added_rows FROM cdc_flat GROUP BY 1))"""

VALUE_COLS = ["merchant_id", "status", "amount", "currency", "event_ts"]


def replay(src: str, name: str) -> str:
    """CTE ``name``: state after applying change rows of ``src`` one by one."""
    picks = ",\n         ".join(
        f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in VALUE_COLS)
    return f"""{name}_del AS (
  SELECT order_id, max(CASE WHEN op = 'delete' THEN seq END) AS last_del FROM {src} GROUP BY order_id),
{name} AS (
  SELECT s.order_id,
         {picks.replace('arg_max(', 'arg_max(s.').replace(', seq)', ', s.seq)')}
  FROM {src} s JOIN {name}_del d ON s.order_id = d.order_id
  WHERE s.op IN ('insert', 'update', 'replace') AND s.seq > coalesce(d.last_del, -1)
  GROUP BY s.order_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def cut_at_version(v: int, name: str) -> str:
    return (f"{name} AS (SELECT * FROM cdc_flat WHERE event_ts < "
            f"(SELECT committed_at FROM commits WHERE snapshot_id = {v}))")


CLICK_BROWSER = ("CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' AND k % 2 = 0 "
                 "THEN 'b' || CAST(k % 4 AS VARCHAR) END")
