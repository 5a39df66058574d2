"""Queries: the stored table of days, gated publishing, branches and their three-way merge, retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import branches as br
from ..operators import quality as qc
from ..operators.aggregates import apply_signed, exact_totals, money_sum, totals_view
from ..operators.merge import latest_per_key
from ..schemas import RETENTION_DAYS, SNAPSHOT_TAGS, TARGET_FILE_BYTES
from ..session import cut_lineage, work_path
from ..sources import testdata as td
from ..sources.daytable import DayTable, Rejected
from . import oracle as O
from .registry import register

COLUMNS = td.ORDER_FIELDS
DELTA_ORDER = ["event_ts", "src_file"]


def _table(spark, sf_dir, name):
    """The orders of the benchmark table as a stored table; a month a folder, as there are few orders a day."""
    table = DayTable(spark, work_path(spark, name), unit="month")
    table.create(td.orders_src(spark, sf_dir).select(*COLUMNS))
    return table


def _delta(spark, sf_dir):
    return latest_per_key(td.orders_delta(spark, sf_dir), "order_id", DELTA_ORDER).select(*COLUMNS)


@register("table_ingest", O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED) + "SELECT * FROM upserted")
def q_table_ingest(spark, sf_dir):
    """The same delta ingested twice is in the table once."""
    table = _table(spark, sf_dir, "orders-table")
    for _ in range(2):
        table.upsert(_delta(spark, sf_dir))
    return table.read().select(*COLUMNS)


@register("table_publish", O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED) + """
SELECT 1 AS version, count(*) AS order_count, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount FROM orders_src
UNION ALL SELECT 2, count(*), CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) FROM upserted""")
def q_table_publish(spark, sf_dir):
    """A batch with repeated keys is rejected by the gate, a clean one becomes version 2, and version 1 stays readable."""
    table, delta = _table(spark, sf_dir, "published-table"), _delta(spark, sf_dir)

    def gate(before, staged):
        return qc.quality_report(before, staged, ["order_id"], ["order_id", "event_ts"], max_change=float("inf"), materialize=False)

    try:
        table.upsert(delta.unionByName(delta), check=gate)
        raise AssertionError("repeated keys passed the gate")
    except Rejected:
        pass
    table.upsert(delta, check=gate)
    versions = [table.read(n).agg(F.count("*").alias("order_count"), money_sum("amount").alias("sum_amount")).select(F.lit(n).alias("version"), "*") for n in (1, 2)]
    return versions[0].unionByName(versions[1])


# Main raises urgent orders and drops every 17th; the branch approves every 5th, drops every 19th and adds customers' orders.
_NUMBER = "CAST(substr(order_id, 5) AS BIGINT)"
SIDES_SQL = ("""base AS (SELECT order_id, merchant_id, status, amount, currency, event_ts, o_orderpriority AS p, o_orderkey AS k FROM orders_src)""",
             """main_ AS (SELECT order_id, merchant_id, {main_status} AS status, CASE WHEN p = '1-URGENT' THEN amount + 1 ELSE amount END AS amount, currency, event_ts
  FROM base WHERE NOT (k % 17 = 0 {main_kept}))""",
             """branch_ AS (SELECT order_id, merchant_id, CASE WHEN k % 5 = 0 THEN 'approved' ELSE status END AS status, amount, currency, event_ts
  FROM base WHERE NOT (k % 19 = 0 {branch_kept})
  UNION ALL SELECT 'ord-new-' || CAST(c_custkey AS VARCHAR), 'm-' || CAST(c_custkey AS VARCHAR), 'created', c_acctbal, 'USD', TIMESTAMP '2001-08-02 00:00:00'
  FROM customer WHERE c_mktsegment = 'AUTOMOBILE')""")
VALUES = ["merchant_id", "status", "amount", "currency", "event_ts"]


def _branches(spark, sf_dir, clash):
    """A table whose main and branch changed after they parted.  Without ``clash`` each side leaves alone what the other changes."""
    table = _table(spark, sf_dir, "branched-table")
    table.branch("feature/approve")
    src = td.orders_src(spark, sf_dir)
    number, urgent = F.col("o_orderkey"), F.col("o_orderpriority") == "1-URGENT"
    main = (src.where(~((number % 17 == 0) & (F.lit(clash) | (number % 5 != 0))))
               .withColumn("amount", F.when(urgent, F.col("amount") + 1).otherwise(F.col("amount")))
               .withColumn("status", F.when(urgent & F.lit(clash), "refunded").otherwise(F.col("status"))))
    branch = (src.where(~((number % 19 == 0) & (F.lit(clash) | ~urgent)))
                 .withColumn("status", F.when(number % 5 == 0, "approved").otherwise(F.col("status"))))
    customers = td.orders_delta(spark, sf_dir).where(F.col("order_id").startswith("ord-new-"))
    every = set(table.version().days)
    table.replace_days(main.select(*COLUMNS), every, operation="raise")
    table.replace_days(branch.select(*COLUMNS).unionByName(customers.select(*COLUMNS)), every, "feature/approve", "approve")
    return table


def _sides(clash):
    words = ({"main_status": "CASE WHEN p = '1-URGENT' THEN 'refunded' ELSE status END", "main_kept": "", "branch_kept": ""} if clash else
             {"main_status": "status", "main_kept": "AND k % 5 <> 0", "branch_kept": "AND p <> '1-URGENT'"})
    return [O.ORDERS_SRC, *(s.format(**words) for s in SIDES_SQL)]


def _picked(c):
    return f"CASE WHEN b.order_id IS NULL THEN coalesce(m.{c}, r.{c}) WHEN r.{c} IS DISTINCT FROM b.{c} THEN r.{c} ELSE m.{c} END AS {c}"


JOINED = """FROM (SELECT order_id FROM base UNION SELECT order_id FROM main_ UNION SELECT order_id FROM branch_) k
LEFT JOIN base b ON b.order_id = k.order_id LEFT JOIN main_ m ON m.order_id = k.order_id LEFT JOIN branch_ r ON r.order_id = k.order_id"""


@register("branch_merge", O.with_(*_sides(False)) + f"""
SELECT k.order_id, {', '.join(_picked(c) for c in VALUES)} {JOINED}
WHERE b.order_id IS NULL OR (m.order_id IS NOT NULL AND r.order_id IS NOT NULL)""")
def q_branch_merge(spark, sf_dir):
    """Both sides' changes, also to different columns of one row, are in main after the merge."""
    table = _branches(spark, sf_dir, clash=False)
    if table.merge("feature/approve") is None:
        raise AssertionError("the merge is blocked")
    return table.read().select(*COLUMNS)


_BOTH = {c: f"m.{c} IS DISTINCT FROM b.{c} AND r.{c} IS DISTINCT FROM b.{c} AND m.{c} IS DISTINCT FROM r.{c}" for c in VALUES}
_CHANGED = {side: "(" + " OR ".join(f"{side}.{c} IS DISTINCT FROM b.{c}" for c in VALUES) + ")" for side in "mr"}


@register("branch_conflicts", O.with_(*_sides(True)) + f"""
SELECT order_id, kind, columns FROM (
  SELECT k.order_id, CASE WHEN r.order_id IS NULL AND m.order_id IS NOT NULL AND {_CHANGED['m']} THEN 'update/delete'
                          WHEN m.order_id IS NULL AND r.order_id IS NOT NULL AND {_CHANGED['r']} THEN 'delete/update'
                          WHEN m.order_id IS NOT NULL AND r.order_id IS NOT NULL AND ({' OR '.join(f'({x})' for x in _BOTH.values())}) THEN 'update/update' END AS kind,
         CASE WHEN m.order_id IS NOT NULL AND r.order_id IS NOT NULL THEN nullif(concat_ws(',', {', '.join(f"CASE WHEN {x} THEN '{c}' END" for c, x in _BOTH.items())}), '') END AS columns
  {JOINED} WHERE b.order_id IS NOT NULL) WHERE kind IS NOT NULL""")
def q_branch_conflicts(spark, sf_dir):
    """Conflicts block the merge, and each says what it is about."""
    table = _branches(spark, sf_dir, clash=True)
    if table.merge("feature/approve") is not None:
        raise AssertionError("conflicts didn't block the merge")
    return table.conflicts("feature/approve").select("order_id", "kind", "columns")


@register("branch_merge_preferred", O.with_(*_sides(True)) + f"""
SELECT k.order_id, {', '.join(f"CASE WHEN b.order_id IS NULL THEN coalesce(m.{c}, r.{c}) WHEN m.order_id IS NULL OR r.order_id IS NULL OR {' OR '.join(f'({x})' for x in _BOTH.values())} THEN r.{c} WHEN r.{c} IS DISTINCT FROM b.{c} THEN r.{c} ELSE m.{c} END AS {c}" for c in VALUES)} {JOINED}
WHERE b.order_id IS NULL OR (m.order_id IS NOT NULL AND r.order_id IS NOT NULL) OR (m.order_id IS NULL AND r.order_id IS NOT NULL AND {_CHANGED['r']})""")
def q_branch_merge_preferred(spark, sf_dir):
    """With conflicts decided for the branch its rows win whole, and its deletes too."""
    table = _branches(spark, sf_dir, clash=True)
    table.merge("feature/approve", prefer="branch")
    return table.read().select(*COLUMNS)


@register("table_expire", O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED) + "SELECT * FROM upserted")
def q_table_expire(spark, sf_dir):
    """After old versions and their folders are removed the newest one still reads whole."""
    table = _table(spark, sf_dir, "expired-table")
    for _ in range(2):
        table.upsert(_delta(spark, sf_dir))
    table.expire("2999-01-01 00:00:00", 7)
    return table.read().select(*COLUMNS)


@register("table_totals_refresh", O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED) + """
SELECT merchant_id, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount, count(*) AS order_count
FROM upserted GROUP BY merchant_id""")
def q_table_totals_refresh(spark, sf_dir):
    """Stored totals refreshed by what a version changed: only the months that it rewrote are read, and no totals counted anew."""
    table = _table(spark, sf_dir, "totals-table")
    stored = cut_lineage(exact_totals(table.read()), "exact-totals")
    table.upsert(_delta(spark, sf_dir))
    return totals_view(apply_signed(stored, table.signed_changes(1, 2)))


POLICY_TABLES = list(RETENTION_DAYS)


@register("table_maintenance", O.with_(O.ORDERS_SRC, O.ORDERS_DELTA, O.DELTA_LATEST, O.UPSERTED) + f"""
SELECT t.table_name, s.step, CASE s.step WHEN 'rows' THEN (SELECT count(*) FROM upserted) WHEN 'small_days' THEN 0
                                         WHEN 'tags' THEN t.tags ELSE 1 + t.frozen END AS value
FROM (VALUES {', '.join(f"('{t}', {len(SNAPSHOT_TAGS.get(t, [])) + 1}, 1)" for t in POLICY_TABLES)}) AS t(table_name, tags, frozen),
     (VALUES ('rows'), ('small_days'), ('tags'), ('versions_kept')) AS s(step)""")
def q_table_maintenance(spark, sf_dir):
    """All policy tables: months of small files are rewritten, the first load is frozen by a tag, older versions and their files go."""
    reports = []
    for name in POLICY_TABLES:
        table, target = _table(spark, sf_dir, name.replace(".", "-")), TARGET_FILE_BYTES[name]
        for _ in range(2):
            table.upsert(_delta(spark, sf_dir))
        policy = [("first-load", "first"), *SNAPSHOT_TAGS.get(name, [])]
        reports.append(table.maintain(name, target, RETENTION_DAYS[name], policy, "2999-01-01 00:00:00").where(F.col("step").isin("rows", "tags", "versions_kept")))
        small = table.file_groups(target).where("compact").agg(F.count(F.lit(1)).alias("value"))
        reports.append(small.select(F.lit(name).alias("table_name"), F.lit("small_days").alias("step"), "value"))
    return reduce(DataFrame.unionByName, reports)


@register("table_erase", O.with_(O.ORDERS_SRC, """erase AS (SELECT 'm-' || CAST(c_custkey AS VARCHAR) AS merchant_id FROM customer WHERE c_mktsegment = 'MACHINERY')""")
          + f"SELECT {', '.join(COLUMNS)} FROM orders_src WHERE merchant_id NOT IN (SELECT merchant_id FROM erase)")
def q_table_erase(spark, sf_dir):
    """The orders of customers to be forgotten leave the table, its old versions and its tags."""
    table = _table(spark, sf_dir, "erased-table")
    table.tag([("first-load", "first")])
    customers = td.read_table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "MACHINERY")
    forgotten = customers.select(F.concat(F.lit("m-"), F.col("c_custkey").cast("string")).alias("merchant_id"))
    table.erase(table.read().join(forgotten, "merchant_id", "left_semi"))
    return table.read().select(*COLUMNS)
