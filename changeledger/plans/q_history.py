"""Queries: snapshots, time travel, tags, diffs, retention, schema evolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rest import conditional_update
from ..operators import evolution as evo
from ..operators import history as h
from ..operators import intervals as iv
from ..operators.aggregates import exact_totals
from ..operators.layout import distribute_for_write
from ..schemas import RAW_TTL_DAYS, RETENTION_DAYS, SNAPSHOT_TAGS, ZONE_RETENTION_DAYS
from ..session import cut_lineage, work_path
from ..sources import hashtree, ledger
from ..sources import testdata as td
from . import oracle as O
from .registry import register

AS_OF_VERSION = 10
AS_OF_TS = "2024-01-15 12:00:00"
DIFF_FROM, DIFF_TO = 10, 20
EXPIRE_NOW = "2024-02-01 00:00:00"
ZONE_NOW = "2024-02-15 00:00:00"
RAW_RUN_DATE = "2001-08-02"
# tag policy of the change table: frozen first load, a fixed reporting day, month-start → latest
TAG_POLICY = [("first-load", "first"), ("day-10", "10")] + SNAPSHOT_TAGS["payments.orders"]

HIST = (O.EV, O.CDC_FLAT, O.COMMITS)


def _log(spark, sf_dir, store: bool = False):
    """The change log and its commits.  Queries that use the commits several
    times store them once (a few rows per day), as a ledger's commit dataset
    is stored, so each use scans a tiny table instead of the log."""
    log = td.cdc_flat(spark, sf_dir)
    commits = h.commits_by_day(log)
    return log, (cut_lineage(commits, "commits") if store else commits)


_LEDGERS: dict[tuple[str, str], str] = {}


def _ledger(spark, sf_dir):
    """The change log as a written ledger with a batch for each event day; written once a session, as a stream would have done."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LEDGERS:
        root = work_path(spark, "history-ledger")
        log, commits = _log(spark, sf_dir, store=True)
        rows = h.with_batches(log, commits).where(F.col("batch_id").isNotNull()).withColumn("_lane", F.lit("ok"))
        none = [F.lit(None).cast("string").alias(c) for c in ("source_id", "_reason", "_payload")]
        distribute_for_write(rows.select("*", *none), "batch_id", ["seq"]).write.partitionBy("batch_id", "_lane").parquet(f"{root}/log")
        commits.select("snapshot_id", "committed_at", "operation", "added_rows", F.lit(0).cast("long").alias("id_deletes"),
                       F.col("snapshot_id").alias("batch_id")).coalesce(1).write.partitionBy("batch_id").parquet(f"{root}/commits")
        _LEDGERS[key] = root
    return _LEDGERS[key]


@register("snapshot_log", O.with_(*HIST) + "SELECT * FROM commits")
def q_snapshot_log(spark, sf_dir):
    return _log(spark, sf_dir)[1]


@register("latest_snapshot", O.with_(*HIST)
          + "SELECT snapshot_id, committed_at FROM commits ORDER BY committed_at DESC LIMIT 1")
def q_latest_snapshot(spark, sf_dir):
    return h.latest_snapshot(_log(spark, sf_dir)[1])


@register("first_snapshot", O.with_(*HIST)
          + "SELECT snapshot_id, committed_at FROM commits ORDER BY committed_at LIMIT 1")
def q_first_snapshot(spark, sf_dir):
    return h.first_snapshot(_log(spark, sf_dir)[1])


@register("as_of_version", O.with_(*HIST, O.cut_at_version(AS_OF_VERSION, "pre"),
                                   O.replay("pre", "st")) + "SELECT * FROM st")
def q_as_of_version(spark, sf_dir):
    return ledger.as_of_version(spark, _ledger(spark, sf_dir), AS_OF_VERSION)


@register("as_of_timestamp", O.with_(*HIST, f"""pre AS (SELECT * FROM cdc_flat WHERE event_ts <
  (SELECT max(committed_at) FROM commits WHERE committed_at <= TIMESTAMP '{AS_OF_TS}'))""",
                                     O.replay("pre", "st")) + "SELECT * FROM st")
def q_as_of_timestamp(spark, sf_dir):
    return ledger.as_of_timestamp(spark, _ledger(spark, sf_dir), AS_OF_TS)


TAGS_SQL = """tags AS (
  SELECT 'first-load' AS tag, (SELECT snapshot_id FROM commits ORDER BY committed_at LIMIT 1) AS snapshot_id
  UNION ALL SELECT 'day-10', 10
  UNION ALL SELECT 'month-start', (SELECT snapshot_id FROM commits ORDER BY committed_at DESC LIMIT 1))"""


@register("tag_snapshots", O.with_(*HIST, TAGS_SQL) + """
SELECT t.tag, t.snapshot_id, c.committed_at FROM tags t JOIN commits c ON t.snapshot_id = c.snapshot_id""")
def q_tag_snapshots(spark, sf_dir):
    _, commits = _log(spark, sf_dir, store=True)
    return h.tag_snapshots(spark, commits, TAG_POLICY)


@register("as_of_tag", O.with_(*HIST, TAGS_SQL, """pre AS (SELECT * FROM cdc_flat WHERE event_ts <
  (SELECT c.committed_at FROM commits c JOIN tags t ON c.snapshot_id = t.snapshot_id
   WHERE t.tag = 'first-load'))""", O.replay("pre", "st")) + "SELECT * FROM st")
def q_as_of_tag(spark, sf_dir):
    root = _ledger(spark, sf_dir)
    ledger.tag(spark, root, TAG_POLICY)
    return ledger.as_of_tag(spark, root, "first-load")


_DIFF_COLS = ["merchant_id", "status", "amount", "currency", "event_ts"]
_DISTINCT = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _DIFF_COLS)
_NAMES = ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _DIFF_COLS)


@register("snapshot_diff", O.with_(
    *HIST, O.cut_at_version(DIFF_FROM, "pa"), O.replay("pa", "sa"),
    O.cut_at_version(DIFF_TO, "pb"), O.replay("pb", "sb")) + f"""
SELECT coalesce(a.order_id, b.order_id) AS order_id,
       CASE WHEN a.order_id IS NULL THEN 'added' WHEN b.order_id IS NULL THEN 'removed'
            ELSE 'changed' END AS change,
       CASE WHEN a.order_id IS NOT NULL AND b.order_id IS NOT NULL THEN concat_ws(',', {_NAMES}) END
         AS changed_columns
FROM sa a FULL OUTER JOIN sb b ON a.order_id = b.order_id
WHERE a.order_id IS NULL OR b.order_id IS NULL OR {_DISTINCT}""")
def q_snapshot_diff(spark, sf_dir):
    return ledger.diff(spark, _ledger(spark, sf_dir), DIFF_FROM, DIFF_TO)


@register("totals_signed_refresh", O.with_(*HIST, O.replay("cdc_flat", "st")) + """
SELECT merchant_id, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount, count(*) AS order_count
FROM st GROUP BY merchant_id""")
def q_totals_signed_refresh(spark, sf_dir):
    """Totals stored at a version, then brought to the newest one by the signed changes between them."""
    root, path = _ledger(spark, sf_dir), work_path(spark, "ledger-totals")
    exact_totals(ledger.as_of_version(spark, root, AS_OF_VERSION)).write.parquet(f"{path}/upto={AS_OF_VERSION}")
    return ledger.refresh_totals(spark, root, path)


@register("snapshot_diff_tree", O.with_(
    *HIST, O.cut_at_version(DIFF_FROM, "pa"), O.replay("pa", "sa"),
    O.cut_at_version(DIFF_TO, "pb"), O.replay("pb", "sb")) + f"""
SELECT coalesce(a.order_id, b.order_id) AS order_id,
       CASE WHEN a.order_id IS NULL THEN 'added' WHEN b.order_id IS NULL THEN 'removed'
            ELSE 'changed' END AS change,
       CASE WHEN a.order_id IS NOT NULL AND b.order_id IS NOT NULL THEN concat_ws(',', {_NAMES}) END
         AS changed_columns
FROM sa a FULL OUTER JOIN sb b ON a.order_id = b.order_id
WHERE a.order_id IS NULL OR b.order_id IS NULL OR {_DISTINCT}""")
def q_snapshot_diff_tree(spark, sf_dir):
    """Two stored versions compared by their digest trees: only slots that differ are read."""
    root = _ledger(spark, sf_dir)
    paths = [hashtree.write_version(ledger.as_of_version(spark, root, v), work_path(spark, "tree")) for v in (DIFF_FROM, DIFF_TO)]
    return hashtree.diff(spark, *paths)


@register("validity_intervals", O.with_(*HIST, O.cut_at_version(AS_OF_VERSION, "pre"), O.replay("pre", "st")) + "SELECT * FROM st")
def q_validity_intervals(spark, sf_dir):
    """A version cut out of the validity intervals by a filter equals the replay of its log."""
    log = td.cdc_flat(spark, sf_dir)
    upto = h.with_batches(log, _log(spark, sf_dir, store=True)[1]).where(F.col("batch_id") <= AS_OF_VERSION).agg(F.max("seq")).first()[0]
    return iv.at_version(iv.validity(log), upto)


@register("as_of_join", O.with_(O.EV, O.CDC_FLAT, """facts AS (SELECT event_id * 3 % (SELECT max(event_id) FROM ev) AS at, 'ord-' || CAST(user_id AS VARCHAR) AS who, event_id AS fact FROM ev WHERE k % 10 = 0),
dead AS (SELECT f.fact, f.at, f.who, max(c.seq) FILTER (WHERE c.op = 'delete') AS gone FROM facts f LEFT JOIN cdc_flat c ON c.order_id = f.who AND c.seq <= f.at GROUP BY ALL)""") + """
SELECT d.fact, d.who, d.at, arg_max(c.merchant_id, c.seq) FILTER (WHERE c.merchant_id IS NOT NULL) AS merchant_id,
       arg_max(c.status, c.seq) FILTER (WHERE c.status IS NOT NULL) AS status, arg_max(c.amount, c.seq) FILTER (WHERE c.amount IS NOT NULL) AS amount
FROM dead d LEFT JOIN cdc_flat c ON c.order_id = d.who AND c.seq <= d.at AND c.op <> 'delete' AND c.seq > coalesce(d.gone, -1)
GROUP BY d.fact, d.who, d.at""")
def q_as_of_join(spark, sf_dir):
    """Each fact with its order's row as it was at the fact's own place in the log."""
    log = td.cdc_flat_k(spark, sf_dir)
    last = log.agg(F.max("seq")).first()[0]
    facts = log.where(F.col("k") % 10 == 0).select(F.col("seq").alias("fact"), F.col("order_id").alias("who"), (F.col("seq") * 3 % last).alias("at"))
    return iv.as_of_join(facts, iv.validity(log.drop("k"), value_cols=["merchant_id", "status", "amount"]), "who", "at")


_RET_VALUES = ", ".join(f"('{t}', {d})" for t, d in RETENTION_DAYS.items())
_ZONE_VALUES = ", ".join(f"('{z}', {d})" for z, d in ZONE_RETENTION_DAYS.items())


@register("expire_snapshots", O.with_(*HIST, f"""pol AS (
  SELECT * FROM (VALUES {_RET_VALUES}) AS p(table_name, retention_days)),
ttags AS (
  SELECT 'payments.orders' AS table_name,
         (SELECT snapshot_id FROM commits ORDER BY committed_at DESC LIMIT 1) AS snapshot_id
  UNION ALL SELECT 'payments.merchant_events', 10)""") + f"""
SELECT p.table_name, c.snapshot_id, c.committed_at FROM pol p, commits c
WHERE c.committed_at < TIMESTAMP '{EXPIRE_NOW}' - to_days(CAST(p.retention_days AS INTEGER))
  AND c.snapshot_id <> (SELECT max(snapshot_id) FROM commits)
  AND NOT EXISTS (SELECT 1 FROM ttags t WHERE t.table_name = p.table_name
                  AND t.snapshot_id = c.snapshot_id)""")
def q_expire_snapshots(spark, sf_dir):
    """Three tables share the change log's commit history; tags are taken first."""
    _, commits = _log(spark, sf_dir, store=True)
    per_table = None
    for t in RETENTION_DAYS:
        part = commits.withColumn("table_name", F.lit(t))
        per_table = part if per_table is None else per_table.unionByName(part)
    retention = spark.createDataFrame(list(RETENTION_DAYS.items()),
                                      "table_name string, retention_days int")
    month_start = h.tag_snapshots(spark, commits, SNAPSHOT_TAGS["payments.orders"]) \
        .select(F.lit("payments.orders").alias("table_name"), "snapshot_id")
    day10 = h.tag_snapshots(spark, commits, [("day-10", "10")]) \
        .select(F.lit("payments.merchant_events").alias("table_name"), "snapshot_id")
    return h.expire_snapshots(per_table, retention, month_start.unionByName(day10), EXPIRE_NOW)


@register("expire_by_zone", O.with_(*HIST, f"""pol AS (
  SELECT * FROM (VALUES {_ZONE_VALUES}) AS p(zone, retention_days))""") + f"""
SELECT p.zone, c.snapshot_id, c.committed_at FROM pol p, commits c
WHERE c.committed_at < TIMESTAMP '{ZONE_NOW}' - to_days(CAST(p.retention_days AS INTEGER))
  AND c.snapshot_id <> (SELECT max(snapshot_id) FROM commits)""")
def q_expire_by_zone(spark, sf_dir):
    _, commits = _log(spark, sf_dir, store=True)
    per_zone = None
    for z in ZONE_RETENTION_DAYS:
        part = commits.withColumn("zone", F.lit(z))
        per_zone = part if per_zone is None else per_zone.unionByName(part)
    retention = spark.createDataFrame(list(ZONE_RETENTION_DAYS.items()), "zone string, retention_days int")
    no_tags = spark.createDataFrame([], "zone string, snapshot_id long")
    return h.expire_snapshots(per_zone, retention, no_tags, ZONE_NOW, table_col="zone") \
            .select("zone", "snapshot_id", "committed_at")


@register("raw_ttl", f"""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt FROM orders
WHERE CAST(o_orderdate AS DATE) < DATE '{RAW_RUN_DATE}' - INTERVAL {RAW_TTL_DAYS} DAY""")
def q_raw_ttl(spark, sf_dir):
    """Landing partitions (one per order date) past the raw retention."""
    o = td.read_table(spark, sf_dir, "orders")
    return h.raw_ttl(o.select(F.to_date("o_orderdate").alias("dt")), RAW_RUN_DATE, RAW_TTL_DAYS)


# ------------------------------------------------------------ schema evolution
EVOLUTION = [
    (2, "add", "browser", "string"),
    (4, "promote", "browser", "attributes", "browser"),
    (5, "rename", "attributes", "metadata"),
]
V1_COLUMNS = ["event_id", "session_id", "user_id", "attributes", "event_ts"]


def _click_versions(spark, sf_dir):
    c = td.clickstream(spark, sf_dir)
    v1 = c.where(F.col("version") == 1).select(*V1_COLUMNS)
    v2 = c.where(F.col("version") == 2).select(*V1_COLUMNS)
    return v1, v2


def _write_versions(spark, sf_dir, v2_has_browser: bool):
    v1, v2 = _click_versions(spark, sf_dir)
    root = work_path(spark, "clickstream")
    v1.write.mode("overwrite").parquet(f"{root}/v1")
    if v2_has_browser:
        v2 = v2.withColumn("browser", F.try_element_at("attributes", F.lit("browser")))
    v2.write.mode("overwrite").parquet(f"{root}/v2")
    return evo.read_merged(spark, [f"{root}/v1", f"{root}/v2"])


BROWSER_SQL = O.with_(O.EV) + f"""
SELECT event_id, 'sess-' || CAST(user_id AS VARCHAR) AS session_id, {O.CLICK_BROWSER} AS browser FROM ev"""


@register("add_column", BROWSER_SQL)
def q_add_column(spark, sf_dir):
    """Version-2 files carry the new column; version-1 files read it as NULL."""
    return _write_versions(spark, sf_dir, True).select("event_id", "session_id", "browser")


@register("promote_field", BROWSER_SQL)
def q_promote_field(spark, sf_dir):
    """Column added, then back-filled from the attribute map for all stored rows."""
    df = evo.apply_steps(_write_versions(spark, sf_dir, False), EVOLUTION[:2])
    return df.select("event_id", "session_id", "browser")


@register("append_by_name", BROWSER_SQL)
def q_append_by_name(spark, sf_dir):
    v1, v2 = _click_versions(spark, sf_dir)
    target = evo.add_column(v1, "browser", "string")
    rows = v2.withColumn("browser", F.try_element_at("attributes", F.lit("browser"))) \
             .select("browser", "event_ts", "attributes", "session_id", "event_id")  # any order
    return evo.append_by_name(target, rows).select("event_id", "session_id", "browser")


@register("conditional_update", BROWSER_SQL)
def q_conditional_update(spark, sf_dir):
    c = td.clickstream(spark, sf_dir).withColumn("browser", F.lit(None).cast("string"))
    return conditional_update(c, "browser", "attributes", "browser") \
        .select("event_id", "session_id", "browser")


@register("rename_column", O.with_(O.EV) + """
SELECT event_id, event_type AS page,
       CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'a' || CAST(k % 3 AS VARCHAR) END AS action,
       CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' AND k % 2 = 0
            THEN 'b' || CAST(k % 4 AS VARCHAR) END AS browser
FROM ev""")
def q_rename_column(spark, sf_dir):
    """All steps applied: the map is read under its new name."""
    df = evo.apply_steps(_write_versions(spark, sf_dir, False), EVOLUTION)
    assert "attributes" not in df.columns
    return df.select("event_id",
                     F.try_element_at("metadata", F.lit("page")).alias("page"),
                     F.try_element_at("metadata", F.lit("action")).alias("action"),
                     "browser")


@register("old_snapshot_schema", O.with_(O.EV) + """
SELECT event_id, event_type AS page, 'a' || CAST(k % 3 AS VARCHAR) AS action, 5 AS n_columns
FROM ev WHERE ts < TIMESTAMP '2024-01-16 00:00:00'""")
def q_old_snapshot_schema(spark, sf_dir):
    """Snapshot 1 (first load) read with the evolution steps of its time: none."""
    v1, _ = _click_versions(spark, sf_dir)
    root = work_path(spark, "clickstream-v1")
    v1.write.mode("overwrite").parquet(root)
    old = evo.apply_steps(spark.read.parquet(root), EVOLUTION, upto=1)
    cols = evo.columns_at(old.schema, EVOLUTION, 1)
    return old.select("event_id",
                      F.try_element_at("attributes", F.lit("page")).alias("page"),
                      F.try_element_at("attributes", F.lit("action")).alias("action"),
                      F.lit(len(cols)).alias("n_columns"))
