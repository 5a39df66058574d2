"""File layout (counts, ordering, buckets), gated publish, and the change stream."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from changeledger.operators import layout as lay
from changeledger.operators.changes import replay
from changeledger.plans import jobs
from changeledger.plans import q_stream
from changeledger.session import work_path
from changeledger.sources import ledger
from changeledger.sources import testdata as td
from changeledger.streaming import cdc_stream as cs

SF = "/root/testdata/sf0.001"


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_write_ordered_files_do_not_overlap(spark):
    path = work_path(spark, "ordered")
    lay.write_ordered(td.cdc_flat(spark, SF), path, files=4)
    files = [r["path"] for r in lay.file_stats(spark, path).collect()]
    ranges = []
    for f in files:
        stats = pq.ParquetFile(_local(f)).metadata
        col = [i for i in range(stats.num_columns) if stats.schema.column(i).name == "event_ts"][0]
        lo = min(stats.row_group(g).column(col).statistics.min for g in range(stats.num_row_groups))
        hi = max(stats.row_group(g).column(col).statistics.max for g in range(stats.num_row_groups))
        ranges.append((lo, hi))
    ranges.sort()
    assert len(ranges) > 1
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_compaction_reduces_files_and_keeps_rows(spark):
    path = work_path(spark, "small")
    log = td.cdc_flat(spark, SF)
    lay.write_days(log, path, max_records=5)
    before = lay.file_stats(spark, path, "event_date")
    cands = lay.compaction_candidates(before, 268435456, "event_date")
    assert cands.where("compact").count() > 0
    new = lay.compact_files(spark, path, work_path(spark, "compacted"), "event_date", 268435456)
    after = lay.file_stats(spark, new, "event_date")
    assert after.count() < before.count()
    assert after.groupBy("event_date").count().where("count > 1").count() == 0
    a, b = spark.read.parquet(path), spark.read.parquet(new)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_file_sizing_bounds_rows_per_file(spark):
    path = work_path(spark, "sized")
    lay.write_sized(td.orders_src(spark, SF), path, max_records=100)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count()
    assert per_file.agg(F.max("count")).first()[0] <= 100


def test_bucketed_table_aggregates_without_shuffle(spark):
    path = work_path(spark, "bucketed")
    name = "bucket_test_" + path.rsplit("-", 1)[-1]
    lay.write_days_bucketed(td.cdc_flat(spark, SF), path, name)
    plan = spark.table(name).groupBy("merchant_id").count()._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_write_audit_publish_pass_and_block(spark):
    prev = td.orders_src(spark, SF).select(*td.ORDER_FIELDS)
    main = work_path(spark, "main")
    ok, report = jobs.write_audit_publish(prev, prev, main, ["order_id"], ["order_id"])
    assert ok and spark.read.parquet(main).count() == prev.count()
    blocked_main = work_path(spark, "main-blocked")
    dup = prev.unionByName(prev.limit(5))
    ok, report = jobs.write_audit_publish(dup, prev, blocked_main, ["order_id"], ["order_id"])
    assert not ok
    assert report.where("check_name = 'duplicate_keys' AND NOT passed").count() == 1
    import os
    assert not os.path.exists(_local(blocked_main))


def test_orphan_files_reported_not_deleted(spark):
    df = q_stream_free_orphans(spark)
    assert df.count() > 0


def q_stream_free_orphans(spark):
    from changeledger.plans.registry import QUERIES
    return QUERIES["orphan_files"](spark, SF)


def test_stream_equals_batch_for_file_counts_and_dead_letters(spark):
    expected = {tuple(r) for r in replay(td.cdc_flat(spark, SF)).collect()}
    for max_files in (1, 4, 100):
        src, root, ckpt = (work_path(spark, n) for n in ("in", "ledger", "ckpt"))
        q_stream._land_records(q_stream._records(spark, SF), src, 6)
        q_stream._run(spark, src, root, ckpt, max_files=max_files)
        assert {tuple(r) for r in ledger.state(spark, root).collect()} == expected
        commits = ledger.commits(spark, root)
        assert commits.count() == -(-6 // max_files)


def test_stream_restart_does_not_double_apply(spark):
    src, root, ckpt = (work_path(spark, n) for n in ("in", "ledger", "ckpt"))
    rec = q_stream._records(spark, SF)
    q_stream._land_records(rec, src, 3)
    q_stream._run(spark, src, root, ckpt)
    n1 = ledger.committed_log(spark, root).count()
    q_stream._run(spark, src, root, ckpt)          # nothing new: no new batch
    assert ledger.committed_log(spark, root).count() == n1
    assert ledger.commits(spark, root).count() == 1


def test_stream_routes_bad_payloads_to_dead_letters(spark):
    src, root, ckpt = (work_path(spark, n) for n in ("in", "ledger", "ckpt"))
    env = td.envelopes(spark, SF, corrupt=True).select("seq", "value")
    recs = env.select(F.lit(None).cast("string").alias("key"), "value",
                      F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                      F.col("seq").alias("offset"))
    recs.coalesce(2).write.json(src)
    q_stream._run(spark, src, root, ckpt)
    dlq = ledger.dead_letter_log(spark, root)
    assert dlq.count() > 0
    assert dlq.count() + ledger.committed_log(spark, root).count() == env.count()
    added = ledger.commits(spark, root).agg(F.sum("added_rows")).first()[0]
    assert added == ledger.committed_log(spark, root).count()


def test_full_document_stream(spark):
    src, root, ckpt = (work_path(spark, n) for n in ("in", "ledger", "ckpt"))
    docs = td.full_documents(spark, SF).select(
        F.lit(None).cast("string").alias("key"), "value", F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.col("seq").alias("offset"))
    docs.coalesce(2).write.json(src)
    q = cs.start_ledger_stream(cs.file_source(spark, src), root, ckpt, full_document_only=True)
    q.awaitTermination()
    assert ledger.committed_log(spark, root).where("op <> 'update'").count() == 0
    assert ledger.committed_log(spark, root).count() == docs.count()


def test_ledger_time_travel_and_base(spark):
    src, root, ckpt = (work_path(spark, n) for n in ("in", "ledger", "ckpt"))
    q_stream._land_records(q_stream._records(spark, SF), src, 4)
    q_stream._run(spark, src, root, ckpt, max_files=1)
    log = ledger.committed_log(spark, root)
    v2 = {tuple(r) for r in ledger.state(spark, root, upto=1).collect()}
    assert v2 == {tuple(r) for r in replay(log.where("batch_id <= 1").drop("batch_id")).collect()}
    base = ledger.write_base(spark, root, 1, work_path(spark, "base"))
    # files may be picked up out of offset order: late rows take their place all the same
    got = {tuple(r) for r in ledger.state(spark, root, base=base).collect()}
    assert got == {tuple(r) for r in replay(log.drop("batch_id")).collect()}
    assert got == {tuple(r) for r in ledger.state(spark, root).collect()}


def test_late_rows_after_compaction_are_reported_and_merged(spark):
    src, root, ckpt = (work_path(spark, n) for n in ("in", "ledger", "ckpt"))
    rec = q_stream._records(spark, SF)
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    # early batch: everything before the cut except a few rows that arrive later
    late_mask = (F.col("event_ts") < cut) & (F.col("offset") % 50 == 0)
    early = rec.where((F.col("event_ts") < cut) & ~late_mask)
    q_stream._land_records(early, src, 1)
    q_stream._run(spark, src, root, ckpt)
    base = ledger.write_base(spark, root, 0, work_path(spark, "base"))
    q_stream._land_records(rec.where((F.col("event_ts") >= cut) | late_mask), src, 1)
    q_stream._run(spark, src, root, ckpt)
    # expected late rows: held-back rows whose key already had a later folded event
    marks = early.groupBy("key").agg(F.max("offset").alias("m"))
    expected = rec.where(late_mask).join(marks, "key").where(F.col("offset") <= F.col("m"))
    late = ledger.late_events(spark, root, base)
    assert late.count() == expected.count() > 0
    assert {tuple(r) for r in ledger.state(spark, root, base=base).collect()} == \
        {tuple(r) for r in replay(td.cdc_flat(spark, SF)).collect()}


def test_per_key_marks_allow_interleaved_partitions(spark):
    """Offsets of two topic partitions interleave; only the order within a key matters."""
    from changeledger.schemas import CHANGE_ROW
    src, root, ckpt = (work_path(spark, n) for n in ("in", "ledger", "ckpt"))
    def rec(key, off, op, status):
        value = ('{"operationType":"%s","fullDocument":{"order_id":"%s","status":"%s"},'
                 '"documentKey":{"_id":"%s"},"clusterTime":"2024-01-01T00:00:00.000000"}'
                 % (op, key, status, key))
        return (key, value, "t", 0, off)
    first = [rec("a", 100, "insert", "a1"), rec("b", 5, "insert", "b1")]
    second = [rec("a", 101, "update", "a2"), rec("b", 6, "update", "b2")]   # b's offsets are lower than a's
    spark.createDataFrame(first, cs.RECORD_SCHEMA).coalesce(1).write.json(src)
    q_stream._run(spark, src, root, ckpt)
    base = ledger.write_base(spark, root, 0, work_path(spark, "base"))
    spark.createDataFrame(second, cs.RECORD_SCHEMA).coalesce(1).write.mode("append").json(src)
    q_stream._run(spark, src, root, ckpt)
    assert ledger.late_events(spark, root, base).count() == 0
    got = {r["order_id"]: r["status"] for r in ledger.state(spark, root, base=base).collect()}
    assert got == {"a": "a2", "b": "b2"}


def test_delete_keyed_by_database_id_is_resolved(spark):
    from changeledger.functions.cdc import resolve_delete_keys
    from changeledger.schemas import CHANGE_ROW
    changes = spark.createDataFrame(
        [(1, "ord-1", "insert", "m1", "created", 1.0, "USD", None),
         (2, "db-77", "delete", None, None, None, None, None)], CHANGE_ROW)
    ids = spark.createDataFrame([("db-77", "ord-1")], "_id string, order_id string")
    fixed = resolve_delete_keys(changes, ids)
    assert replay(fixed).count() == 0 and replay(changes).count() == 1


def test_replay_pre_aggregates_a_hot_key(spark):
    """A key holding a third of the log is combined map-side before the shuffle."""
    from changeledger.schemas import CHANGE_ROW
    hot = spark.range(30000).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("order_id"),
        F.lit("update").alias("op"), F.lit("m").alias("merchant_id"),
        F.col("id").cast("string").alias("status"), F.col("id").cast("double").alias("amount"),
        F.lit("USD").alias("currency"), F.lit(None).cast("timestamp_ntz").alias("event_ts"))
    out = replay(hot.repartition(8))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    row = out.where("order_id = 'hot'").first()
    assert row["status"] == "29997" and row["amount"] == 29997.0



def test_expiry_folds_only_the_fully_expired_prefix(spark):
    from changeledger.operators import history as h
    src, root, ckpt = (work_path(spark, n) for n in ("in", "ledger", "ckpt"))
    q_stream._land_records(q_stream._records(spark, SF), src, 5)
    q_stream._run(spark, src, root, ckpt, max_files=1)          # batches 0..4
    commits = ledger.commits(spark, root).withColumn("table_name", F.lit("t"))
    retention = spark.createDataFrame([("t", 0)], "table_name string, retention_days int")
    tags = spark.createDataFrame([("t", 2)], "table_name string, snapshot_id long")
    expired = h.expire_snapshots(commits, retention, tags, "2999-01-01 00:00:00")
    assert sorted(r[0] for r in expired.select("snapshot_id").collect()) == [0, 1, 3]
    base = work_path(spark, "base")
    assert ledger.fold_expired(spark, root, expired, base) == 1
    # the tagged snapshot 2 is still readable from base + tail
    want = {tuple(r) for r in ledger.state(spark, root, upto=2).collect()}
    assert {tuple(r) for r in ledger.state(spark, root, upto=2, base=base).collect()} == want


def test_orphan_delete_is_explicit_and_distributed(spark):
    from changeledger.operators import history as h
    root = work_path(spark, "orders-table")
    lay.write_sized(td.orders_src(spark, SF), f"{root}/data/s1", max_records=200)
    live = lay.compact_files(spark, f"{root}/data/s1", f"{root}/data", None, 1 << 29)
    live_paths = spark.read.parquet(live).select(F.col("_metadata.file_path").alias("path"))
    orphans = h.orphan_files(lay.file_stats(spark, f"{root}/data"), live_paths).cache()
    n = orphans.count()
    assert n > 1
    assert h.delete_files(orphans) == n                      # dry run: nothing removed
    assert lay.file_stats(spark, f"{root}/data").count() == n + live_paths.distinct().count()
    h.delete_files(orphans, dry_run=False)
    left = lay.file_stats(spark, f"{root}/data")
    assert left.join(orphans.select("path"), "path", "left_semi").count() == 0
    assert spark.read.parquet(live).count() == td.orders_src(spark, SF).count()


def test_bucketed_write_keeps_file_count_near_day_bucket_pairs(spark):
    path = work_path(spark, "bucketed")
    name = "bucket_files_" + path.rsplit("-", 1)[-1]
    log = td.cdc_flat(spark, SF)
    lay.write_days_bucketed(log, path, name)
    files = lay.file_stats(spark, path).count()
    pairs = log.select(F.to_date("event_ts").alias("d"),
                       F.pmod(F.hash("merchant_id"), F.lit(16)).alias("b")).distinct().count()
    tasks = lay.write_tasks(spark)
    assert files <= pairs + tasks            # each writer splits at most one pair with a neighbour
    assert spark.table(name).count() == log.count()


def test_partition_bounds_reach_the_scan(spark):
    from changeledger.functions.partitions import ts_range
    path = work_path(spark, "days")
    lay.write_days(td.cdc_flat(spark, SF), path)
    df = ts_range(spark.read.parquet(path), "2024-01-05 06:00:00", "2024-01-07 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    expected = td.cdc_flat(spark, SF).where(
        "event_ts >= timestamp_ntz'2024-01-05 06:00:00' AND event_ts < timestamp_ntz'2024-01-07 00:00:00'")
    assert df.count() == expected.count()


def test_erase_from_files_rewrites_without_keys(spark):
    from changeledger.operators.changes import erase_from_files
    path = work_path(spark, "days")
    log = td.cdc_flat(spark, SF)
    lay.write_days(log, path)
    erase = log.select("order_id").distinct().limit(3)
    keys = [r[0] for r in erase.collect()]
    new = erase_from_files(spark, path, erase, work_path(spark, "erased"), partition_col="event_date")
    after = spark.read.parquet(new)
    assert after.where(F.col("order_id").isin(keys)).count() == 0
    assert after.count() == log.where(~F.col("order_id").isin(keys)).count()
