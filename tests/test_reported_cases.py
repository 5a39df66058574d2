"""Cases that a review found wrong: times, deletes, broker keys, orphan paths, old versions, snapshot ids, session."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from changeledger.functions.cdc import cdc_project, normalize_event_ts, parse_envelope, to_ts
from changeledger.functions.flatten import flatten
from changeledger.operators import history as h
from changeledger.operators import layout as lay
from changeledger.streaming.cdc_stream import project_records, write_batch


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_times_with_zones_become_utc(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [("2024-01-05T10:00:00+05:00",), ("2024-01-05T10:00:00Z",), ("2024-01-05 10:00:00",), ("2024-01-05",),
                ("1704448800123",), ("no time",), (None,)]
        got = [r[0] for r in spark.createDataFrame(rows, "t string").select(to_ts(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    day = dt.datetime(2024, 1, 5)
    assert got == [day.replace(hour=5), day.replace(hour=10), day.replace(hour=10), day, dt.datetime(2024, 1, 5, 10, 0, 0, 123000), None, None]


def test_extended_json_dates(spark):
    docs = ['{"order_id":"a","event_ts":{"$date":{"$numberLong":"1704448800123"}}}']
    flat = normalize_event_ts(flatten(spark.read.json(spark.sparkContext.parallelize(docs))))
    assert flat.select("order_id", "event_ts").first() == ("a", dt.datetime(2024, 1, 5, 10, 0, 0, 123000))
    docs = ['{"order_id":"a","event_ts":{"$date":1704448800123}}']
    flat = normalize_event_ts(flatten(spark.read.json(spark.sparkContext.parallelize(docs))))
    assert flat.select("event_ts").first()[0] == dt.datetime(2024, 1, 5, 10, 0, 0, 123000)


def test_a_delete_needs_no_readable_time(spark):
    events = ['{"operationType":"delete","documentKey":{"_id":"a"},"clusterTime":"not a time"}',
              '{"operationType":"update","documentKey":{"_id":"a"},"fullDocument":{"order_id":"a","event_ts":"not a time"}}']
    df = spark.createDataFrame(list(enumerate(events)), "seq long, value string")
    assert [r[0] for r in cdc_project(parse_envelope(df)).orderBy("seq").select("_reason").collect()] == [None, "bad_timestamp"]


def test_tombstones_of_a_binary_key(spark):
    df = spark.createDataFrame([(bytearray(b"o1"), None, 7)], "key binary, value binary, offset long")
    r = project_records(df.select("key", F.col("value").cast("string").alias("value"), "offset")).first()
    assert (r.order_id, r.op, r._reason) == ("o1", "delete", None)


def test_a_replayed_batch_replaces_both_lanes(spark, tmp_path):
    bad = spark.createDataFrame([(1, "x", "r")], "seq long, _payload string, _reason string")
    good = bad.withColumn("_reason", F.lit(None).cast("string"))
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_batch(bad, str(tmp_path), 0)
        write_batch(good, str(tmp_path), 0)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert [r["_lane"] for r in spark.read.parquet(f"{tmp_path}/log").collect()] == ["ok"]


def test_live_files_under_encoded_folders_are_no_orphans(spark, tmp_path):
    spark.createDataFrame([(1, "10:30"), (2, "a b+c%")], "v int, h string").write.mode("overwrite").partitionBy("h").parquet(str(tmp_path))
    live = spark.read.parquet(str(tmp_path)).select(F.col("_metadata.file_path").alias("path"))
    files = lay.file_stats(spark, str(tmp_path))
    assert files.count() == 2 and h.orphan_files(files, live).count() == 0
    assert h.orphan_files(files, live.limit(0)).count() == 2
    assert h.orphan_files(files, live.limit(0), older_than="2000-01-01 00:00:00").count() == 0


def test_changes_without_a_time_shift_no_snapshot(spark):
    log = spark.createDataFrame([(1, None), (2, "2024-01-01 10:00:00"), (3, "2024-01-02 10:00:00")], "seq long, t string") \
        .select("seq", F.col("t").cast("timestamp_ntz").alias("event_ts"))
    assert [(r.snapshot_id, str(r.committed_at)) for r in h.commits_by_day(log).orderBy("snapshot_id").collect()] == \
        [(1, "2024-01-02 00:00:00"), (2, "2024-01-03 00:00:00")]


def test_days_are_replaced_whole_in_a_dynamic_session(spark, tmp_path):
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = lambda d: spark.createDataFrame([(1, d)], "v int, t string").select("v", F.col("t").cast("timestamp_ntz").alias("event_ts"))
    try:
        lay.write_days(rows("2024-01-01 10:00:00"), str(tmp_path))
        lay.write_days(rows("2024-01-02 10:00:00"), str(tmp_path))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert spark.read.parquet(str(tmp_path)).count() == 1
