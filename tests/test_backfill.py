"""Back-fill on literal documents: landing day differs from event day, rows move, repeat and are bad."""

import json

import pytest
from pyspark.sql import functions as F

from changeledger.operators import layout as lay
from changeledger.plans import jobs

COLUMNS = ["order_id", "status", "event_ts"]


def land(spark, root, dt, docs):
    path = f"{root}/dt={dt}"
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").coalesce(1).write.text(path)


def rows(spark, data):
    return spark.createDataFrame(data, "order_id string, status string, t string") \
        .select("order_id", "status", F.col("t").cast("timestamp_ntz").alias("event_ts"))


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "raw"), str(tmp_path / "main"), str(tmp_path / "staging")


def content(spark, main):
    spark.catalog.refreshByPath(main)
    return sorted((r.order_id, r.status, str(r.event_ts), str(r.event_date)) for r in spark.read.parquet(main).collect())


def doc(i, status, t):
    return {"order_id": i, "status": status, "event_ts": t}


def test_rows_of_other_keys_stay(spark, places):
    raw, main, staging = places
    lay.write_days(rows(spark, [("o1", "a", "2024-01-01 10:00:00"), ("o2", "a", "2024-01-01 11:00:00"), ("o9", "z", "2024-01-09 00:00:00")]), main)
    land(spark, raw, "2024-01-05", [doc("o2", "b", "2024-01-01 11:00:00"), doc("o3", "n", "2024-01-02 09:00:00"), doc("o4", "bad", "never")])
    land(spark, raw, "2024-01-06", [doc("o1", "other day", "2024-01-01 10:00:00")])
    assert jobs.backfill(spark, raw, main, staging, "2024-01-05", "2024-01-06", COLUMNS)
    want = [("o1", "a", "2024-01-01 10:00:00", "2024-01-01"), ("o2", "b", "2024-01-01 11:00:00", "2024-01-01"),
            ("o3", "n", "2024-01-02 09:00:00", "2024-01-02"), ("o9", "z", "2024-01-09 00:00:00", "2024-01-09")]
    assert content(spark, main) == want
    # a second run with the same staging folder changes nothing
    assert jobs.backfill(spark, raw, main, staging, "2024-01-05", "2024-01-06", COLUMNS)
    assert content(spark, main) == want
    dead = spark.read.parquet(f"{staging}/*/dead_letters")
    assert {(r.order_id, r._bad_event_ts) for r in dead.collect()} == {("o4", "never")}


def test_moved_rows_leave_their_old_day(spark, places):
    raw, main, staging = places
    lay.write_days(rows(spark, [("o1", "a", "2024-01-01 10:00:00"), ("o2", "a", "2024-01-02 11:00:00"), ("o3", "new", "2024-01-20 00:00:00")]), main)
    land(spark, raw, "2024-01-05", [doc("o1", "b", "2024-01-03 11:00:00"), doc("o1", "older", "2024-01-02 11:00:00"), doc("o3", "old", "2024-01-04 00:00:00")])
    assert jobs.backfill(spark, raw, main, staging, "2024-01-05", "2024-01-06", COLUMNS)
    assert content(spark, main) == [("o1", "b", "2024-01-03 11:00:00", "2024-01-03"), ("o2", "a", "2024-01-02 11:00:00", "2024-01-02"),
                                    ("o3", "new", "2024-01-20 00:00:00", "2024-01-20")]


def test_ingest_keeps_unreadable_documents_as_dead_letters(spark, places):
    raw, main, bad = places
    land(spark, raw, "2024-01-01", [doc("o1", "new", "2024-01-01 10:00:00"), doc("o2", "new", "no time")])
    target = spark.createDataFrame([], "order_id string, merchant_id string, status string, amount double, currency string, "
                                       "event_ts timestamp_ntz, ingestion_ts timestamp_ntz, _rest map<string,string>")
    for _ in range(2):
        out = jobs.ingest_batch(spark, raw, target, "2024-01-01", "2024-01-02 00:00:00", dead_letters=bad)
        assert [r.order_id for r in out.collect()] == ["o1"]
    assert [(r.order_id, r._bad_event_ts) for r in spark.read.parquet(bad).collect()] == [("o2", "no time")]
