"""Landed days into the stored table: missing days, reruns, gates, dead letters; back-fills that meet changes of main."""

import pytest
from pyspark.sql import functions as F

from changeledger.plans import jobs
from changeledger.session import work_path
from changeledger.sources import raw as rw
from changeledger.sources.daytable import DayTable, Rejected

COLUMNS = "order_id string, merchant_id string, status string, amount double, currency string, event_ts timestamp_ntz, ingestion_ts timestamp_ntz, _rest map<string,string>"


def table_of(spark):
    table = DayTable(spark, work_path(spark, "orders"))
    table.create(spark.sql("SELECT 'o1' order_id, 'm1' merchant_id, 'created' status, 5.0D amount, 'USD' currency, timestamp_ntz'2024-01-01 10:00:00' event_ts, "
                           "timestamp_ntz'2024-01-02 00:00:00' ingestion_ts, map('a', '1') _rest").select(*[c.split()[0] for c in COLUMNS.split(", ")]))
    return table


def docs(spark, *rows):
    return spark.createDataFrame(rows, "order_id string, merchant_id string, status string, amount double, currency string, event_ts string, note string")


def orders(table, **at):
    return {r.order_id: (r.status, r.amount, r._rest) for r in table.read(**at).collect()}


def test_a_day_is_ingested_once_and_whole(spark):
    root, table, bad = work_path(spark, "raw"), table_of(spark), work_path(spark, "bad")
    rw.raw_land_run(docs(spark, ("gone", "m", "created", 1.0, "USD", "2024-01-01T00:00:00", None)), root, "2024-01-05")
    day = docs(spark, ("o1", "m1", "approved", 6.0, "USD", "2024-01-03T00:00:00", "moved"), ("o2", "m2", "created", 7.0, "USD", "2024-01-01T11:00:00", None),
               ("o2", "m2", "stale", 7.0, "USD", "2024-01-01T09:00:00", None), ("o3", "m3", "created", 8.0, "USD", "no time", None))
    rw.raw_land_run(day, root, "2024-01-05")  # the run again: its folder is replaced
    with pytest.raises(rw.MissingDay):
        jobs.ingest_day(spark, root, table, "2024-01-06")
    before = orders(table)
    for _ in range(2):
        jobs.ingest_day(spark, root, table, "2024-01-05", "2024-01-05 00:00:00", bad)
        got = orders(table)
        assert {k: v[:2] for k, v in got.items()} == {"o1": ("approved", 6.0), "o2": ("created", 7.0)} and got["o1"][2] == {"note": "moved"}
    assert orders(table, number=1) == before
    assert spark.read.parquet(bad).count() == 1
    assert set(table.version().days) == {"2024-01-01", "2024-01-03"}


def test_the_gate_keeps_a_bad_day_out(spark):
    root, table = work_path(spark, "raw"), table_of(spark)
    rw.raw_land_run(docs(spark, *[(f"n{i}", "m", None, 1.0, "USD", "2024-01-03T00:00:00", None) for i in range(5)]), root, "2024-01-05")
    with pytest.raises(Rejected, match="null_rate:status"):
        jobs.ingest_day(spark, root, table, "2024-01-05")
    assert table.head() == 1 and set(orders(table)) == {"o1"}


def test_backfill_merges_with_what_main_gained(spark, monkeypatch):
    root, table = work_path(spark, "raw"), table_of(spark)
    columns = ["order_id", "merchant_id", "status", "amount", "currency", "event_ts", "ingestion_ts", "_rest"]
    raw = docs(spark, ("o1", "m1", "older", 1.0, "USD", "2023-12-30T00:00:00", None), ("b1", "m1", "created", 2.0, "USD", "2024-01-02T00:00:00", None)) \
        .withColumn("ingestion_ts", F.lit("2024-01-09T00:00:00")).drop("note").withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))
    rw.raw_land_run(raw.withColumn("_rest", F.lit(None).cast("map<string,string>")), root, "2024-01-05")
    upsert, seen = DayTable.upsert, []

    def with_a_change_of_main(self, source, branch="main", check=None):
        out = upsert(self, source, branch, check)
        if branch != "main" and not seen:  # main goes on while the branch is built
            seen.append(branch)
            upsert(self, table.read().drop("event_date").withColumn("status", F.lit("refunded")))
        return out

    monkeypatch.setattr(DayTable, "upsert", with_a_change_of_main)
    simple = [c for c in columns if c not in ("_rest", "ingestion_ts")]
    small = DayTable(spark, work_path(spark, "small"))
    small.create(table.read().select(*simple))
    table = small
    assert jobs.backfill_days(spark, root, table, "2024-01-05", "2024-01-06", simple) is not None
    got = {r.order_id: (r.status, r.amount) for r in table.read().collect()}
    assert got == {"o1": ("refunded", 5.0), "b1": ("created", 2.0)}  # main's newer row stays, its change too
    assert seen and table.versions().where(F.col("branch") == seen[0]).count() == 2
