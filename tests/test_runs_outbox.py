"""Run records in the commits, and an outbox that a repeated run doesn't fill twice."""

import pytest

from changeledger.session import work_path
from changeledger.sources import ledger
from changeledger.streaming import cdc_stream as cs

VALUE = '{"operationType":"update","documentKey":{"_id":"%s"},"fullDocument":{"order_id":"%s"}}'


def test_each_commit_names_its_files(spark):
    src, root = work_path(spark, "in"), work_path(spark, "ledger")
    for part in range(3):
        spark.createDataFrame([(f"k{i}", VALUE % (i, i) if i % 5 else "{bad", "t", 0, 100 * part + i) for i in range(1, 21)], cs.RECORD_SCHEMA).coalesce(1).write.mode("append").json(src)
    q = cs.start_ledger_stream(cs.file_source(spark, src, 1), root, work_path(spark, "ckpt"))
    q.awaitTermination()
    runs = sorted(ledger.runs(spark, root).collect(), key=lambda r: r.snapshot_id)
    assert len(runs) == 3 and {r.job for r in runs} == {"ledger"} and len({r.run_id for r in runs}) == 1 and runs[0].run_id
    assert [len(r.sources) for r in runs] == [1, 1, 1] and len({r.sources[0] for r in runs}) == 3 and all(src.removeprefix("file:") in r.sources[0] for r in runs)
    assert sum(r.records for r in runs) == 60 and sum(r.added_rows for r in runs) == 48  # dead letters are records too
    assert sorted((r.first_offset, r.last_offset) for r in runs) == [(1, 20), (101, 120), (201, 220)]
    assert ledger.commits(spark, root).columns == ["snapshot_id", "committed_at", "operation", "added_rows"]


def test_commits_without_a_record_are_read(spark):
    root = work_path(spark, "ledger")
    rows = cs.project_records(spark.createDataFrame([("k", VALUE % ("k", "k"), "t", 0, 1)], cs.RECORD_SCHEMA))
    cs.write_commit(spark, root, 0, cs.write_batch(rows, root, 0))
    assert [(r.job, r.sources) for r in ledger.runs(spark, root).collect()] == [(None, [])]


@pytest.mark.parametrize("rows", [[("a", "1", "t1"), ("a", "1", "t1"), ("b", "2", "t2")], [("x", "y", "t1")]])
def test_a_repeated_run_publishes_once(spark, rows):
    outbox = work_path(spark, "outbox")
    frame = lambda r: spark.createDataFrame(r, "key string, value string, topic string")
    first = sorted(map(tuple, cs.publish_once(frame(rows), outbox, "r1").collect()))
    again = sorted(map(tuple, cs.publish_once(frame(rows[::-1]), outbox, "r1").collect()))
    assert first == again and len({r[-2] if len(r[-2]) == 64 else r[-1] for r in first}) == len(rows)
    cs.publish_once(frame(rows[:1]), outbox, "r1")           # a run that has less the second time leaves nothing behind
    cs.publish_once(frame(rows), outbox, "r2")
    back = spark.read.schema("key string, event_id string, run string, topic string").json(outbox)
    assert back.where("run = 'r1'").count() == 1 and back.count() == 1 + len(rows) and back.select("event_id").distinct().count() == back.count()


def test_a_replayed_batch_keeps_its_commit_time(spark):
    root = work_path(spark, "ledger")
    rows = cs.project_records(spark.createDataFrame([("k", VALUE % ("k", "k"), "t", 0, 1)], cs.RECORD_SCHEMA))
    times = []
    for _ in range(2):
        cs.write_commit(spark, root, 0, cs.write_batch(rows, root, 0))
        times.append(ledger.commits(spark, root).first().committed_at)
    assert times[0] == times[1] and ledger.state(spark, root).count() == 1
