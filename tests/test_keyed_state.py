"""The stream's keyed state ends where replaying the log ends, whatever the order, number and restarts of batches."""

import json
import random

import pytest

from changeledger.operators.changes import replay
from changeledger.functions.cdc import good_changes
from changeledger.session import work_path
from changeledger.streaming import cdc_stream as cs
from changeledger.streaming import keyed_state as ks


def records(seed, n=300):
    rng = random.Random(seed)
    out = []
    for offset in range(n):
        key, op = f"k{rng.randint(0, 12)}", rng.choice(["insert", "update", "update", "replace", "delete"])
        doc = {"order_id": key, "status": rng.choice([None, f"s{offset}"]), "amount": rng.choice([None, float(offset)]), "event_ts": "2024-01-01T00:00:00"}
        body = {"operationType": op, "documentKey": {"_id": key}, "clusterTime": f"2024-01-{1 + (offset * 7) % 28:02d}T00:00:00"}
        out.append((key, json.dumps(body if op == "delete" else body | {"fullDocument": doc}), "t", offset % 3, offset))
    out += [("k1", None, "t", 0, n), ("k2", "{bad", "t", 0, n + 1), (None, '{"operationType":"update"}', "t", 0, n + 2)]
    rng.shuffle(out)
    return out


def run(spark, src, root, ckpt, order, files):
    q = ks.start_state_stream(cs.file_source(spark, src, files), root, ckpt, order=order)
    q.awaitTermination()
    assert q.exception() is None


@pytest.mark.parametrize("order", ["offset", "cluster"])
def test_state_equals_replay_after_restart(spark, order):
    rows = records(3)
    src, root, ckpt = (work_path(spark, n) for n in ("in", "state", "ckpt"))
    frame = lambda part: spark.createDataFrame(part, cs.RECORD_SCHEMA)
    for part in (rows[:200], rows[200:]):
        frame(part).repartition(2).write.mode("append").json(src)
        run(spark, src, root, ckpt, order, 1)
    want = replay(good_changes(cs.project_records(frame(rows), order=order)))
    got = ks.current_rows(spark, root)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    gone = {r[0] for r in ks.current_rows(spark, root, deleted=True).collect()}
    assert gone == {f"k{i}" for i in range(13)} - {r.order_id for r in want.collect()}
    batches = {r[0] for r in spark.read.parquet(f"{root}/rows").select("batch_id").distinct().collect()}
    assert len(batches) >= 4
    run(spark, src, root, ckpt, order, 1)  # nothing new: no batch
    assert {r[0] for r in spark.read.parquet(f"{root}/rows").select("batch_id").distinct().collect()} == batches
    assert ks.compact_rows(spark, root, max(batches)) == len(batches)
    assert sorted(map(tuple, ks.current_rows(spark, root).collect())) == sorted(map(tuple, want.collect()))


def test_dead_letters(spark):
    src, root = work_path(spark, "in"), work_path(spark, "state")
    spark.createDataFrame(records(5, 20), cs.RECORD_SCHEMA).write.json(src)
    for _ in range(2):
        q = ks.start_dead_letter_stream(cs.file_source(spark, src), root, f"{root}/ckpt")
        q.awaitTermination()
    assert sorted(r.reason for r in spark.read.parquet(f"{root}/dead_letters").collect()) == ["malformed", "null_key"]


@pytest.mark.parametrize("order", ["offset", "cluster"])
def test_events_are_folded_before_the_shuffle(spark, order):
    # the state takes a row of each key from each task, not a row of each event, and no row goes through Python
    rows = [(f"k{i % 3}", json.dumps({"operationType": "update", "fullDocument": {"order_id": f"k{i % 3}", "amount": float(i)},
                                      "clusterTime": "2024-01-01T00:00:00"}), "t", 0, i) for i in range(3000)]
    src, root, ckpt = (work_path(spark, n) for n in ("in", "state", "ckpt"))
    spark.createDataFrame(rows, cs.RECORD_SCHEMA).repartition(2).write.json(src)
    q = ks.start_state_stream(cs.file_source(spark, src), root, ckpt, order=order)
    q.awaitTermination()
    assert q.exception() is None
    plan = q._jsq.explainInternal(False)
    below = plan[plan.index("Exchange hashpartitioning(order_id"):]
    assert "partial_max_by" in below
    assert "Python" not in plan and "PySpark" not in plan
    assert {(r.order_id, r.amount) for r in ks.current_rows(spark, root).collect()} == {("k0", 2997.0), ("k1", 2998.0), ("k2", 2999.0)}
    assert {r[0] for r in spark.read.parquet(f"{root}/rows").select("_events").collect()} == {1000}
