"""Versions, tags, diffs and bases of a written ledger with late rows, rows without a time and deletes by database id."""

import random

import pytest
from pyspark.sql import functions as F

from changeledger.functions.cdc import cdc_project, parse_envelope
from changeledger.operators import history as h
from changeledger.operators.changes import replay
from changeledger.session import work_path
from changeledger.sources import ledger
from changeledger.streaming.cdc_stream import project_records, write_batch, write_commit


def document(seq, key, status, amount=None, time="2024-01-01T00:00:00.000000"):
    own = "db-" + key
    return seq, own, ('{"operationType":"update","documentKey":{"_id":"%s"},"fullDocument":{"_id":"%s","order_id":"%s","status":"%s"%s%s}}'
                      % (own, own, key, status, f',"amount":{amount}' if amount is not None else "", f',"event_ts":"{time}"' if time else ""))


def delete(seq, key):
    return seq, "db-" + key, '{"operationType":"delete","documentKey":{"_id":"db-%s"}}' % key


def written(spark, batches):
    root = work_path(spark, "ledger")
    for n, rows in enumerate(batches):
        records = spark.createDataFrame(rows, "offset long, key string, value string")
        write_commit(spark, root, n, write_batch(project_records(records), root, n))
    return root


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


BATCHES = [
    [document(1, "a", "new", 1.0), document(2, "b", "new", 2.0, None), document(5, "c", "new", 3.0)],
    [delete(6, "a"), document(8, "b", "paid"), delete(9, "z"), (10, "db-c", None)],
    [document(3, "b", "late", 9.0), document(7, "a", "late"), document(4, "z", "gone"), document(11, "c", "again")],
]


def test_versions_are_cut_by_batch(spark):
    root = written(spark, BATCHES)
    state = lambda v: {r["order_id"]: (r["status"], r["amount"]) for r in ledger.as_of_version(spark, root, v).collect()}
    assert state(0) == {"a": ("new", 1.0), "b": ("new", 2.0), "c": ("new", 3.0)}
    assert state(1) == {"b": ("paid", 2.0)}                 # the tombstone of c's database id counts too
    assert state(2) == {"a": ("late", None), "b": ("paid", 9.0), "c": ("again", None)}
    for v in range(3):
        assert rows(h.as_of_version(ledger.committed_log(spark, root), ledger.commits(spark, root), v)) == rows(ledger.state(spark, root, v))
    with pytest.raises(ValueError):
        ledger.as_of_version(spark, root, 7)
    assert ledger.as_of_timestamp(spark, root, "1999-01-01 00:00:00").count() == 0
    assert rows(ledger.as_of_timestamp(spark, root, "2999-01-01 00:00:00")) == rows(ledger.state(spark, root))


def test_tags_are_stored_and_move(spark):
    root = written(spark, BATCHES)
    ledger.tag(spark, root, [("first-load", "first"), ("report", "1")])
    ledger.tag(spark, root, [("report", "latest")])
    assert {(r["tag"], r["snapshot_id"]) for r in ledger.tags(spark, root).collect()} == {("first-load", 0), ("report", 2)}
    assert rows(ledger.as_of_tag(spark, root, "first-load")) == rows(ledger.state(spark, root, 0))
    with pytest.raises(ValueError):
        ledger.as_of_tag(spark, root, "none")
    with pytest.raises(ValueError):
        ledger.tag(spark, root, [("bad", "99")])


def test_diff_of_a_ledger(spark):
    root = written(spark, BATCHES)
    for a, b in ((0, 1), (1, 2), (0, 2), (2, 2)):
        full = h.snapshot_diff(ledger.state(spark, root, a), ledger.state(spark, root, b))
        assert rows(ledger.diff(spark, root, a, b)) == rows(full)
    plan = ledger.diff(spark, root, 0, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 3      # the fold, and the two of the id lookup at most


def test_base_and_tail_equal_the_whole_log(spark):
    rng = random.Random(5)
    events, live = [], "abcdef"
    for seq in range(60):
        key = rng.choice(live)
        events.append(delete(seq, key) if rng.random() < 0.3 else
                      document(seq, key, f"s{seq}", rng.choice([None, float(seq)]), rng.choice([None, "2024-01-02T00:00:00.000000"])))
    rng.shuffle(events)                      # rows come late by any distance
    root = written(spark, [events[i::4] for i in range(4)])
    want = rows(ledger.state(spark, root))
    by_hand = spark.createDataFrame([(s, v) for s, _, v in events], "seq long, value string")
    projected = cdc_project(parse_envelope(by_hand)).withColumn(
        "order_id", F.when(F.col("op") == "delete", F.substring("source_id", 4, 9)).otherwise(F.col("order_id")))
    assert want == rows(replay(projected))
    bases = [ledger.write_base(spark, root, cut, work_path(spark, "base")) for cut in range(3)]
    for base in bases:
        assert rows(ledger.state(spark, root, base=base)) == want
        assert rows(ledger.state(spark, root, upto=2, base=base)) == rows(ledger.state(spark, root, upto=2))
    longer = ledger.write_base(spark, root, 2, work_path(spark, "base"), base=bases[0])
    assert rows(ledger.state(spark, root, base=longer)) == want
    assert rows(ledger.state(spark, root, upto=2, base=longer)) == rows(ledger.state(spark, root, upto=2))


def test_fields_of_a_wrong_type_are_dead_letters(spark):
    events = ['{"operationType":"update","fullDocument":{"order_id":"a","amount":"12,50"},"documentKey":{"_id":"a"}}',
              '{"operationType":"update","fullDocument":{"order_id":"a","amount":12},"documentKey":{"_id":"a"}}',
              '{"operationType":"delete","documentKey":{"_id":"a"},"fullDocument":{"amount":"x"}}', '{bad']
    df = spark.createDataFrame(list(enumerate(events)), "seq long, value string")
    assert [r[0] for r in cdc_project(parse_envelope(df)).orderBy("seq").select("_reason").collect()] == ["wrong_type", None, None, "malformed"]


def test_diff_is_the_difference_of_the_states(spark):
    """Also when a delete by database id comes before the document that it removes."""
    late = [[document(1, "o1", "new", 1.0)], [delete(4, "o2"), document(5, "o3", "new", 3.0)], [document(2, "o2", "late", 2.0), document(6, "o1", "paid")],
            [delete(7, "o3"), document(3, "o1", "late", 9.0)], [document(8, "o3", "back", 8.0)]]
    for batches in (BATCHES, late):
        root = written(spark, batches)
        for lo in range(len(batches)):
            for hi in range(lo, len(batches)):
                want = h.snapshot_diff(ledger.state(spark, root, lo), ledger.state(spark, root, hi))
                assert rows(ledger.diff(spark, root, lo, hi)) == rows(want), (lo, hi)


def test_a_version_reads_its_folders_only(spark):
    root = written(spark, BATCHES)
    df = ledger.as_of_version(spark, root, 0)
    scans = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line and "merchant_id" in line]
    assert scans and all("PartitionFilters: [" in x and "batch_id" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)


def test_events_of_a_key_from_several_partitions(spark):
    """Order by clock, partition and offset: state, base with late rows, late events and diffs as a sequential fold gives them."""
    rng = random.Random(11)
    events = []
    for n in range(400):
        key, op = f"k{rng.randint(0, 15)}", rng.choice(["insert", "update", "update", "replace", "delete"])
        clock = f"2024-01-{1 + n // 40:02d}T00:{n % 40 // 3:02d}:00.000000"  # several events share a clock
        events.append((clock, rng.randint(0, 3), key, op, rng.choice([None, f"s{n}"]), rng.choice([None, float(n)])))
    offsets, records = [0] * 4, []
    for clock, part, key, op, status, amount in rng.sample(events, len(events)):  # offsets say nothing about the clock
        doc = {"order_id": key, "status": status, "amount": amount}
        body = ", ".join(f'"{k}": {("null" if v is None else v) if k == "amount" else ("null" if v is None else chr(34) + v + chr(34))}' for k, v in doc.items())
        full = "" if op == "delete" else f', "fullDocument": {{{body}}}'
        records.append((key, f'{{"operationType": "{op}", "documentKey": {{"_id": "{key}"}}, "clusterTime": "{clock}"{full}}}', part, offsets[part], clock, op, status, amount))
        offsets[part] += 1
    root, batches = work_path(spark, "ledger"), 4
    for n in range(batches):
        some = [r[:4] for k, r in enumerate(records) if k % batches == n]
        projected = project_records(spark.createDataFrame(some, "key string, value string, partition int, offset long"), order="cluster")
        assert projected.schema["seq"].dataType.fieldNames() == ["cluster_time", "partition", "offset"]
        write_commit(spark, root, n, write_batch(projected, root, n))

    def sequential(part):
        state = {}
        for key, _, _, _, _, op, status, amount in sorted(part, key=lambda r: (r[4], r[2], r[3])):
            if op == "delete":
                state.pop(key, None)
            else:
                old = state.get(key, (None, None))
                state[key] = (status if status is not None else old[0], amount if amount is not None else old[1])
        return state

    for upto in range(batches):
        got = {r.order_id: (r.status, r.amount) for r in ledger.state(spark, root, upto).collect()}
        assert got == sequential([r for k, r in enumerate(records) if k % batches <= upto])
    base = ledger.write_base(spark, root, 1, work_path(spark, "base"))
    assert rows(ledger.state(spark, root, base=base)) == rows(ledger.state(spark, root))
    marks = {}
    for k, r in enumerate(records):
        if k % batches <= 1:
            marks[r[0]] = max(marks.get(r[0], ()), (r[4], r[2], r[3]))
    late = [(r[0], r[3]) for k, r in enumerate(records) if k % batches > 1 and (r[4], r[2], r[3]) <= marks.get(r[0], ())]
    assert late and sorted((r.order_id, r.seq.offset) for r in ledger.late_events(spark, root, base).collect()) == sorted(late)
    assert rows(ledger.diff(spark, root, 0, 3)) == rows(h.snapshot_diff(ledger.state(spark, root, 0), ledger.state(spark, root, 3)))


def test_unknown_order(spark):
    with pytest.raises(ValueError):
        project_records(spark.createDataFrame([], "key string, value string, partition int, offset long"), order="time")
