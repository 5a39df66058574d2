"""Replay / merge meaning against a plain sequential MERGE fold."""

from hypothesis import given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from changeledger.operators import changes as ch
from changeledger.schemas import CHANGE_ROW

COLS = ["merchant_id", "status", "amount", "currency", "event_ts"]


def sequential_merge(events):
    """Apply events one at a time exactly like the reference MERGE does."""
    table = {}
    for seq, key, op, *vals in sorted(events, key=lambda e: e[0]):
        row = dict(zip(COLS, vals))
        if op == "delete":
            table.pop(key, None)
        elif op in ("insert", "update", "replace"):
            if key in table:
                table[key] = {c: (row[c] if row[c] is not None else table[key][c]) for c in COLS}
            else:
                table[key] = row
    return {k: tuple(v[c] for c in COLS) for k, v in table.items()}


def as_dict(df):
    return {r["order_id"]: tuple(r[c] for c in COLS) for r in df.collect()}


event = st.tuples(
    st.sampled_from(["k1", "k2", "k3"]),
    st.sampled_from(["insert", "update", "delete", "replace", "drop"]),
    st.sampled_from([None, "m1", "m2"]),
    st.sampled_from([None, "created", "refunded"]),
    st.sampled_from([None, 1.5, 2.25]),
)


def to_rows(evts):
    return [(i, k, op, m, s, a, None if a is None else "USD", None) for i, (k, op, m, s, a) in enumerate(evts)]


@settings(max_examples=25, deadline=None)
@given(st.lists(event, min_size=1, max_size=12))
def test_replay_equals_sequential_fold(spark, evts):
    rows = to_rows(evts)
    df = spark.createDataFrame(rows, CHANGE_ROW)
    assert as_dict(ch.replay(df)) == sequential_merge(rows)


@settings(max_examples=15, deadline=None)
@given(st.lists(event, min_size=1, max_size=10), st.integers(min_value=0, max_value=10))
def test_merge_of_batch_equals_full_replay(spark, evts, cut):
    rows = to_rows(evts)
    df = spark.createDataFrame(rows, CHANGE_ROW)
    state = ch.replay(df.where(F.col("seq") < cut))
    merged = ch.cdc_merge(state, df.where(F.col("seq") >= cut))
    assert as_dict(merged) == sequential_merge(rows)


def test_delete_then_insert_in_one_batch_does_not_leak(spark):
    state = spark.createDataFrame([("k1", "m1", "created", 5.0, "USD", None)],
                                  "order_id string, merchant_id string, status string, amount double, "
                                  "currency string, event_ts timestamp_ntz")
    batch = spark.createDataFrame([(1, "k1", "delete", None, None, None, None, None),
                                   (2, "k1", "insert", None, "approved", None, None, None)], CHANGE_ROW)
    out = as_dict(ch.cdc_merge(state, batch))
    assert out == {"k1": (None, "approved", None, None, None)}


def test_delete_of_unknown_key_is_a_no_op(spark):
    df = spark.createDataFrame([(1, "k9", "delete", None, None, None, None, None)], CHANGE_ROW)
    assert ch.replay(df).count() == 0


def test_compact_log_base_plus_tail_for_several_cuts(spark):
    from changeledger.sources import testdata as td
    log = td.cdc_flat(spark, "/root/testdata/sf0.001").cache()
    full = as_dict(ch.replay(log))
    hi = log.agg(F.max("seq")).first()[0]
    for s in (0, hi // 3, hi // 2, hi):
        base = ch.compact_log(log, s)
        assert as_dict(ch.replay(base.unionByName(log.where(F.col("seq") > s)))) == full


def test_tombstone_payload_becomes_delete(spark):
    from changeledger.functions.cdc import good_changes
    from changeledger.streaming.cdc_stream import project_records
    recs = spark.createDataFrame(
        [("ord-1", '{"operationType":"insert","fullDocument":{"order_id":"ord-1","status":"created"},'
                   '"clusterTime":"2024-01-01T00:00:00.000001"}', 0),
         ("ord-1", None, 1)], "key string, value string, offset long")
    rows = good_changes(project_records(recs)).orderBy("seq").collect()
    assert [r["op"] for r in rows] == ["insert", "delete"]
    assert ch.replay(good_changes(project_records(recs))).count() == 0


def test_diff_from_log_equals_diff_of_full_versions(spark):
    from changeledger.operators import history as h
    from changeledger.sources import testdata as td
    log = td.cdc_flat(spark, "/root/testdata/sf0.001")
    commits = h.commits_by_day(log).cache()
    log = h.with_batches(log, commits)
    for a, b in ((1, 5), (3, 20), (20, 3), (7, 7)):
        full = h.snapshot_diff(h.as_of_version(log, commits, a), h.as_of_version(log, commits, b))
        fast = h.diff_versions(log, commits, a, b)
        if a > b:   # diff_versions always diffs older → newer
            full = h.snapshot_diff(h.as_of_version(log, commits, b), h.as_of_version(log, commits, a))
        assert sorted(map(tuple, full.collect())) == sorted(map(tuple, fast.collect()))


def test_merge_equals_replay_of_the_whole_log(spark):
    from changeledger.sources import testdata as td
    log = td.cdc_flat(spark, "/root/testdata/sf0.001")
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    state = ch.replay(log.where(F.col("event_ts") < cut))
    merged = ch.cdc_merge(state, log.where(F.col("event_ts") >= cut))
    assert set(map(tuple, merged.collect())) == set(map(tuple, ch.replay(log).collect()))


PLANS = [{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"},
         {"spark.sql.autoBroadcastJoinThreshold": "10m"}]


def with_conf(spark, conf, run):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("conf", PLANS)
def test_upsert_keeps_null_and_repeated_target_keys(spark, conf):
    from changeledger.operators import merge as mg
    target = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", 5)], "order_id string, v int")
    source = spark.createDataFrame([("b", 6, 1), ("b", 7, 2), ("c", 8, 1), (None, 9, 1), (None, 9, 1)], "order_id string, v int, t int")
    got = with_conf(spark, conf, lambda: sorted(map(tuple, mg.snapshot_upsert(target, source, "order_id", ["t"]).collect()), key=str))
    assert got == sorted([(None, 1), (None, 2), (None, 9), (None, 9), ("a", 3), ("a", 4), ("b", 7), ("c", 8)], key=str)


@pytest.mark.parametrize("conf", PLANS)
def test_cdc_merge_keeps_null_and_repeated_state_keys(spark, conf):
    state = spark.createDataFrame([(None, "s", 1.0), (None, "s", 1.0), ("a", "s", 1.0), ("a", "t", 2.0), ("b", "s", 3.0), ("b", "u", 4.0),
                                   ("d", "s", 5.0), ("e", "s", 6.0)], "order_id string, status string, amount double")
    batch = spark.createDataFrame([(1, "a", "update", None, 9.0), (2, "b", "delete", None, None), (3, "c", "insert", "n", None),
                                   (4, "d", "delete", None, None), (5, "d", "insert", None, 7.0), (6, "x", "delete", None, None),
                                   (7, None, "insert", "z", 1.0), (8, "y", "insert", "k", 1.0), (9, "y", "delete", None, None)],
                                  "seq long, order_id string, op string, status string, amount double")
    got = with_conf(spark, conf, lambda: sorted(map(tuple, ch.cdc_merge(state, batch).collect()), key=str))
    assert got == sorted([(None, "s", 1.0), (None, "s", 1.0), ("a", "s", 9.0), ("a", "t", 9.0), ("c", "n", None), ("d", None, 7.0),
                          ("e", "s", 6.0)], key=str)


def test_no_plan_counts_a_limit_in_one_task(spark):
    from changeledger.operators import merge as mg
    target = spark.range(10).selectExpr("cast(id as string) order_id", "id v")
    df = mg.snapshot_upsert(target, target, "order_id", ["v"])
    assert "GlobalLimit" not in df._jdf.queryExecution().toString()


def test_refresh_of_the_null_merchant(spark):
    from changeledger.operators import aggregates as ag
    now = spark.createDataFrame([("m", 1.0), (None, 2.0), (None, 3.0)], "merchant_id string, amount double")
    stored = spark.createDataFrame([("m", 1.0, 1), (None, 1.0, 1)], "merchant_id string, sum_amount double, order_count long")
    touched = spark.createDataFrame([(None,)], "merchant_id string")
    got = sorted(map(tuple, ag.merchant_totals_refresh(stored, now, touched).collect()), key=str)
    assert got == sorted(map(tuple, ag.merchant_totals(now).collect()), key=str)
