"""Diffs by digest tree, validity intervals and as-of joins against plain replays."""

import random

import pytest
from pyspark.sql import functions as F

from changeledger.operators import history as h
from changeledger.operators import intervals as iv
from changeledger.operators.changes import replay
from changeledger.session import work_path
from changeledger.sources import hashtree as ht

SCHEMA = "seq long, order_id string, op string, merchant_id string, status string, amount double"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def events(seed, n=400, keys=9, hot=0):
    rng = random.Random(seed)
    out = [(2 * i, f"k{rng.randint(0, keys)}", rng.choice(["insert", "update", "update", "replace", "delete"]), rng.choice([None, "m1", "m2"]),
            rng.choice([None, "a", "b"]), rng.choice([None, 1.0, 2.0])) for i in range(n)]
    out += [(2 * n + i, "hot", rng.choice(["update", "update", "delete"]), rng.choice([None, "m1"]), rng.choice([None, "a", "b"]), None) for i in range(hot)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("slice_rows", [3, 50, 100_000])
def test_every_version_is_cut_out_of_the_intervals(spark, slice_rows):
    log = spark.createDataFrame([*events(1, 250), (3, None, "update", "m", "s", 1.0), (5, "k1", "drop", "m9", None, None)], SCHEMA).repartition(3).cache()
    found = iv.validity(log, slice_rows=slice_rows).cache()
    assert found.columns == ["order_id", "merchant_id", "status", "amount", "valid_from", "valid_to"]
    for seq in (-1, 0, 7, 100, 101, 300, 498, 10_000):
        assert rows(iv.at_version(found, seq)) == rows(replay(log.where(F.col("seq") <= seq))), seq
    log.unpersist()
    by_key = {}
    for r in sorted(found.collect(), key=lambda r: (r.order_id, r.valid_from)):
        held = by_key.setdefault(r.order_id, [])
        if held:  # no overlap, and no border without a change
            assert held[-1].valid_to is not None and held[-1].valid_to <= r.valid_from
            assert held[-1].valid_to < r.valid_from or held[-1][1:4] != r[1:4]
        held.append(r)
    found.unpersist()


def test_slices_change_nothing_for_a_hot_key(spark):
    log = spark.createDataFrame(events(2, 60, hot=600), SCHEMA)
    assert rows(iv.validity(log, slice_rows=20)) == rows(iv.validity(log))


@pytest.mark.parametrize("slice_rows", [5, 100_000])
def test_as_of_join_against_brute_force(spark, slice_rows):
    log = spark.createDataFrame(events(3, 150, hot=100), SCHEMA)
    found = iv.validity(log)
    held = found.collect()
    rng = random.Random(4)
    facts = [(i, rng.choice(["hot", "k0", "k1", "k5", "unknown", None]), rng.choice([None, *range(-3, 420)]), "own") for i in range(500)]
    facts += [facts[0], facts[1]]
    df = spark.createDataFrame(facts, "id int, who string, at long, status string").repartition(4)
    got = iv.as_of_join(df, found, "who", "at", slice_rows=slice_rows)
    assert got.columns == ["id", "who", "at", "status", "merchant_id", "status_as_of", "amount"]
    want = []
    for i, who, at, own in facts:
        hit = [r for r in held if r.order_id == who and at is not None and r.valid_from <= at and (r.valid_to is None or at < r.valid_to)]
        assert len(hit) <= 1
        want.append((i, who, at, own, *(hit[0][1:4] if hit else (None, None, None))))
    assert rows(got) == sorted(want, key=repr)


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert iv.validity(empty).count() == 0
    facts = spark.createDataFrame([(1, "a", 5)], "id int, who string, at long")
    assert rows(iv.as_of_join(facts, iv.validity(empty), "who", "at")) == [(1, "a", 5, None, None, None)]


TABLE = "order_id string, status string, amount double, _rest map<string,string>"


def versions(spark):
    old = [(f"k{i}", "a", float(i), {"x": str(i)}) for i in range(3000)] + [(None, "n", 1.0, None)]
    new = [r for r in old if r[0] not in ("k7", "k8")]
    new = [(k, "b", a, m) if k == "k100" else (k, s, None, m) if k == "k200" else (k, s, a, m) for k, s, a, m in new] + [("new", "c", 1.0, None)]
    return [ht.write_version(spark.createDataFrame(v, TABLE).repartition(4), work_path(spark, "tree")) for v in (old, new)], old, new


def test_diff_by_tree(spark):
    (a, b), old, new = versions(spark)
    slots = ht.differing_slots(spark, a, b)
    assert 1 <= len(slots) <= 5
    plain = ["order_id", "status", "amount"]
    got = ht.diff(spark, a, b)
    assert {(r.order_id, r.change, r.changed_columns) for r in got.collect()} >= {("k7", "removed", None), ("k8", "removed", None), ("new", "added", None), ("k100", "changed", "status"), ("k200", "changed", "amount")}
    read = ht.read_version(spark, a, slots)
    assert read.count() <= 3001 * 5 // 128  # rows read fall with the share of slots that are equal
    assert "PartitionFilters: [isnotnull" in read._jdf.queryExecution().executedPlan().toString() or "_slot" in read._jdf.queryExecution().executedPlan().toString()
    assert rows(ht.read_version(spark, b).select(*plain)) == rows(spark.createDataFrame(new, TABLE).select(*plain))


def test_equal_versions_read_nothing(spark):
    some = spark.createDataFrame([(f"k{i}", i) for i in range(500)], "order_id string, n int")
    a, b = (ht.write_version(some.repartition(n), work_path(spark, "tree")) for n in (1, 7))
    assert ht.differing_slots(spark, a, b) == [] and ht.diff(spark, a, b).count() == 0
    empty = ht.write_version(some.limit(0), work_path(spark, "tree"))
    assert ht.diff(spark, empty, a).where("change = 'added'").count() == 500
    with pytest.raises(ValueError):
        ht.diff(spark, a, ht.write_version(some, work_path(spark, "tree"), bits=4))
    assert rows(ht.diff(spark, a, b)) == rows(h.snapshot_diff(some, some))


def test_tree_levels_add_up(spark):
    some = spark.createDataFrame([(f"k{i}", i) for i in range(700)], "order_id string, n int")
    a = ht.write_version(some, work_path(spark, "tree"))
    per = {r.level: r.n for r in spark.read.parquet(f"{a}/tree").groupBy("level").agg(F.sum("rows").alias("n")).collect()}
    assert per == {0: 700, 4: 700, 8: 700}
