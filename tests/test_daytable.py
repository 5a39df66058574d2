"""The stored table of days: pointers, gates, branches with a brute-force three-way merge, retention."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from changeledger.operators import branches as br
from changeledger.operators import quality as qc
from changeledger.session import work_path
from changeledger.sources.daytable import DayTable, Rejected

SCHEMA = "order_id string, status string, amount double, event_ts timestamp_ntz, _rest map<string,string>"


def row(key, status, amount, day=1, rest=None):
    return key, status, amount, None if day is None else dt.datetime(2024, 1, day, 3), rest


def table_of(spark, rows, name="table"):
    table = DayTable(spark, work_path(spark, name))
    table.create(spark.createDataFrame(rows, SCHEMA))
    return table


def content(df):
    return sorted(((r.order_id, r.status, r.amount, r.event_ts, tuple(sorted((r._rest or {}).items())) if r._rest is not None else None) for r in df.collect()), key=repr)


def plain(rows):
    return sorted(((k, s, a, t, None if m is None else tuple(sorted(m.items()))) for k, s, a, t, m in rows), key=repr)


def brute_merge(base, main, branch, prefer=None):
    """Rows of unique keys → (merged rows, {(key, kind, columns)})."""
    sides = [{r[0]: r for r in rows} for rows in (base, main, branch)]
    names = ["status", "amount", "event_ts", "_rest"]
    merged, bad = [], set()
    for key in set().union(*sides):
        b, m, r = (s.get(key) for s in sides)
        kind, columns, out = None, None, None
        if b and m and r:
            clash = [n for n, x, y, z in zip(names, b[1:], m[1:], r[1:]) if y != x and z != x and y != z]
            kind, columns = ("update/update", ",".join(clash)) if clash else (None, None)
            out = (key, *(z if z != x else y for x, y, z in zip(b[1:], m[1:], r[1:])))
        elif b and m and m != b:
            kind = "update/delete"
        elif b and r and r != b:
            kind = "delete/update"
        elif not b and m and r:
            clash = [n for n, y, z in zip(names, m[1:], r[1:]) if y != z]
            kind, columns, out = ("add/add", ",".join(clash), None) if clash else (None, None, m)
        elif not b:
            out = m or r
        if kind:
            bad.add((key, kind, columns))
            out = r if prefer == "branch" else m
        if out:
            merged.append(out)
    return merged, bad


def random_versions(seed, n=120):
    rng = random.Random(seed)

    def some(key):
        return row(key, rng.choice(["a", "b", None]), rng.choice([1.0, 2.0, None, float("nan") if seed == 3 else 5.0]), rng.choice([1, 2, 3, None]), rng.choice([None, {}, {"x": "1", "y": "2"}, {"y": "2", "x": "1"}]))

    base = [some(f"k{i}") for i in range(n) if rng.random() < 0.8]

    def changed(rows, salt):
        out = []
        for r in rows:
            roll = rng.random()
            if roll < 0.1:
                continue
            out.append(some(r[0]) if roll < 0.25 else (r[0], rng.choice(["a", "c"]), *r[2:]) if roll < 0.4 else r)
        return out + [some(f"new{i}") for i in range(12) if rng.random() < 0.5] + [some(f"{salt}{i}") for i in range(4)]

    return base, changed(base, "m"), changed(base, "r")


@pytest.mark.parametrize("seed", [1, 2])
def test_three_way_merge_against_brute_force(spark, seed):
    versions = random_versions(seed, 500)
    base, main, branch = (spark.createDataFrame(v, SCHEMA).repartition(3) for v in versions)
    compared = br.compare(base, main, branch)
    for prefer in (None, "main", "branch"):
        want, bad = brute_merge(*versions, prefer)
        assert content(br.merged_rows(compared, main, prefer=prefer)) == plain(want)
        assert {(r.order_id, r.kind, r.columns) for r in br.conflicts(compared).collect()} == bad
    assert {"update/update", "update/delete", "delete/update", "add/add"} == {k for _, k, _ in bad}
    with pytest.raises(ValueError):
        br.merged_rows(compared, main, prefer="theirs")


def test_rows_that_no_key_tells_apart(spark):
    """Repeated keys and rows without a key stay as main has them; a change of theirs is a conflict."""
    same = [row("d", "a", 1.0), row("d", "b", 2.0), row(None, "n", 1.0), row(None, "n", 1.0), row("u", "x", 1.0)]
    df = lambda rows: spark.createDataFrame(rows, SCHEMA)
    compared = br.compare(df(same), df(same), df([*same[:-1], row("u", "y", 1.0)]))
    assert br.conflicts(compared).count() == 0
    assert content(br.merged_rows(compared, df(same))) == plain([*same[:-1], row("u", "y", 1.0)])
    other = br.compare(df(same), df(same), df(same[1:3]))
    assert {(r.order_id, r.kind) for r in br.conflicts(other).collect()} == {("d", "repeated_key"), (None, "no_key")}
    assert content(br.merged_rows(other, df(same))) == plain(same[:-1])


def test_one_shuffle_of_the_sides(spark):
    rows = [spark.createDataFrame([row("a", "b", 1.0)], SCHEMA)] * 3
    plan = br.merged_rows(br.compare(*rows), rows[1])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 2  # the comparison, and once more for the keys that can't be compared


@pytest.mark.parametrize("seed", [5, 6])
def test_merge_of_stored_branches(spark, seed):
    base, main, branch = random_versions(seed, 60)
    table = table_of(spark, base)
    first = table.head()
    table.branch("dev/x")
    every = set(table.version().days)
    df = lambda rows: spark.createDataFrame(rows, SCHEMA)
    table.replace_days(df(main), every)
    table.replace_days(df(branch), every, "dev/x")
    want, bad = brute_merge(base, main, branch)
    assert bad and table.merge("dev/x") is None
    assert content(table.read()) == plain(main)             # blocked: nothing changed
    assert {(r.order_id, r.kind, r.columns) for r in table.conflicts("dev/x").collect()} == bad
    merged = table.merge("dev/x", prefer="branch")
    assert content(table.read()) == plain(brute_merge(base, main, branch, "branch")[0])
    assert table.version(merged).parents == (merged - 2, merged - 1)
    assert table.conflicts("dev/x").count() == 0            # the branch's head is now what both come from
    assert content(table.read(first)) == plain(base)        # old versions stay


def test_days_that_did_not_change_are_not_written_or_read(spark):
    table = table_of(spark, [row(f"k{d}", "a", 1.0, d) for d in range(1, 21)])
    before = table.version()
    table.upsert(spark.createDataFrame([row("k3", "b", 2.0, 3), row("k4", "b", 2.0, 5)], SCHEMA))  # k4 moves from day 4 to 5
    after = table.version()
    moved = {d for d in before.days if after.days.get(d) != before.days[d]}
    assert moved == {"2024-01-03", "2024-01-04", "2024-01-05"} and "2024-01-04" not in after.days
    assert table.read(days={"2024-01-03"}).count() == 1
    table.branch("b")
    table.upsert(spark.createDataFrame([row("k9", "c", 1.0, 9)], SCHEMA), "b")
    _, days, _, _ = table.compared("b")
    assert days == {"2024-01-09"}
    assert table.merge("b") is not None and table.read().where("status = 'c'").count() == 1


def test_gate_keeps_bad_rows_out(spark):
    table = table_of(spark, [row("a", "x", 1.0), row(None, "n", 1.0, None)])

    def gate(before, staged):
        return qc.quality_report(before, staged, ["order_id"], ["amount"], max_change=float("inf"), max_null_rate=0.0, materialize=False)

    with pytest.raises(Rejected, match="null_rate:amount"):
        table.upsert(spark.createDataFrame([row("b", "x", None)], SCHEMA), check=gate)
    assert content(table.read()) == plain([row("a", "x", 1.0), row(None, "n", 1.0, None)]) and table.head() == 1
    assert table.upsert(spark.createDataFrame([row("b", "x", 2.0)], SCHEMA), check=gate) == 2


def test_readers_keep_their_version_and_a_second_writer_fails(spark, monkeypatch):
    table = table_of(spark, [row("a", "x", 1.0)])
    reading = table.read()
    other = DayTable(spark, table.root)
    publish, seen = other._publish, []

    def meanwhile(*args):
        seen.append(content(table.read()))  # staged, not yet published
        table.upsert(spark.createDataFrame([row("a", "first", 2.0)], SCHEMA))
        return publish(*args)

    monkeypatch.setattr(other, "_publish", meanwhile)
    with pytest.raises(RuntimeError, match="moved on"):
        other.upsert(spark.createDataFrame([row("a", "second", 3.0)], SCHEMA))
    assert seen == [plain([row("a", "x", 1.0)])] == [content(reading)]
    assert content(table.read()) == plain([row("a", "first", 2.0)])


def test_expiry_removes_what_nothing_points_to(spark):
    table = table_of(spark, [row("a", "x", 1.0, 1), row("b", "x", 1.0, 2)])
    table.branch("dev")
    for n in range(3):
        table.upsert(spark.createDataFrame([row("a", f"s{n}", 1.0, 1)], SCHEMA))
    table.upsert(spark.createDataFrame([row("b", "dev", 1.0, 2)], SCHEMA), "dev")
    tagged = 4
    kept = {r[0] for r in table.keep("2999-01-01 00:00:00", 7, [tagged]).collect()}
    assert kept == {1, tagged, 5, 6}  # where the branches part, the tag, both heads
    listed = table.expire("2999-01-01 00:00:00", 7, [tagged], dry_run=True).count()
    assert listed and table.versions().count() == 6
    assert table.expire("2999-01-01 00:00:00", 7, [tagged]).count() == listed
    assert {r.version for r in table.versions().collect()} == kept
    assert content(table.read(tagged)) == plain([row("a", "s1", 1.0, 1), row("b", "x", 1.0, 2)])
    folders = {f for n in kept for f in table.version(n).days.values()}
    data = table.root.removeprefix("file:") + "/data"
    files = {os.path.relpath(d, data) for d, _, names in os.walk(data) if any(n.endswith(".parquet") for n in names)}
    assert files == folders
    assert table.merge("dev") is not None
    assert table.expire("2024-01-01 00:00:00", 7).count() == 0  # all are young
    assert content(table.read()) == plain([row("a", "s2", 1.0, 1), row("b", "dev", 1.0, 2)])


def test_errors_and_empty_tables(spark):
    empty = table_of(spark, [])
    assert empty.read().count() == 0 and empty.read().columns[-1] == "event_date"
    empty.upsert(spark.createDataFrame([row("a", "x", 1.0, None)], SCHEMA))
    assert content(empty.read()) == plain([row("a", "x", 1.0, None)])
    empty.replace_days(spark.createDataFrame([], SCHEMA), set(empty.version().days))
    assert empty.read().count() == 0
    with pytest.raises(ValueError, match="holds a table"):
        empty.create(spark.createDataFrame([], SCHEMA))
    with pytest.raises(ValueError, match="no branch"):
        empty.read(branch="none")
    with pytest.raises(ValueError, match="no version"):
        empty.read(99)
    empty.branch("b")
    with pytest.raises(ValueError, match="exists"):
        empty.branch("b")


def test_a_filter_on_the_day_prunes_folders(spark):
    table = table_of(spark, [row(f"k{d}", "a", 1.0, d) for d in range(1, 11)])
    df = table.read().where(F.col("event_date") == "2024-01-03")
    assert "PartitionFilters: [isnotnull(event_date" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 1


def names(table, version):
    """Data files of each day of a version."""
    v, data = table.version(version), table.root.removeprefix("file:") + "/data"
    return {d: sorted(f for f in os.listdir(f"{data}/{folder}") if f.endswith(".parquet")) for d, folder in v.days.items()}


def test_compaction_rewrites_days_of_small_files_only(spark):
    rng = random.Random(2)
    many = [row(f"k{i}", rng.choice("abc"), float(i), rng.choice([1, 2])) for i in range(400)]
    table = table_of(spark, [*many, row("one", "x", 1.0, 3), row(None, "n", 1.0, None)])
    before, old = names(table, 1), table.head()
    assert len(before["2024-01-01"]) > 2 and len(before["2024-01-03"]) == 1
    flagged = {r.day for r in table.file_groups(1 << 20).where("compact").collect()}
    assert flagged == {"2024-01-01", "2024-01-02"}
    new = table.compact(1 << 20)
    after = names(table, new)
    assert len(after["2024-01-01"]) == len(after["2024-01-02"]) == 1
    assert after["2024-01-03"] == before["2024-01-03"] and table.version(new).days["2024-01-03"] == table.version(old).days["2024-01-03"]
    assert content(table.read(new)) == content(table.read(old))
    assert table.compact(1 << 20) is None and table.head() == new  # nothing left to do
    sizes = sum(r.bytes for r in table.file_groups(1 << 20).where("day = '2024-01-01'").collect())
    smaller = table.compact(-(-sizes // 3), min_files=1, small_ratio=4.0)
    assert 2 <= len(names(table, smaller)["2024-01-01"]) <= 3 + 1 and content(table.read(smaller)) == content(table.read(old))


def test_maintenance_freezes_tags_and_expires_the_rest(spark):
    table = table_of(spark, [row(f"k{i}", "a", 1.0, 1) for i in range(50)])
    for n in range(3):
        table.upsert(spark.createDataFrame([row(f"k{n}", "b", 2.0, 1)], SCHEMA))
    report = {r.step: r.value for r in table.maintain("t", 1 << 20, 7, [("first", "first")], "2999-01-01 00:00:00").collect()}
    assert report["tags"] == 1 and report["versions_kept"] == 2 and report["rows"] == 50 and report["files_removed"] > 0 and report["compacted_days"] == 1
    assert {r.tag: r.snapshot_id for r in table.tags().collect()} == {"first": 1}
    assert table.read(1).where("status = 'b'").count() == 0 and table.read().where("status = 'b'").count() == 3
    assert table.maintain("t", 1 << 20, 7, [], "2999-01-01 00:00:00").where("step = 'files_removed'").first().value == 0


def test_erasure_leaves_no_file_with_the_key(spark):
    table = table_of(spark, [row(f"k{i}", "a", 1.0, 1 + i % 4) for i in range(40)] + [row(None, "n", 1.0, 1)])
    table.branch("dev")
    table.upsert(spark.createDataFrame([row("k1", "b", 2.0, 2)], SCHEMA))
    table.upsert(spark.createDataFrame([row("k2", "c", 2.0, 3)], SCHEMA), "dev")
    table.tag([("first", "first")])
    untouched = table.version().days["2024-01-04"]
    assert table.erase(spark.createDataFrame([("k1",), ("k2",), ("k2",), ("none",), (None,)], "order_id string")) == 4
    every = spark.read.option("recursiveFileLookup", "true").parquet(f"{table.root}/data")
    assert every.where("order_id in ('k1', 'k2')").count() == 0
    assert table.read().count() == table.read(branch="dev").count() == 39
    assert table.tags().count() == 0 and table.versions().count() == 2 and table.version().days["2024-01-04"] == untouched
