"""Totals refreshed by signed changes equal totals counted anew: moved merchants, deletes, null amounts, late rows, reruns."""

import random

import pytest
from pyspark.sql import functions as F

from changeledger.operators import aggregates as agg
from changeledger.session import work_path
from changeledger.sources import ledger
from changeledger.sources.daytable import DayTable
from changeledger.streaming.cdc_stream import project_records, write_batch, write_commit


def event(rng, seq):
    key, op = f"k{rng.randint(0, 25)}", rng.choice(["insert", "update", "update", "replace", "delete"])
    if op == "delete":
        return seq, "db-" + key, '{"operationType":"delete","documentKey":{"_id":"db-%s"}}' % key
    fields = [f'"merchant_id":"m{rng.randint(0, 5)}"'] * (rng.random() < 0.7) + [f'"amount":{rng.randint(-500, 9999) / 100}'] * (rng.random() < 0.7)
    return seq, "db-" + key, '{"operationType":"%s","documentKey":{"_id":"db-%s"},"fullDocument":{"_id":"db-%s","order_id":"%s"%s}}' % (op, key, key, key, "".join("," + f for f in fields))


def write(spark, root, n, rows):
    write_commit(spark, root, n, write_batch(project_records(spark.createDataFrame(rows, "offset long, key string, value string")), root, n))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def recomputed(spark, root):
    return rows(agg.totals_view(agg.exact_totals(ledger.state(spark, root))))


@pytest.mark.parametrize("with_base", [False, True])
def test_ten_batches(spark, with_base):
    rng = random.Random(21)
    order = list(range(1, 301))
    for i in range(0, 300, 7):  # some rows come batches later than their place
        j = min(299, i + rng.randint(0, 80))
        order[i], order[j] = order[j], order[i]
    root, path, base = work_path(spark, "ledger"), work_path(spark, "totals"), None
    for n in range(10):
        write(spark, root, n, [event(rng, s) for s in order[n * 30:(n + 1) * 30]])
        if with_base and n == 4:
            base = ledger.write_base(spark, root, 3, work_path(spark, "base"))
        if not with_base or n in (0, 4, 6, 9):
            assert rows(ledger.refresh_totals(spark, root, path, base)) == recomputed(spark, root), n
    again = rows(ledger.refresh_totals(spark, root, path, base))
    assert again == recomputed(spark, root)  # a rerun counts nothing twice
    assert spark.read.parquet(path).select("upto").distinct().count() == (4 if with_base else 10)


def test_versions_may_be_skipped(spark):
    rng = random.Random(4)
    root, path = work_path(spark, "ledger"), work_path(spark, "totals")
    for n in range(6):
        write(spark, root, n, [event(rng, 40 * n + k) for k in range(40)])
        if n in (0, 3, 5):
            assert rows(ledger.refresh_totals(spark, root, path)) == recomputed(spark, root)
    with pytest.raises(ValueError):
        ledger.signed_changes(spark, root, 0, 9)


def test_signed_rows_are_before_and_after(spark):
    doc = lambda seq, key, m, a: (seq, key, f'{{"operationType":"update","documentKey":{{"_id":"{key}"}},"fullDocument":{{"order_id":"{key}","merchant_id":"{m}","amount":{a}}}}}')
    root = work_path(spark, "ledger")
    write(spark, root, 0, [doc(1, "a", "m1", 5.0), doc(2, "b", "m1", 7.0), doc(3, "same", "m1", 1.0)])
    write(spark, root, 1, [doc(4, "a", "m2", 5.0), (5, "b", '{"operationType":"delete","documentKey":{"_id":"b"}}'), doc(6, "c", "m3", 2.0), doc(7, "same", "m1", 1.0)])
    got = {(r.order_id, r.sign, r.merchant_id, r.amount) for r in ledger.signed_changes(spark, root, 0, 1).collect()}
    assert got == {("a", -1, "m1", 5.0), ("a", 1, "m2", 5.0), ("b", -1, "m1", 7.0), ("c", 1, "m3", 2.0)}


def test_the_table_is_not_read(spark):
    """The refresh reads the stored groups and the changed days, nothing else."""
    schema = "order_id string, merchant_id string, amount double, event_ts timestamp_ntz"
    table = DayTable(spark, work_path(spark, "orders"))
    days = spark.range(1, 21).select(F.concat(F.lit("o"), "id").alias("order_id"), F.concat(F.lit("m"), F.col("id") % 3).alias("merchant_id"), F.col("id").cast("double").alias("amount"),
                                     (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("event_ts"))
    table.create(days)
    before = agg.exact_totals(table.read())
    stored = spark.createDataFrame(before.collect(), before.schema)
    moved = days.where("order_id in ('o3', 'o9')").withColumn("merchant_id", F.lit(None).cast("string"))
    table.upsert(moved.unionByName(spark.createDataFrame([("new", "m9", None, None)], schema)))
    signed = table.signed_changes(1, 2)
    files = {f.split("event_date=")[1].split("/")[0] for f in signed.inputFiles()}
    assert files == {"2024-01-04", "2024-01-10", "__HIVE_DEFAULT_PARTITION__"}
    got = rows(agg.totals_view(agg.apply_signed(stored, signed)))
    assert got == rows(agg.totals_view(agg.exact_totals(table.read()))) and ("m9", None, 1) in got and (None, 12.0, 2) in got


def test_groups_without_rows_go(spark):
    stored = spark.createDataFrame([("m1", 1), ("m2", 2)], "merchant_id string, order_count long").selectExpr("merchant_id", "cast(5 as decimal(38,2)) sum_exact", "order_count amount_count", "order_count")
    signed = spark.createDataFrame([(-1, "m1", 5.0)], "sign int, merchant_id string, amount double")
    assert rows(agg.totals_view(agg.apply_signed(stored, signed))) == [("m2", 5.0, 2)]
