"""Literal edge cases of flattening, `_rest`, timestamps, dedupe and upsert."""

import json

from pyspark.sql import functions as F

from changeledger.functions.cdc import cdc_project, dead_letters, normalize_event_ts, parse_envelope
from changeledger.functions.flatten import flatten
from changeledger.functions.rest import rest_pack, rest_value
from changeledger.operators.merge import latest_per_key, snapshot_upsert
from changeledger.plans import jobs
from changeledger.session import work_path


def test_flatten_unwraps_date_and_oid_and_suffixes_collisions(spark):
    docs = [json.dumps({"_id": {"$oid": "abc"}, "order_id": "o1",
                        "event_ts": {"$date": "2024-01-01T00:00:00.000000"},
                        "a": {"b": 1}, "a_b": 2, "billing": {"card": {"brand": "visa"}}})]
    df = spark.read.json(spark.sparkContext.parallelize(docs))
    flat = flatten(df)
    assert set(flat.columns) == {"_id", "order_id", "event_ts", "a_b", "a_b__2", "billing_card_brand"}
    row = flat.first()
    assert row["_id"] == "abc" and row["event_ts"] == "2024-01-01T00:00:00.000000"
    assert sorted([row["a_b"], row["a_b__2"]]) == [1, 2]


def test_rest_pack_empty_and_typed(spark):
    df = spark.createDataFrame([("o1", "m1")], "order_id string, merchant_id string")
    packed = rest_pack(df)
    assert dict(packed.dtypes)["_rest"] == "map<string,string>"
    assert packed.first()["_rest"] == {}


def test_rest_pack_scalars_cast_complex_json_nulls_dropped(spark):
    df = spark.createDataFrame([("o1", 3, None, [1, 2])],
                               "order_id string, n int, note string, tags array<int>")
    row = rest_pack(df).first()
    assert row["_rest"] == {"n": "3", "tags": "[1,2]"}
    assert rest_pack(df).select(rest_value("absent")).first()[0] is None


def test_malformed_timestamp_goes_to_dead_letter(spark):
    df = spark.createDataFrame([("o1", "2024-01-01 10:00:00"), ("o2", "2024-13-45")],
                               "order_id string, event_ts string")
    out = {r["order_id"]: r for r in normalize_event_ts(df).collect()}
    assert out["o1"]["event_ts"] is not None and out["o1"]["_bad_event_ts"] is None
    assert out["o2"]["event_ts"] is None and out["o2"]["_bad_event_ts"] == "2024-13-45"


def test_bad_payloads_are_classified(spark):
    rows = [(1, "{bad"), (2, '{"documentKey":{"_id":"x"}}'), (3, '{"operationType":"drop"}'),
            (4, '{"operationType":"insert"}'), (5, None)]
    df = spark.createDataFrame(rows, "seq long, value string")
    got = {r["seq"]: r["reason"] for r in dead_letters(cdc_project(parse_envelope(df))).collect()}
    assert got == {1: "malformed", 2: "null_operation", 3: "unknown_operation", 4: "null_key",
                   5: "null_payload"}


def test_duplicate_source_keys_newest_wins(spark):
    df = spark.createDataFrame([("o1", "old", 1), ("o1", "new", 2), ("o2", "x", 1)],
                               "order_id string, status string, v int")
    out = {r["order_id"]: r["status"] for r in latest_per_key(df, "order_id", ["v"]).collect()}
    assert out == {"o1": "new", "o2": "x"}


def test_upsert_is_idempotent(spark):
    from changeledger.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    target = td.orders_src(spark, sf).select(*td.ORDER_FIELDS)
    delta = td.orders_delta(spark, sf)
    once = snapshot_upsert(target, delta, "order_id", ["event_ts", "src_file"]).cache()
    twice = snapshot_upsert(once, delta, "order_id", ["event_ts", "src_file"])
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_ingest_batch_single_day_from_raw(spark):
    root = work_path(spark, "raw-test")
    docs = [{"order_id": "o1", "merchant_id": "m1", "status": "created", "amount": 10.5,
             "currency": "USD", "event_ts": "2024-03-01T10:00:00.000001", "promo": "X",
             "billing": {"card": {"brand": "visa"}}},
            {"order_id": "o2", "merchant_id": "m2", "status": "created", "amount": 3.0,
             "currency": "USD", "event_ts": "not a time"}]
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(d) for d in docs]))
    df.withColumn("dt", F.lit("2024-03-01")).write.partitionBy("dt").json(root)
    target = rest_pack(spark.createDataFrame(
        [("o1", "m1", "created", 1.0, "USD", None, None)],
        "order_id string, merchant_id string, status string, amount double, currency string, "
        "event_ts timestamp_ntz, ingestion_ts timestamp_ntz"))
    out = jobs.ingest_batch(spark, root, target, date="2024-03-01", run_ts="2024-03-02 00:00:00")
    rows = {r["order_id"]: r for r in out.collect()}
    assert set(rows) == {"o1"}              # o2 has an unusable timestamp
    assert rows["o1"]["amount"] == 10.5
    assert rows["o1"]["_rest"] == {"promo": "X", "billing_card_brand": "visa"}


def test_silver_keeps_valid_rows_one_per_key(spark):
    from changeledger.operators.aggregates import silver_orders
    rows = [("o1", "m1", "created", 10.456, "usd", "2024-01-01 00:00:00"),
            ("o1", "m1", "approved", 11.0, "usd", "2024-01-02 00:00:00"),   # newer version wins
            ("o2", "m2", "stale", 5.0, "usd", "2024-01-01 00:00:00"),       # unknown status
            ("o3", "m3", "created", -1.0, "usd", "2024-01-01 00:00:00"),    # negative amount
            ("o4", "m4", "created", 3.0, "usd", None)]                      # no event time
    df = spark.createDataFrame(rows, "order_id string, merchant_id string, status string, "
                                     "amount double, currency string, event_ts string") \
        .withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))
    out = silver_orders(df).collect()
    assert [(r["order_id"], r["status"], r["amount"], r["currency"]) for r in out] == \
        [("o1", "approved", 11.0, "USD")]
    assert str(out[0]["event_date"]) == "2024-01-02"


def test_append_by_name_aligns_order_missing_and_extra_columns(spark):
    from changeledger.operators.evolution import append_by_name
    target = spark.createDataFrame([("a", 1, None)], "k string, n int, note string")
    rows = spark.createDataFrame([(2, "b", "x")], "n long, k string, extra string")
    out = append_by_name(target, rows)
    assert out.columns == ["k", "n", "note"]
    assert dict(out.dtypes)["n"] == "int"
    assert sorted(map(tuple, out.collect())) == [("a", 1, None), ("b", 2, None)]
