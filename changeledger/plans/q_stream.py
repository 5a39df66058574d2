"""Queries: the change stream into the ledger, restart, publish round trip."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TS_FORMAT
from ..session import work_path
from ..sources import ledger
from ..sources import testdata as td
from ..streaming import cdc_stream as cs
from ..streaming import keyed_state as ks
from . import oracle as O
from .registry import register

FILES = 10
CUT = "2024-01-20 00:00:00"


def _records(spark, sf_dir, own_ids=False):
    env = td.envelopes(spark, sf_dir, own_ids=own_ids)
    key = td.database_id(F.col("order_id")) if own_ids else F.col("order_id")
    return env.select(
        key.alias("key"), "value", F.lit("payments.cdc.orders").alias("topic"),
        F.lit(0).alias("partition"), F.col("seq").alias("offset"), "event_ts")


def _land_records(records, path, files):
    # arrival order is not offset order inside a file: the ledger must not care
    (records.drop("event_ts").repartitionByRange(files, "offset")
            .write.mode("append").json(path))


def _run(spark, src, root, ckpt, max_files=3):
    q = cs.start_ledger_stream(cs.file_source(spark, src, max_files), root, ckpt)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


REPLAY = O.with_(O.EV, O.CDC_FLAT, O.replay("cdc_flat", "st")) + "SELECT * FROM st"


@register("stream_cdc_apply", REPLAY)
def q_stream_cdc_apply(spark, sf_dir):
    """Deletes carry the database id alone and find their rows by earlier documents."""
    src, root, ckpt = (work_path(spark, n) for n in ("cdc-in", "ledger", "cdc-ckpt"))
    _land_records(_records(spark, sf_dir, own_ids=True), src, FILES)
    _run(spark, src, root, ckpt)
    return ledger.state(spark, root)


@register("stream_restart", REPLAY)
def q_stream_restart(spark, sf_dir):
    """Stop after the first part of the files, add the rest, restart from the checkpoint."""
    src, root, ckpt = (work_path(spark, n) for n in ("cdc-in", "ledger", "cdc-ckpt"))
    rec = _records(spark, sf_dir, own_ids=True)
    cut = F.lit(CUT).cast("timestamp_ntz")
    _land_records(rec.where(F.col("event_ts") < cut), src, FILES // 2)
    _run(spark, src, root, ckpt)
    _land_records(rec.where(F.col("event_ts") >= cut), src, FILES // 2)
    _run(spark, src, root, ckpt)
    return ledger.state(spark, root)


@register("stream_keyed_state", REPLAY)
def q_stream_keyed_state(spark, sf_dir):
    """Current rows from the stream's own state: events arrive in any order, and the query stops and restarts in between."""
    src, root, ckpt = (work_path(spark, n) for n in ("cdc-in", "keyed-state", "keyed-ckpt"))
    records = _records(spark, sf_dir).drop("event_ts")
    for half in (1, 0):
        part = records.where(F.pmod(F.xxhash64("offset"), F.lit(2)) == half)
        part.repartition(FILES // 2, F.xxhash64("offset")).write.mode("append").json(src)
        q = ks.start_state_stream(cs.file_source(spark, src, 3), root, ckpt)
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return ks.current_rows(spark, root)


PAYLOAD = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("op", T.StringType()),
    T.StructField("merchant_id", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("amount", T.DoubleType()), T.StructField("currency", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType())])


@register("event_publish", O.with_(O.EV, O.CDC_FLAT) + "SELECT * FROM cdc_flat")
def q_event_publish(spark, sf_dir):
    """Rows → JSON records on a topic → read back → the same rows, microseconds kept."""
    path = work_path(spark, "topic-out")
    cs.publish(cs.to_records(td.cdc_flat(spark, sf_dir), "order_id", "payments.cdc.orders"), path)
    back = spark.read.schema("key string, value string, partition int, offset long").json(path)
    opts = {"timestampNTZFormat": TS_FORMAT}
    return back.select(F.col("offset").alias("seq"),
                       F.from_json("value", PAYLOAD, opts).alias("p")).select("seq", "p.*")


@register("event_publish_once", O.with_(O.EV, O.CDC_FLAT) + "SELECT seq, order_id, status, 1 AS events FROM cdc_flat")
def q_event_publish_once(spark, sf_dir):
    """A run that publishes twice is in the outbox once, and every record has an id of its own."""
    outbox, records = work_path(spark, "outbox"), cs.to_records(td.cdc_flat(spark, sf_dir), "order_id", "payments.cdc.orders")
    for _ in range(2):
        cs.publish_once(records, outbox, "run-1")
    back = spark.read.schema("key string, value string, offset long, event_id string, run string, topic string").json(outbox)
    opts = {"timestampNTZFormat": TS_FORMAT}
    rows = back.select(F.col("offset").alias("seq"), F.from_json("value", PAYLOAD, opts).alias("p"), "event_id")
    return rows.groupBy("seq", "p.order_id", "p.status").agg(F.count_distinct("event_id").cast("int").alias("events"))


@register("run_records", O.with_(O.EV, O.CDC_FLAT) + f"SELECT count(*) AS records, min(seq) AS first_offset, max(seq) AS last_offset, {FILES} AS files FROM cdc_flat")
def q_run_records(spark, sf_dir):
    """What the commits say about their runs: all records, offsets and source files are accounted for, each file once."""
    src, root, ckpt = (work_path(spark, n) for n in ("cdc-in", "ledger", "cdc-ckpt"))
    _land_records(_records(spark, sf_dir), src, FILES)
    _run(spark, src, root, ckpt)
    runs = ledger.runs(spark, root).where("job is not null and run_id is not null")
    return runs.agg(F.sum("records").alias("records"), F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"),
                    F.size(F.flatten(F.collect_list("sources"))).alias("files"))


@register("cdc_source", O.with_(O.EV, O.CDC_FLAT)
          + "SELECT seq AS \"offset\", order_id AS key, 'payments.cdc.orders' AS topic FROM cdc_flat")
def q_cdc_source(spark, sf_dir):
    """Broker-shaped records read as a stream (availableNow) into a Parquet sink."""
    src, out, ckpt = (work_path(spark, n) for n in ("cdc-in", "cdc-raw", "cdc-raw-ckpt"))
    _land_records(_records(spark, sf_dir), src, FILES)
    q = (cs.file_source(spark, src, max_files=3).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select("offset", "key", "topic")
