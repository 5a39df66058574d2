"""Change stream → append-only ledger, exactly once per micro-batch.

Each micro-batch is parsed, split into usable changes and dead letters, and
written in ONE pass to ``<root>/log/batch_id=<N>/_lane=ok|dlq`` with overwrite,
so a batch replayed after a failure replaces its own output instead of
duplicating it.  A one-row commit record ``<root>/commits/batch_id=<N>`` is
written last; readers only trust batches that have a commit.  The table state
is the replay of the committed log (``sources.ledger``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cdc import cdc_project, event_order, parse_envelope, parse_full_documents
from ..operators.changes import KEY, keyed_by_id
from ..schemas import TS_FORMAT

SOURCE = "_source_path"
RECORD_SCHEMA = "key string, value string, topic string, partition int, offset long"


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting: str = "earliest", max_offsets: int | None = None) -> DataFrame:
    """Unbounded read of a change topic (O05); needs the Kafka connector on the classpath."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", max_offsets)
    return r.load()


def file_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Broker-shaped records (key, value, topic, partition, offset) from JSON files (O05), with the file of each."""
    r = spark.readStream.schema(RECORD_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path).select("*", F.col("_metadata.file_path").alias(SOURCE))


def publish(records: DataFrame, path: str | None = None, kafka_servers: str | None = None,
            topic_col: str = "topic") -> None:
    """Publish ``(key, value, topic, …)`` records.

    With ``kafka_servers`` the rows go to the brokers (topic per row);
    otherwise they are written as JSON files partitioned by topic.
    """
    if kafka_servers:
        (records.select("key", "value", F.col(topic_col).alias("topic")).write.format("kafka")
            .option("kafka.bootstrap.servers", kafka_servers).save())
        return
    (records.write.mode("append").partitionBy(topic_col)
            .options(timestampFormat=TS_FORMAT, timestampNTZFormat=TS_FORMAT).json(path))


def publish_once(records: DataFrame, outbox: str, run_id: str, topic_col: str = "topic") -> DataFrame:
    """Publish through an outbox (O08): the records of a run lie in a folder of its own, which a repeated run replaces.

    Each record gets ``event_id``, the hash of topic, run and the record itself with its number among equal ones, so a
    consumer that was handed a run twice can tell.  Gives the outbox's records of the run.
    """
    body = F.sha2(F.to_json(F.struct(*sorted(records.columns))), 256)
    twin = F.row_number().over(Window.partitionBy(body).orderBy(body))
    keyed = records.withColumn("event_id", F.sha2(F.concat_ws("|", F.col(topic_col), F.lit(run_id), body, twin.cast("string")), 256))
    path = f"{outbox.rstrip('/')}/run={run_id}"
    (keyed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(topic_col)
        .options(timestampFormat=TS_FORMAT, timestampNTZFormat=TS_FORMAT).json(path))
    return records.sparkSession.read.schema(keyed.schema).option("basePath", path).json(path)


def to_records(df: DataFrame, key: str, topic: Column | str, seq: str = "seq") -> DataFrame:
    """Rows → broker records: JSON ``value`` of all columns but ``seq`` (the offset)."""
    payload = [c for c in df.columns if c != seq]
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*payload), {"timestampFormat": TS_FORMAT,
                                                    "timestampNTZFormat": TS_FORMAT}).alias("value"),
                     (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
                     F.lit(0).alias("partition"), F.col(seq).cast("long").alias("offset"))


def project_records(records: DataFrame, full_document_only: bool = False, order: str = "offset") -> DataFrame:
    """Broker records → flat change rows with ``_reason``.

    A null payload with a message key is a tombstone: a delete of that key (O42).
    ``order="offset"``: ``seq`` is the record offset, for topics whose events of one key share a
    partition.  ``order="cluster"``: ``seq`` is ``event_order`` (clock, partition, offset), for any topic; a payload
    without a clock takes the broker's ``timestamp`` where the records have one.
    """
    if order not in ("offset", "cluster"):
        raise ValueError(f"unknown order {order}")
    tomb = F.col("value").isNull() & F.col("key").isNotNull()
    value = F.when(tomb, F.to_json(F.struct(
        F.lit("delete").alias("operationType"),
        F.struct(F.col("key").cast("string").alias("_id")).alias("documentKey")))).otherwise(F.col("value"))
    carried = [c for c in ("partition", "timestamp") if order == "cluster" and c in records.columns]
    src = records.select(F.col("offset").alias("seq"), *carried, value.alias("value"))
    parsed = parse_full_documents(src) if full_document_only else parse_envelope(src)
    if order == "cluster":
        broker = F.col("timestamp").cast("timestamp_ntz").cast("string") if "timestamp" in carried else F.lit(None).cast("string")
        clock = F.coalesce("clusterTime", broker)
        partition = F.col("partition") if "partition" in carried else F.lit(0)
        parsed = parsed.withColumn("seq", event_order(clock, partition, F.col("seq")))
    return cdc_project(parsed)


def write_batch(projected: DataFrame, root: str, batch_id: int) -> int:
    """One pass over the batch: usable rows and dead letters side by side.

    Returns the number of usable rows, observed while writing (no second job).
    """
    return write_counted(projected, root, batch_id)["ok"]


def write_counted(projected: DataFrame, root: str, batch_id: int) -> dict[str, int]:
    """``write_batch``, with the numbers of usable rows (``ok``) and of deletes by database id among them (``id_deletes``)."""
    lane = F.when(F.col("_reason").isNull(), "ok").otherwise("dlq")
    out = projected.withColumn("_lane", lane).withColumn(
        "_payload", F.when(F.col("_reason").isNotNull(), F.col("_payload")))
    obs = Observation(f"ledger_batch_{batch_id}")
    ok = F.col("_lane") == "ok"
    by_id = keyed_by_id() if {"op", KEY, "source_id"} <= set(projected.columns) else F.lit(False)
    out = out.observe(obs, F.sum(F.when(ok, 1).otherwise(0)).alias("ok"),
                      F.sum(F.when(ok & by_id, 1).otherwise(0)).alias("id_deletes"))
    # static: a replayed batch replaces both lanes, also one that no longer occurs
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_lane").parquet(f"{root}/log/batch_id={batch_id}")
    return {k: int(obs.get.get(k) or 0) for k in ("ok", "id_deletes")}


def write_commit(spark: SparkSession, root: str, batch_id: int, added: int, id_deletes: int | None = None, run: dict | None = None) -> None:
    """The batch's commit, with the record of the run that made it (``run_record``).

    A replayed batch keeps the time of its first commit, so versions "as of" a time don't move.  Times are UTC.
    """
    try:
        before = spark.read.schema("committed_at timestamp_ntz").parquet(f"{root}/commits/batch_id={batch_id}").first()
    except AnalysisException:
        before = None
    first = before[0] if before else None
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
    run = run or {}
    origin = [F.lit(run.get(c)).cast("string").alias(c) for c in ("job", "run_id")]
    files = F.array(*[F.lit(f) for f in sorted(run.get("sources") or [])]).cast("array<string>")
    commit = spark.range(1).select(*origin, files.alias("sources"), *[F.lit(run.get(c)).cast("long").alias(c) for c in ("records", "first_offset", "last_offset")],
        F.lit(batch_id).cast("long").alias("snapshot_id"),
        (now if first is None else F.lit(first).cast("timestamp_ntz")).alias("committed_at"),
        F.lit("append").alias("operation"),
        F.lit(added).cast("long").alias("added_rows"),
        F.lit(id_deletes).cast("long").alias("id_deletes"))
    commit.write.mode("overwrite").parquet(f"{root}/commits/batch_id={batch_id}")


def run_record(records: DataFrame, job: str, batch_id: int) -> tuple[DataFrame, Observation]:
    """``records`` observed on their way (O14): where they came from and how many, without another pass over them."""
    obs = Observation(f"{job}_{batch_id}")
    sources = F.collect_set(SOURCE) if SOURCE in records.columns else F.collect_set(F.concat_ws("/", "topic", "partition")) \
        if {"topic", "partition"} <= set(records.columns) else F.array().cast("array<string>")
    return records.observe(obs, (sources if SOURCE in records.columns or "topic" in records.columns else F.max(sources)).alias("sources"),
                           F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")), obs


def batch_writer(root: str, full_document_only: bool = False, order: str = "offset", job: str = "ledger"):
    def _apply(batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():          # O40: no files, no commit for empty batches
            return
        records, seen = run_record(batch_df, job, batch_id)
        n = write_counted(project_records(records, full_document_only, order), root, batch_id)
        run = {**seen.get, "job": job, "run_id": batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")}
        write_commit(batch_df.sparkSession, root, batch_id, n["ok"], n["id_deletes"], run)
    return _apply


def start_ledger_stream(source: DataFrame, root: str, checkpoint: str,
                        available_now: bool = True, processing_time: str | None = None,
                        full_document_only: bool = False, order: str = "offset"):
    """Start the change stream into the ledger at ``root``.

    ``checkpoint`` keeps source offsets; restarting with the same checkpoint
    resumes after the last committed batch.
    """
    w = (source.writeStream.outputMode("update")
         .foreachBatch(batch_writer(root, full_document_only, order))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()
