"""Change stream → current rows, with each key's fold kept in the stream's own state.

Where the ledger stores every event and folds when it is read, this keeps the fold of each key (last delete, last upsert,
each column's last value with its place: ``operators.changes.accumulators``) as the state of a streaming aggregation, and every
micro-batch emits the rows of the keys it touched, deleted ones as such.  The fold doesn't depend on the order of arrival, so late
and shuffled events end in the state that replaying the log gives.  Each task folds its own events before the shuffle, so a key
costs one state row read and written per batch, however many events it has.  Of events with one place, which a topic has only as
repeats of a record, any may count, as in a replay.  State lives in the RocksDB store under the checkpoint:
a key's state is a few values, it spills to disk, and a lost executor's share is restored from the checkpoint.

Deletes must carry the business key; deletes by database id alone need the ledger, which knows earlier documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cdc import CHANGE_OUT
from ..operators.changes import KEY, VALUE_COLUMNS, accumulators, current, exists
from ..schemas import CHANGE_ROW, DELETE_OP, UPSERT_OPS
from .cdc_stream import project_records

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VALUE_FIELDS = [f for f in CHANGE_ROW.fields if f.name in VALUE_COLUMNS]
OUT_FIELDS = [T.StructField(KEY, T.StringType()), *VALUE_FIELDS, T.StructField("_exists", T.BooleanType()), T.StructField("_events", T.LongType())]


def keyed_state(changes: DataFrame) -> DataFrame:
    """Streaming change rows → the rows of the touched keys, in update mode."""
    names = [f.name for f in VALUE_FIELDS]
    usable = changes.where(F.col(KEY).isNotNull() & F.col("op").isin(DELETE_OP, *UPSERT_OPS)).select(*CHANGE_OUT)
    folds = usable.groupBy(KEY).agg(*accumulators(names, F.lit(True)), F.count(F.lit(1)).alias("_events"))
    return folds.select(KEY, *[current(c).alias(c) for c in names], exists().alias("_exists"), "_events")


def start_state_stream(source: DataFrame, root: str, checkpoint: str, order: str = "offset", available_now: bool = True,
                       processing_time: str | None = None):
    """Start records → ``<root>/rows/batch_id=N``, the touched keys' rows of each micro-batch.

    A batch that is replayed after a failure replaces its own rows; empty ones write nothing (O40).  Dead letters go to
    ``<root>/dead_letters`` by ``start_dead_letter_stream``.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            if not rows.isEmpty():
                rows.write.mode("overwrite").parquet(f"{root}/rows/batch_id={batch_id}")
        finally:
            rows.unpersist()

    projected = project_records(source, order=order).where(F.col("_reason").isNull())
    w = keyed_state(projected).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    spark, old = source.sparkSession, source.sparkSession.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)  # the query keeps the settings it was started with
    try:
        return w.start()
    finally:
        if old is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, old)


def start_dead_letter_stream(source: DataFrame, root: str, checkpoint: str, order: str = "offset"):
    """Unusable records with their reason, appended exactly once by the file sink."""
    bad = project_records(source, order=order).where(F.col("_reason").isNotNull()).select("seq", F.col("_reason").alias("reason"), F.col("_payload").alias("payload"))
    return (bad.writeStream.format("parquet").option("path", f"{root}/dead_letters").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def current_rows(spark: SparkSession, root: str, deleted: bool = False) -> DataFrame:
    """The table: each key's row of the newest batch that touched it.  With ``deleted`` the keys that are gone."""
    rows = spark.read.schema(T.StructType([*OUT_FIELDS, T.StructField("batch_id", T.LongType())])).parquet(f"{root}/rows")
    fields = [f.name for f in VALUE_FIELDS]
    newest = rows.groupBy(KEY).agg(F.max_by(F.struct(*fields, "_exists"), "batch_id").alias("_row"))
    return newest.where(F.col("_row._exists") != F.lit(deleted)).select(KEY, *[F.col(f"_row.{c}").alias(c) for c in fields])


def compact_rows(spark: SparkSession, root: str, upto_batch: int) -> int:
    """Fold the rows of batches up to ``upto_batch`` into that batch's folder, so that reads don't grow with the number of batches.

    Gives the number of batches folded.  Run it while no query writes that batch.
    """
    rows = spark.read.schema(T.StructType([*OUT_FIELDS, T.StructField("batch_id", T.LongType())])).parquet(f"{root}/rows").where(F.col("batch_id") <= upto_batch)
    batches = sorted(r[0] for r in rows.select("batch_id").distinct().collect())
    if len(batches) < 2:
        return 0
    fields = [c for c in rows.columns if c not in (KEY, "batch_id")]
    folded = rows.groupBy(KEY).agg(F.max_by(F.struct(*fields), "batch_id").alias("_row")).select(KEY, *[F.col(f"_row.{c}").alias(c) for c in fields])
    held = f"{root}/compacting"
    folded.write.mode("overwrite").parquet(held)
    spark.read.parquet(held).write.mode("overwrite").parquet(f"{root}/rows/batch_id={batches[-1]}")
    for n in batches[:-1]:  # older rows of a key lose against the newest batch's, so a stop in between changes nothing
        spark.createDataFrame([], T.StructType(OUT_FIELDS)).write.mode("overwrite").parquet(f"{root}/rows/batch_id={n}")
    return len(batches)
