"""Change-event parsing: payload → envelope → flat change row, and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (DELETE_OP, DLQ_SUFFIX, ENVELOPE, FULL_DOCUMENT, TOPIC_INFIX,
                       UPSERT_OPS)

PARSED = "_env"
CORRUPT = "_corrupt_record"


def to_ts(c: Column) -> Column:
    """Text → timestamp without zone, in UTC; malformed text gives NULL instead of an error.

    Text with a zone or offset is converted to UTC, whatever the session zone; a whole
    number of at least nine digits counts the milliseconds since 1970.
    """
    zoned = c.rlike(r"\d{2}:\d{2}.*([zZ]|[+-]\d{2}:?\d{2})$")
    millis = F.when(c.rlike(r"^-?\d{9,}$"), c.try_cast("long"))
    return (F.when(zoned, from_micros(F.unix_micros(c.try_cast("timestamp"))))
             .when(millis.isNotNull(), from_micros(millis * 1000))
             .otherwise(c.try_cast("timestamp_ntz")))


def from_micros(micros: Column) -> Column:
    """Microseconds since 1970 in UTC → timestamp without zone."""
    secs = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=secs)


def normalize_event_ts(df: DataFrame, column: str = "event_ts") -> DataFrame:
    """Cast ``event_ts`` to a timestamp when the column exists and is text.

    Rows whose non-null text does not parse keep the original text in
    ``_bad_<column>`` so they can be routed to the dead-letter set.
    """
    if column not in df.columns:
        return df
    kind = dict(df.dtypes)[column]
    if kind in ("bigint", "int"):       # extended JSON: milliseconds since 1970
        return df.withColumn(column, from_micros(F.col(column).cast("long") * 1000))
    if kind != "string":
        return df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    parsed = to_ts(F.col(column))
    return (df.withColumn(f"_bad_{column}",
                          F.when(F.col(column).isNotNull() & parsed.isNull(), F.col(column)))
              .withColumn(column, parsed))


def stamp_ingestion(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Add ``ingestion_ts``: a fixed run time when given, else the query start."""
    ts = F.lit(run_ts).cast("timestamp_ntz") if run_ts else F.localtimestamp()
    return df.withColumn("ingestion_ts", ts)


def read_json(text: Column, schema: T.StructType) -> Column:
    """JSON text → struct; its ``_corrupt_record`` keeps text that is no JSON or has a field of another type."""
    fields = [*schema.fields, T.StructField(CORRUPT, T.StringType())]
    return F.from_json(text, T.StructType(fields), {"columnNameOfCorruptRecord": CORRUPT})


def parsed_once(df: DataFrame, keep: list[str], value: str, schema: T.StructType) -> DataFrame:
    """``keep``, ``_payload`` and the parsed struct as ``_env``.

    A filter on a field moves below a plain projection and takes along a copy of the parser, and of the expression that
    made the text, for each place that names a field.  It can't move below a generator, so each text is made and parsed once.
    """
    text = df.select(*keep, F.col(value).cast("string").alias("_payload"))
    return text.select(*keep, "_payload", F.explode_outer(F.array(read_json(F.col("_payload"), schema))).alias(PARSED))


def parse_envelope(df: DataFrame, value: str = "value", schema=ENVELOPE) -> DataFrame:
    """Payload bytes/text → envelope struct columns and ``_corrupt_record``."""
    keep = [c for c in df.columns if c != value]
    return parsed_once(df, keep, value, schema).select(*keep, "_payload", f"{PARSED}.*")


def parse_full_documents(df: DataFrame, value: str = "value") -> DataFrame:
    """Source that only publishes full documents (O06): each becomes an ``update``."""
    keep = [c for c in df.columns if c != value]
    doc = F.col(PARSED)
    return parsed_once(df, keep, value, FULL_DOCUMENT).select(
        *keep, "_payload",
        F.when(doc.isNotNull(), F.lit("update")).alias("operationType"),
        doc.alias("fullDocument"),
        F.struct(doc.getField("_id").alias("_id")).alias("documentKey"),
        F.lit(None).cast("string").alias("clusterTime"),
        doc.getField(CORRUPT).alias(CORRUPT))


def cdc_project(env: DataFrame, seq: str = "seq") -> DataFrame:
    """Envelope → flat change row.

    key = coalesce(fullDocument.order_id, documentKey._id),
    event_ts = coalesce(fullDocument.event_ts, clusterTime).
    ``_reason`` is null for usable rows and names the defect otherwise.  ``source_id``
    is the database id, by which deletes are matched with earlier documents
    (``operators.changes.resolve_deletes``).
    """
    doc = F.col("fullDocument")
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in env.columns else F.lit(False)
    ts_text = F.coalesce(doc.getField("event_ts"), F.col("clusterTime"))
    ts = to_ts(ts_text)
    op = F.col("operationType")
    key = F.coalesce(doc.getField("order_id"), F.col("documentKey").getField("_id"))
    reason = (F.when(F.col("_payload").isNull(), "null_payload")
               .when(F.col("operationType").isNull() & F.col("fullDocument").isNull()
                     & F.col("documentKey").isNull(), "malformed")
               .when(op.isNull(), "null_operation")
               .when(~op.isin(DELETE_OP, *UPSERT_OPS), "unknown_operation")
               .when(key.isNull(), "null_key")
               # a delete needs its key alone: neither the clock nor other fields
               .when((op != DELETE_OP) & corrupt, "wrong_type")
               .when((op != DELETE_OP) & ts_text.isNotNull() & ts.isNull(), "bad_timestamp"))
    place = F.col(seq) if isinstance(env.schema[seq].dataType, T.StructType) else F.col(seq).cast("long")
    return env.select(
        place.alias("seq"),
        key.alias("order_id"),
        op.alias("op"),
        doc.getField("merchant_id").alias("merchant_id"),
        doc.getField("status").alias("status"),
        doc.getField("amount").alias("amount"),
        doc.getField("currency").alias("currency"),
        ts.alias("event_ts"),
        F.coalesce(F.col("documentKey").getField("_id"), doc.getField("_id")).alias("source_id"),
        reason.alias("_reason"),
        F.col("_payload"),
    )


def event_order(cluster_time: Column, partition: Column | str = "partition", offset: Column | str = "offset") -> Column:
    """The place of an event whose key's events come from several topic partitions (D4): the database's
    clock, then partition and offset.

    Structs compare field by field, so every fold, base and late-event test orders by it as by one number.  An
    event without a readable clock comes before all others of its key.
    """
    p, o = (F.col(c) if isinstance(c, str) else c for c in (partition, offset))
    return F.struct(to_ts(cluster_time).alias("cluster_time"), p.cast("int").alias("partition"), o.cast("long").alias("offset"))


CHANGE_OUT = ["seq", "order_id", "op", "merchant_id", "status", "amount", "currency", "event_ts"]


def good_changes(projected: DataFrame) -> DataFrame:
    return projected.where(F.col("_reason").isNull()).select(*CHANGE_OUT)


def dead_letters(projected: DataFrame) -> DataFrame:
    """Unusable events, kept with their payload and reason."""
    return projected.where(F.col("_reason").isNotNull()).select(
        "seq", F.col("_reason").alias("reason"), F.col("_payload").alias("payload"))


def resolve_delete_keys(changes: DataFrame, id_map: DataFrame) -> DataFrame:
    """Deletes keyed by the database id get the business key back.

    ``id_map`` holds ``(_id, order_id)`` seen on earlier full documents.
    """
    ids = id_map.select("_id", F.col("order_id").alias("_mapped")).distinct()
    return (changes.join(ids, changes["order_id"] == ids["_id"], "left")
                   .withColumn("order_id", F.coalesce("_mapped", "order_id"))
                   .drop("_id", "_mapped"))


def topic_for(db: Column | str, collection: Column | str, dead_letter: bool = False) -> Column:
    """``<db>.cdc.<collection>`` (and ``.dlq``) for every event."""
    db = F.lit(db) if isinstance(db, str) else db
    collection = F.lit(collection) if isinstance(collection, str) else collection
    parts = [db, F.lit(TOPIC_INFIX), collection] + ([F.lit(DLQ_SUFFIX)] if dead_letter else [])
    return F.concat_ws(".", *parts)
