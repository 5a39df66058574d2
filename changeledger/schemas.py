"""Schemas and fixed policy values.

FIXED VALUES — these must equal the behaviour being reproduced (column sets,
operation names, retention days, target file sizes, partition counts).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------
# Columns of the orders table; anything else lands in the `_rest` map.
ORDER_COLUMNS = ["order_id", "merchant_id", "status", "amount", "currency",
                 "event_ts", "ingestion_ts"]
# Columns of the change table (merchant_events).
CHANGE_COLUMNS = ["order_id", "merchant_id", "status", "amount", "currency", "event_ts"]
# Change operations accepted; everything else goes to the dead letter set.
UPSERT_OPS = ["insert", "update", "replace"]
DELETE_OP = "delete"
# Hash buckets of the change table on merchant_id.
MERCHANT_BUCKETS = 16
# Snapshot retention in days per table, and tags taken before expiry.
RETENTION_DAYS = {
    "payments.orders": 7,
    "payments.merchant_events": 3,
    "payments.clickstream": 14,
}
DEFAULT_RETENTION_DAYS = 7
SNAPSHOT_TAGS = {"payments.orders": [("month-start", "latest")]}
# Retention by refinement zone, in days.
ZONE_RETENTION_DAYS = {"bronze": 7, "silver": 30, "gold": 90}
# Raw landed objects expire after this many days.
RAW_TTL_DAYS = 365
# Target data file sizes in bytes.
TARGET_FILE_BYTES = {
    "payments.orders": 536870912,
    "payments.merchant_events": 268435456,
    "payments.clickstream": 134217728,
}
# Compaction target file size by refinement zone, in bytes.
ZONE_TARGET_FILE_BYTES = {"bronze": 536870912, "gold": 268435456}
# Documents per extracted page / landed file.
EXTRACT_PAGE_SIZE = 1000
# Topic naming: <database>.cdc.<collection>; dead letters get this suffix.
TOPIC_INFIX = "cdc"
DLQ_SUFFIX = "dlq"
# Six-digit fractional seconds so JSON round trips keep microseconds.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Fields of a document and of the envelope around it.
FULL_DOCUMENT = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("event_ts", T.StringType()),
])

ENVELOPE = T.StructType([
    T.StructField("operationType", T.StringType()),
    T.StructField("fullDocument", FULL_DOCUMENT),
    T.StructField("documentKey", T.StructType([T.StructField("_id", T.StringType())])),
    T.StructField("clusterTime", T.StringType()),
])
# ---- end of fixed values ----------------------------------------------------

# Flat change row (one per event) after projection; `seq` orders events.
CHANGE_ROW = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType()),
])

REST_TYPE = T.MapType(T.StringType(), T.StringType())
