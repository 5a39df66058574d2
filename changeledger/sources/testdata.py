"""Order-style datasets derived from the benchmark tables.

Every fixture is a lazy DataFrame over the parquet tables in ``sf_dir`` so its
size grows with the scale factor.  The oracle SQL in ``plans.oracle`` builds the
same shapes in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TS_FORMAT


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prop_k() -> Column:
    """The integer ``k`` stored in the events' JSON ``props`` column."""
    return F.get_json_object("props", "$.k").cast("int")


def iso(ts: Column) -> Column:
    """Timestamp as ISO text with six fractional digits."""
    return F.date_format(ts, TS_FORMAT)


def orders_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of the orders table (without `_rest`/`ingestion_ts`)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("ord-"), o.o_orderkey.cast("string")).alias("order_id"),
        F.concat(F.lit("m-"), o.o_custkey.cast("string")).alias("merchant_id"),
        F.when(o.o_orderstatus == "O", "created")
         .when(o.o_orderstatus == "F", "approved")
         .otherwise("refunded").alias("status"),
        o.o_totalprice.alias("amount"),
        F.lit("USD").alias("currency"),
        o.o_orderdate.cast("timestamp_ntz").alias("event_ts"),
        "o_orderkey",
        "o_orderpriority",
    )


ORDER_FIELDS = ["order_id", "merchant_id", "status", "amount", "currency", "event_ts"]


def orders_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily snapshot delta against ``orders_src``.

    * urgent orders are refunded one day later (amount + 1);
    * the same keys appear a second time with their older, stale version;
    * automobile-segment customers place one new order each.
    ``src_file`` mimics the landed file a row came from (tie-breaker).
    """
    src = orders_src(spark, sf_dir).where(F.col("o_orderpriority") == "1-URGENT")
    changed = src.select(
        "order_id", "merchant_id", F.lit("refunded").alias("status"),
        (F.col("amount") + 1).alias("amount"), "currency",
        (F.col("event_ts") + F.expr("INTERVAL 1 DAY")).alias("event_ts"),
        F.lit("delta-2.json").alias("src_file"))
    stale = src.select(
        "order_id", "merchant_id", F.lit("stale").alias("status"), "amount", "currency",
        "event_ts", F.lit("delta-1.json").alias("src_file"))
    c = read_table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "AUTOMOBILE")
    new = c.select(
        F.concat(F.lit("ord-new-"), c.c_custkey.cast("string")).alias("order_id"),
        F.concat(F.lit("m-"), c.c_custkey.cast("string")).alias("merchant_id"),
        F.lit("created").alias("status"),
        c.c_acctbal.alias("amount"),
        F.lit("USD").alias("currency"),
        F.lit("2001-08-02 00:00:00").cast("timestamp_ntz").alias("event_ts"),
        F.lit("delta-2.json").alias("src_file"))
    return changed.unionByName(stale).unionByName(new)


def cdc_flat_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cdc_flat`` plus the payload's ``k``, in one projection of ``events``."""
    e = read_table(spark, sf_dir, "events").withColumn("k", prop_k())
    return e.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("ord-"), F.col("user_id").cast("string")).alias("order_id"),
        F.when(F.col("event_type") == "error", "delete")
         .when(F.col("event_type") == "signup", "insert")
         .otherwise("update").alias("op"),
        F.concat(F.lit("m-"), (F.col("user_id") % 16).cast("string")).alias("merchant_id"),
        F.when(F.col("k") % 7 != 0, F.col("event_type")).alias("status"),
        F.when(F.col("k") % 5 != 0, F.col("value")).alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("ts").alias("event_ts"),
        "k",
    )


def cdc_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change row per event: inserts (signup), deletes (error), updates (rest).

    Status is missing where k % 7 = 0 and amount where k % 5 = 0, so partial
    updates (a null never clears a value) are exercised.
    """
    return cdc_flat_k(spark, sf_dir).drop("k")


def database_id(order_id: Column) -> Column:
    """The id under which the database keeps an order's document."""
    return F.concat(F.lit("id-"), order_id)


def envelopes(spark: SparkSession, sf_dir: str, corrupt: bool = False, own_ids: bool = False) -> DataFrame:
    """Change events as JSON text in the change-stream envelope,
    ``(seq, order_id, event_ts, value)``.

    With ``own_ids`` documents have a database id of their own, and deletes carry
    that id alone, as a change stream sends them; else the id is the order id.

    Deletes carry no full document; where k % 3 = 0 the document has no
    event_ts and the cluster time stands in.  With ``corrupt`` some payloads
    are broken: k = 13 → not JSON, k = 42 → no operation, k = 57 → unknown
    operation, k = 71 → unparsable timestamp.
    """
    f = cdc_flat_k(spark, sf_dir)
    is_del = F.col("op") == "delete"
    doc_ts = F.when(F.col("k") % 3 != 0, iso(F.col("event_ts")))
    op = F.col("op")
    if corrupt:
        doc_ts = F.when(F.col("k") == 71, F.lit("2024-13-45 99:99")).otherwise(doc_ts)
        op = (F.when(F.col("k") == 42, F.lit(None).cast("string"))
               .when(F.col("k") == 57, F.lit("drop")).otherwise(op))
    own = database_id(F.col("order_id")) if own_ids else F.col("order_id")
    doc = F.when(~is_del, F.struct(
        own.alias("_id"), "order_id", "merchant_id", "status", "amount",
        "currency", doc_ts.alias("event_ts")))
    value = F.to_json(F.struct(
        op.alias("operationType"),
        doc.alias("fullDocument"),
        F.struct(own.alias("_id")).alias("documentKey"),
        iso(F.col("event_ts")).alias("clusterTime")))
    if corrupt:
        value = F.when(F.col("k") == 13, F.lit("{bad")).otherwise(value)
    return f.select("seq", "order_id", "event_ts", value.alias("value"))


def nested_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested order documents (billing struct two levels deep, items array)."""
    s = orders_src(spark, sf_dir)
    billing = F.when(
        F.col("o_orderkey") % 3 != 0,
        F.struct(F.struct(F.col("o_orderpriority").alias("city")).alias("address"),
                 F.struct(F.col("status").alias("brand")).alias("card")))
    items = F.when(
        F.col("o_orderkey") % 2 == 0,
        F.array(F.struct(
            F.concat(F.lit("sku-"), (F.col("o_orderkey") % 50).cast("string")).alias("sku"),
            ((F.col("o_orderkey") % 5) + 1).cast("int").alias("quantity"))))
    return s.select(*ORDER_FIELDS, "o_orderkey", "o_orderpriority",
                    billing.alias("billing"), items.alias("items"))


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clickstream rows with an open attribute map.

    Version 1 rows (first 15 days) carry keys page/action, version 2 rows
    page/browser (browser only where k is even).
    """
    e = read_table(spark, sf_dir, "events").withColumn("k", prop_k())
    v2 = F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    attrs = F.when(
        v2,
        F.map_filter(F.create_map(
            F.lit("page"), F.col("event_type"),
            F.lit("browser"), F.when(F.col("k") % 2 == 0,
                                     F.concat(F.lit("b"), (F.col("k") % 4).cast("string")))),
            lambda _k, v: v.isNotNull()),
    ).otherwise(F.create_map(
        F.lit("page"), F.col("event_type"),
        F.lit("action"), F.concat(F.lit("a"), (F.col("k") % 3).cast("string"))))
    return e.select(
        F.col("event_id"),
        F.concat(F.lit("sess-"), F.col("user_id").cast("string")).alias("session_id"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user_id"),
        attrs.alias("attributes"),
        F.col("ts").alias("event_ts"),
        F.when(v2, 2).otherwise(1).alias("version"),
    )


def full_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-document-only change feed ``(seq, value)``: one JSON document per upsert."""
    f = cdc_flat_k(spark, sf_dir)
    doc = F.to_json(F.struct(
        F.col("order_id").alias("_id"), "order_id", "merchant_id", "status", "amount", "currency",
        F.when(F.col("k") % 3 != 0, iso(F.col("event_ts"))).alias("event_ts")))
    return f.where(F.col("op") != "delete").select("seq", doc.alias("value"))
