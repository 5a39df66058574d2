"""Content-addressed WARC archive (operator 3).

An archive is two Parquet datasets.  ``payloads`` stores the bytes of each distinct payload once, under its SHA-256.
The grouping is by digest and bytes together, so the aggregation compares the bytes, and two payloads under one digest
stop the run.  ``headers`` keeps the exact header block of each record.  A join on the digest gives the original records
back; reading recomputes every digest and length and fails on a difference.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, that with the smallest page id is the response and the
others are revisits of it; with several such rows, the first by row number.  Smaller payloads are all responses.

Defined results: null html is an empty payload; a null page id is larger than any other; a null url gives no target
line; line ends in a url are percent-encoded; an empty table gives an empty archive; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, text_or_empty

MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write(pages: DataFrame, folder: str, date: str = DATE) -> None:
    """Archive ``pages`` (page_id, url, html) under ``folder``; ``date`` is the records' WARC-Date."""
    rows = pages.select(F.monotonically_increasing_id().alias("rid"), F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), text_or_empty("html").alias("payload")) \
        .withColumn("digest", F.sha2("payload", 256))
    slim = stored(rows.select("rid", "page_id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes")), "op3-rows")
    rows.groupBy("digest", "payload").agg(F.min("page_id").alias("owner"), F.count(F.lit(1)).alias("records")) \
        .write.option("compression", "zstd").parquet(f"{folder}/payloads")
    one = F.col("payloads") == 1
    groups = pages.sparkSession.read.parquet(f"{folder}/payloads").groupBy("digest").agg(
        F.first("owner").alias("owner"), F.sum("records").alias("records"), F.count(F.lit(1)).alias("payloads"))
    shared = groups.where((F.col("records") > 1) | ~one).select(
        "digest", F.when(one, F.col("owner")).otherwise(F.raise_error(F.lit("two payloads under one digest")).cast("long")).alias("owner"))
    first = (slim.where(F.col("bytes") >= MIN_REVISIT).join(shared, "digest").where(F.col("page_id").eqNullSafe(F.col("owner")))
             .groupBy("digest").agg(F.min("rid").alias("first_rid"), F.first("owner").alias("owner")))
    joined = slim.join(first, "digest", "left")
    revisit = F.col("first_rid").isNotNull() & (F.col("first_rid") != F.col("rid"))

    def line(name: str, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:x-record:"), F.col("rid"), F.lit(">"))), line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", url)).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(F.col("page_id").isNotNull(), line("X-Page-Id", F.col("page_id"))).otherwise(""),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)),
                                 line("WARC-Refers-To", F.concat(F.lit("<urn:x-record:"), F.col("first_rid"), F.lit(">"))),
                                 F.when(F.col("owner").isNotNull(), line("X-Refers-To-Page", F.col("owner"))).otherwise(""))).otherwise(""),
        line("Content-Type", F.lit("text/html")), line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))), F.lit("\r\n"))
    joined.select("rid", "digest", header.alias("header")).write.option("compression", "zstd").parquet(f"{folder}/headers")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """rid, record (the exact bytes) and payload (a revisit's is that of the record it refers to)."""
    headers, payloads = spark.read.parquet(f"{folder}/headers"), spark.read.parquet(f"{folder}/payloads").select("digest", "payload")
    body = F.when(F.col("header").startswith("WARC/1.1\r\nWARC-Type: revisit\r\n"), "").otherwise(F.col("payload"))
    return headers.join(payloads, "digest").select("rid", F.concat(F.col("header"), body, F.lit("\r\n\r\n")).cast("binary").alias("record"),
                                                   F.col("payload").cast("binary").alias("payload"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, parsed from the records and verified."""
    text = F.col("record").cast("string")
    head = F.substring_index(text, "\r\n\r\n", 1)

    def value(name: str):
        found = F.regexp_extract("head", rf"\r\n{name}: ([^\r\n]*)", 1)
        return F.when(found == "", None).otherwise(found)

    rows = records(spark, folder).select("record", "payload", F.sha2("payload", 256).alias("payload_digest"),
                                         F.octet_length("payload").cast("long").alias("payload_bytes"), head.alias("head"))
    body = F.octet_length("record") - F.octet_length("head") - 8
    right = (value("WARC-Payload-Digest") == F.concat(F.lit("sha256:"), F.col("payload_digest"))) & \
        (value("Content-Length").cast("long") == body) & \
        (F.when(value("WARC-Type") == "revisit", 0).otherwise(F.col("payload_bytes")) == body)
    checked = F.when(right, F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("damaged record: "), F.col("head"))))
    return rows.select(value("X-Page-Id").cast("long").alias("page_id"), "payload_bytes", checked.alias("payload_digest"),
                       value("WARC-Type").alias("record_type"), value("X-Refers-To-Page").cast("long").alias("refers_to"))
