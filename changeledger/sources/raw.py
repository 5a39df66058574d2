"""Raw landing zone: date-partitioned JSON documents, extracts, file listings."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EXTRACT_PAGE_SIZE, TS_FORMAT
from ..operators.layout import distribute_for_write
from ..session import listing_parallelism

JSON_OPTS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_FORMAT}


class MissingDay(ValueError):
    """A day that should have been landed isn't there."""


def raw_land_run(df: DataFrame, root: str, run_date: str, page_size: int = EXTRACT_PAGE_SIZE) -> str:
    """Land one run's documents under the date of the run, ``root/dt=<run date>`` (O02): whatever the documents' own times say.

    A repeated run replaces its folder.  Rows are dealt to the session's writers as they come.
    """
    path = f"{root.rstrip('/')}/dt={dt.date.fromisoformat(run_date).isoformat()}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("maxRecordsPerFile", page_size).options(**JSON_OPTS).json(path)
    return path


def raw_land(df: DataFrame, root: str, date_col: str = "event_ts",
             page_size: int = EXTRACT_PAGE_SIZE, mode: str = "append") -> DataFrame:
    """Land documents as ``root/dt=YYYY-MM-DD/*.json``.

    Rows are range-distributed on (day, key hash): each writer handles a few
    neighbouring days and a hot day is split over several writers; files hold
    at most ``page_size`` documents.  Timestamps keep six fractional digits.
    Returns ``df`` with its ``dt`` column.
    """
    landed = df.withColumn("dt", F.date_format(F.col(date_col), "yyyy-MM-dd"))
    (distribute_for_write(landed, "dt").write.mode(mode).partitionBy("dt")
           .option("maxRecordsPerFile", page_size).options(**JSON_OPTS).json(root))
    return landed


def raw_scan(spark: SparkSession, root: str, date: str | None = None,
             schema=None, dates: tuple[str, str] | None = None, must_exist: bool = False) -> DataFrame:
    """Read a collection's landed documents, optionally one day (O01).  With ``must_exist`` a day that wasn't
    landed raises ``MissingDay``; else it reads as empty.

    With ``basePath`` set to the collection root, ``dt`` stays a partition
    column even when only the day folder ``dt=<date>`` is read, so one day
    costs one folder listing, not a listing of every landed day.
    """
    reader = spark.read.options(**JSON_OPTS).option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    if date is not None:
        try:
            return reader.json(f"{root.rstrip('/')}/dt={date}")
        except AnalysisException as exc:  # nothing landed that day: empty result, collection schema
            if must_exist:
                raise MissingDay(f"no documents landed for {date} in {root}") from exc
            with listing_parallelism(spark):
                return reader.json(root).where(F.col("dt") == F.lit(date).cast("date"))
    if dates is not None:
        # a day range: list only the folders of those days (globs that match nothing are skipped)
        lo, hi = (dt.date.fromisoformat(d) for d in dates)
        days = [(lo + dt.timedelta(days=i)).isoformat() for i in range((hi - lo).days)]
        try:
            return reader.json(f"{root.rstrip('/')}/dt={{{','.join(days)}}}")
        except AnalysisException:  # no landed day in the range: filter the full listing
            with listing_parallelism(spark):
                return reader.json(root).where(
                    (F.col("dt") >= F.lit(dates[0]).cast("date"))
                    & (F.col("dt") < F.lit(dates[1]).cast("date")))
    with listing_parallelism(spark):
        return reader.json(root)


def incremental_extract(df: DataFrame, mark: str | None, ts: str = "event_ts") -> DataFrame:
    """Rows strictly above the stored high-water mark."""
    if mark is None:
        return df
    return df.where(F.col(ts) > F.lit(mark).cast("timestamp_ntz"))


def high_water_mark(extracted: DataFrame, previous: str | None, ts: str = "event_ts") -> DataFrame:
    """The next mark as a one-row DataFrame (unchanged when nothing new arrived)."""
    prev = F.lit(previous).cast("timestamp_ntz")
    return extracted.agg(F.coalesce(F.max(ts), prev).alias("mark"))


def with_provenance(df: DataFrame, job: str, run_id: str) -> DataFrame:
    """Attach the source file and job metadata to every row."""
    return df.select("*", F.col("_metadata.file_name").alias("source_file"),
                     F.col("_metadata.file_path").alias("source_path"),
                     F.lit(job).alias("job_name"), F.lit(run_id).alias("run_id"))


def seed_orders(customers: DataFrame) -> DataFrame:
    """Deterministic synthetic orders, one per customer.

    Amounts fall in 10–500 with two decimals, statuses cycle through the three
    values, currency is USD; everything is an expression of the customer key,
    so reruns produce the same rows.
    """
    k = F.col("c_custkey")
    return customers.select(
        F.concat(F.lit("seed-"), k.cast("string")).alias("order_id"),
        F.concat(F.lit("m-"), (k % 5).cast("string")).alias("merchant_id"),
        F.element_at(F.array(F.lit("created"), F.lit("approved"), F.lit("refunded")),
                     (k % 3 + 1).cast("int")).alias("status"),
        (F.lit(10.0) + ((k * 37) % 49001) / 100.0).alias("amount"),
        F.lit("USD").alias("currency"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), (k % 1440).cast("int"))).alias("event_ts"),
    )
