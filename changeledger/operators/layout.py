"""Physical layout: partitioned and bucketed writes, ordering, sizing, compaction."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MERCHANT_BUCKETS
from ..session import default_parallelism


def write_tasks(spark: SparkSession) -> int:
    """Writer task count: the session's shuffle partitions, at least the cores."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(n, default_parallelism(spark))


def distribute_for_write(df: DataFrame, part_col: str, spread: list[str] | None = None,
                         tasks: int | None = None) -> DataFrame:
    """Range-distribute rows on ``(part_col, hash(spread))`` before a partitioned write.

    Range bounds come from a sample, so a day holding a third of all rows is
    cut into about a third of the tasks, while small days share a task; each
    task writes a few neighbouring folders.  The explicit task count keeps the
    write parallel (AQE does not merge it into one task on small inputs), and
    the hash keeps the placement deterministic when a task is retried.
    """
    spread = spread or [c for c in df.columns if c != part_col][:1]
    n = tasks or write_tasks(df.sparkSession)
    return df.repartitionByRange(n, F.col(part_col), F.xxhash64(*[F.col(c) for c in spread])) \
             .sortWithinPartitions(part_col)


def with_event_date(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """The ``days(event_ts)`` partition transform as a real column."""
    return df.withColumn("event_date", F.to_date(ts))


def small_file_options(path: str) -> dict[str, str]:
    """Writer options for many small files on a local or mounted folder; none for other stores.

    Without Hadoop's native library the local file system starts a process for each file it creates, the data file and the checksum file
    beside it, and those take most of the time of a small file.  Parquet pages carry checksums of their own, so the second file is left out.
    """
    if ":" in path.split("/", 1)[0] and not path.startswith("file:"):
        return {}
    return {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true", "parquet.page.write-checksum.enabled": "true"}


def write_days(df: DataFrame, path: str, mode: str = "overwrite",
               max_records: int | None = None) -> None:
    """Partitioned by day (O10); range-distributed so hot days use several writers."""
    w = distribute_for_write(with_event_date(df), "event_date").write.mode(mode) \
        .option("partitionOverwriteMode", "static").partitionBy("event_date")
    if max_records:
        w = w.option("maxRecordsPerFile", max_records).options(**small_file_options(path))
    w.parquet(path)


def write_days_bucketed(df: DataFrame, path: str, table: str,
                        buckets: int = MERCHANT_BUCKETS, key: str = "merchant_id") -> None:
    """Partitioned by day and hash-bucketed on merchant.

    The table is registered with an explicit location, so later joins or
    aggregations on ``key`` read the buckets without a shuffle.
    """
    d = with_event_date(df)
    # writers get neighbouring (day, bucket) ranges — few files each — and a hot
    # pair is split by the row hash; pmod(hash(key), n) is the bucket Spark assigns
    spread = [c for c in d.columns if c not in (key, "event_date")][:1] or [key]
    d = d.repartitionByRange(write_tasks(d.sparkSession), F.col("event_date"),
                             F.pmod(F.hash(F.col(key)), F.lit(buckets)),
                             F.xxhash64(*[F.col(c) for c in spread]))
    (d.write.mode("overwrite").option("partitionOverwriteMode", "static").format("parquet").option("path", path)
      .partitionBy("event_date").bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def write_distributed(df: DataFrame, path: str, keys=("event_date", "merchant_id"),
                      mode: str = "overwrite") -> None:
    """Hash-distribute on the partition keys before a partitioned write.

    The ``rebalance`` hint is a hash distribution that AQE may split: a hot
    (day, merchant) pair is spread over several writers instead of one.
    """
    d = with_event_date(df)
    d.hint("rebalance", *keys).write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("event_date").parquet(path)


def write_ordered(df: DataFrame, path: str, ts: str = "event_ts", files: int | None = None,
                  mode: str = "overwrite") -> None:
    """Files sorted by ``ts`` with non-overlapping ranges (O38): range partition, then
    sort within each partition, so Parquet min/max statistics skip row groups."""
    n = files or default_parallelism(df.sparkSession)
    df.repartitionByRange(n, F.col(ts)).sortWithinPartitions(ts).write.mode(mode).parquet(path)


def write_sized(df: DataFrame, path: str, max_records: int, mode: str = "overwrite") -> None:
    """Bounded output files (O59): at most ``max_records`` rows per file."""
    df.write.mode(mode).option("maxRecordsPerFile", max_records).parquet(path)


def write_replace(df: DataFrame, path: str) -> None:
    """Create or replace a table."""
    df.write.mode("overwrite").parquet(path)


def file_stats(spark: SparkSession, root: str, partition_col: str | None = None) -> DataFrame:
    """Data files with their partition value and size."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(root)
             .select("path", "length", "modificationTime"))
    if partition_col:
        files = files.withColumn(
            partition_col, F.regexp_extract("path", rf"{partition_col}=([^/]+)", 1))
    return files


def compaction_candidates(files: DataFrame, target_bytes: int, partition_col: str,
                          min_files: int = 2, small_ratio: float = 0.75) -> DataFrame:
    """Partitions with several files averaging well below the target size."""
    g = files.groupBy(partition_col).agg(F.count(F.lit(1)).alias("files"),
                                         F.sum("length").alias("bytes"),
                                         F.avg("length").alias("avg_bytes"))
    return g.withColumn("compact", (F.col("files") >= min_files)
                        & (F.col("avg_bytes") < F.lit(target_bytes * small_ratio)))


def compact_files(spark: SparkSession, src: str, dst_root: str, partition_col: str | None,
                  target_bytes: int) -> str:
    """Rewrite small files into files near ``target_bytes`` under a new path.

    Reads the current version, rebalances with AQE's advisory size set to the
    target, and writes a new version; readers switch to the returned path, so
    no file is read and overwritten at once.
    """
    dst = f"{dst_root.rstrip('/')}/v-{uuid.uuid4().hex[:8]}"
    df = spark.read.parquet(src)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(target_bytes))
    try:
        if partition_col:
            (df.hint("rebalance", partition_col).write.mode("overwrite")
               .partitionBy(partition_col).parquet(dst))
        else:
            df.hint("rebalance").write.mode("overwrite").parquet(dst)
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)
    return dst
