"""Many small files: one file each, not a checksum file beside it, and the same rows and files as before."""

import glob
import os

from pyspark.sql import functions as F

from changeledger.operators import layout as lay
from changeledger.session import work_path


def test_small_files_have_no_file_beside_them(spark):
    rows = spark.range(1000).select(F.col("id"), (F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 200)).cast("timestamp_ntz").alias("event_ts"))
    path = work_path(spark, "small")
    lay.write_days(rows, path, max_records=20)
    folder = path.removeprefix("file://").removeprefix("file:")
    data = glob.glob(f"{folder}/*/*.parquet")
    assert len(data) >= 50 and not [n for f in data for n in glob.glob(f"{os.path.dirname(f)}/.{os.path.basename(f)}.crc")]
    back = spark.read.parquet(path)
    assert sorted(r.id for r in back.collect()) == list(range(1000))
    assert back.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0] <= 20
    new = lay.compact_files(spark, path, work_path(spark, "compact"), "event_date", 1 << 28)
    assert sorted(r.id for r in spark.read.parquet(new).collect()) == list(range(1000))
    lay.write_days(rows.where("id < 500"), path, max_records=20)  # written again over itself
    assert spark.read.parquet(path).count() == 500


def test_other_stores_keep_their_file_system():
    for path in ("hdfs://host/x", "s3a://bucket/x", "dbfs:/x"):
        assert lay.small_file_options(path) == {}
    for path in ("/x/y", "file:/x", "file:///x"):
        assert lay.small_file_options(path)
