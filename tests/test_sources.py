"""Sources: extract marks, provenance, seeds, topics, raw landing layout."""

from pyspark.sql import functions as F

from changeledger.functions.cdc import topic_for
from changeledger.session import work_path
from changeledger.sources import raw as rw
from changeledger.sources import testdata as td

SF = "/root/testdata/sf0.001"


def test_high_water_mark_unchanged_when_nothing_new(spark):
    log = td.cdc_flat(spark, SF)
    late_mark = "2999-01-01 00:00:00"
    assert rw.incremental_extract(log, late_mark).count() == 0
    mark = rw.high_water_mark(rw.incremental_extract(log, late_mark), late_mark).first()["mark"]
    assert str(mark) == late_mark
    new = rw.high_water_mark(rw.incremental_extract(log, None), None).first()["mark"]
    assert new == log.agg(F.max("event_ts")).first()[0]


def test_seed_orders_are_deterministic_and_in_range(spark):
    c = td.read_table(spark, SF, "customer")
    a, b = rw.seed_orders(c), rw.seed_orders(c)
    assert a.exceptAll(b).count() == 0
    stats = a.agg(F.min("amount"), F.max("amount"), F.countDistinct("status")).first()
    assert 10 <= stats[0] and stats[1] <= 500 and stats[2] == 3


def test_provenance_names_the_source_file(spark):
    e = rw.with_provenance(td.read_table(spark, SF, "events"), "job", "r1")
    row = e.select("source_file", "job_name", "run_id").distinct().collect()
    assert [tuple(r) for r in row] == [("events.parquet", "job", "r1")]


def test_topic_names(spark):
    df = spark.range(1).select(topic_for("payments", "orders").alias("t"),
                               topic_for("payments", "orders", dead_letter=True).alias("d"))
    assert tuple(df.first()) == ("payments.cdc.orders", "payments.cdc.orders.dlq")


def test_raw_land_layout_and_page_size(spark):
    root = work_path(spark, "raw")
    rw.raw_land(td.nested_docs(spark, SF), root, page_size=2)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
             .option("recursiveFileLookup", "true").load(root).select("path"))
    assert files.where(~F.col("path").rlike(r"/dt=\d{4}-\d{2}-\d{2}/")).count() == 0
    per_file = spark.read.json(root).groupBy(F.col("_metadata.file_path")).count()
    assert per_file.agg(F.max("count")).first()[0] <= 2
    assert spark.read.json(root).count() == td.nested_docs(spark, SF).count()
