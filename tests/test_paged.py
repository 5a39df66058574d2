"""The paged source: every document once, by pages and tasks, with a mark, and over restarts of a stream."""

import pytest
from pyspark.sql import functions as F

from changeledger.session import work_path
from changeledger.sources import paged


@pytest.fixture
def collection(spark):
    path = work_path(spark, "collection")
    docs = spark.range(2500).select(F.col("id"), F.concat(F.lit("d"), "id").alias("name"), F.when(F.col("id") % 11 != 0, F.col("id")).alias("mark"),
                                    F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("at"), F.expr("array(struct(id AS x))").alias("nested"))
    docs.repartitionByRange(3, "id").sortWithinPartitions("id").write.option("parquet.block.size", 2048).parquet(path)
    return path, docs


def load(spark, path, **options):
    return spark.read.format(paged.register(spark)).options(**{k: str(v) for k, v in options.items()}).load(path)


@pytest.mark.parametrize("page,tasks", [(1, 1), (7, 3), (1000, 100), (5000, 1)])
def test_every_document_once(spark, collection, page, tasks):
    path, docs = collection
    if page == 1:
        docs = docs.where("id < 40")
        path = work_path(spark, "small")
        docs.coalesce(1).write.parquet(path)
    df = load(spark, path, pageSize=page, pagesPerTask=tasks)
    assert df.columns == [*docs.columns, "source_file", "document_no"]
    assert sorted(map(tuple, df.select(*docs.columns).collect())) == sorted(map(tuple, docs.collect()))
    places = df.select("source_file", "document_no").collect()
    assert len(set(places)) == len(places)
    per_file = {f: sorted(r.document_no for r in places if r.source_file == f) for f, _ in places}
    assert all(n == list(range(len(n))) for n in per_file.values())


def test_pages_are_read_side_by_side(spark, collection):
    assert load(spark, collection[0], pageSize=100, pagesPerTask=2).rdd.getNumPartitions() >= 12


@pytest.mark.parametrize("column,since,condition", [("id", "2000", "id > 2000"), ("mark", "2100", "mark > 2100"), ("at", "2024-01-01 00:40:00", "at > timestamp_ntz'2024-01-01 00:40:00'")])
def test_documents_above_the_mark(spark, collection, column, since, condition):
    path, docs = collection
    got = load(spark, path, pageSize=50, since=since, sinceColumn=column).select("id")
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in docs.where(condition).select("id").collect())


def test_row_groups_below_the_mark_are_not_read(spark, collection, monkeypatch):
    c = paged.Collection({"path": collection[0], "since": "2400", "sinceColumn": "id"})
    read = sum(b.num_rows for f in c.files() for p in c.ranges(f, 0, c.count(f)) for b in c.read(p))
    groups = []
    for f in c.files():
        with c.open(f) as opened:
            groups += [k for k, _ in c._groups(opened, paged.Pages(f, 0, c.count(f)))]
    assert read == 99 and groups


def test_one_file_and_bad_options(spark, collection, tmp_path):
    c = paged.Collection({"path": collection[0]})
    assert load(spark, c.files()[0]).count() == c.count(c.files()[0])
    for options in ({}, {"path": "/x", "pageSize": 0}, {"path": "/x", "since": "1"}):
        with pytest.raises(ValueError):
            paged.Collection(options)
    with pytest.raises(Exception, match="give a schema"):
        load(spark, str(tmp_path)).count()


def run(spark, path, out, ckpt):
    q = (spark.readStream.format(paged.register(spark)).option("path", path).option("pageSize", 64).load().select("id")
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return sorted(r.id for r in spark.read.schema("id long").parquet(out).collect())


def test_a_stream_resumes_behind_its_token(spark):
    path, out, ckpt = (work_path(spark, n) for n in ("follow", "followed", "ckpt"))
    seen = 0
    for n in range(3):
        spark.range(seen, seen + 300 + n).repartition(2).write.parquet(f"{path}/dt=2024-01-0{n + 1}")
        seen += 300 + n
        assert run(spark, path, out, ckpt) == list(range(seen))
    assert run(spark, path, out, ckpt) == list(range(seen))  # nothing new


def test_token_within_a_file(spark, collection):
    """A token may stand inside a file: the rest of it follows."""
    reader = paged._StreamReader({"path": collection[0], "pageSize": "10", "pagesPerTask": "3"})
    files = paged.Collection({"path": collection[0]}).files()
    parts = reader.partitions({"file": files[0], "documents": 25}, {"file": files[1], "documents": 5})
    count = paged.Collection({"path": collection[0]}).count(files[0])
    assert [(p.file, p.first, p.last) for p in parts][0] == (files[0], 25, 55) and (parts[-1].file, parts[-1].first, parts[-1].last) == (files[1], 0, 5)
    assert sum(p.last - p.first for p in parts) == count - 25 + 5
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == count - 25 + 5


def test_tasks_do_not_decode_a_large_row_group_again_and_again(spark, monkeypatch):
    """Few ranges share a row group, a file gives a bounded number of tasks, and a range stops reading at its end."""
    path = work_path(spark, "one-group")
    spark.range(6000).coalesce(1).write.parquet(path)
    c = paged.Collection({"path": path, "pageSize": "10", "pagesPerTask": "2"})
    parts = c.ranges(c.files()[0], 0)
    assert len(parts) <= paged.GROUP_TASKS and all(p.first % 10 == 0 for p in parts)
    assert sorted(i for p in parts for b in c.read(p) for i in b.column("document_no").to_pylist()) == list(range(6000))
    decoded = []

    class Counted(paged.pq.ParquetFile):
        def iter_batches(self, *args, **kwargs):
            for batch in super().iter_batches(*args, **kwargs):
                decoded.append(batch.num_rows)
                yield batch

    monkeypatch.setattr(paged.pq, "ParquetFile", Counted)
    list(c.read(parts[0]))
    assert sum(decoded) <= parts[0].last + c.page
    small = work_path(spark, "many-groups")
    spark.range(3000).coalesce(1).write.option("parquet.block.size", 64).option("parquet.page.size.row.check.min", 1).parquet(small)
    monkeypatch.setattr(paged, "FILE_TASKS", 7)
    c = paged.Collection({"path": small, "pageSize": "1", "pagesPerTask": "1"})
    assert len(c.ranges(c.files()[0], 0)) <= 7
