"""Operators 3, 4 and 5 against their oracle SQL on awkward tables, and op2 against its law."""

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from changeledger.llm import archive, exact, mixing, slots
from changeledger.llm import queries as Q

from .conftest import rows_of


def norm(rows):
    return Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


def against_oracle(spark, name, folder, table="documents"):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    cur = con.execute(Q.ORACLE[name])
    cols = [d[0] for d in cur.description]
    got = Q.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(cols)
    return norm(map(tuple, got.select(*cols).collect())), norm(cur.fetchall())


@pytest.fixture(scope="module")
def plain_dir(spark, edge_dir, tmp_path_factory):
    """The edge documents with one row per id and no null ids: where SQL has no ties to break."""
    d = str(tmp_path_factory.mktemp("plain"))
    spark.read.parquet(f"{edge_dir}/documents.parquet").where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]) \
        .write.parquet(f"{d}/documents.parquet")
    return d


@pytest.mark.parametrize("name", ["op4_source_mixing", "op5_exact_dedup"])
def test_document_operators_match_sql(spark, plain_dir, name):
    got, want = against_oracle(spark, name, plain_dir)
    assert got == want


@pytest.mark.parametrize("name", ["op2_virtual_slots", "op4_source_mixing", "op5_exact_dedup"])
def test_empty_table(spark, empty_dir, name):
    assert Q.QUERIES[name](spark, empty_dir).collect() == []


# ---- exact dedup ----

def test_exact_dedup_keeps_one_row_of_each_text(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    low = str.maketrans(exact.UPPER, exact.LOWER)
    groups = defaultdict(list)
    for i, t in rows_of(spark, edge_dir, "doc_id", "text"):
        groups[(t or "").translate(low)].append(i)
    for keep, best in (("last", max), ("first", min)):
        out = exact.dedup(docs, keep).collect()
        assert len(out) == sum(map(len, groups.values())) and sum(r.kept for r in out) == len(groups)
        want = Counter((best((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for _ in g)
        assert Counter((r.keep_id, r.group_size) for r in out) == want
        assert all(r.doc_id == r.keep_id for r in out if r.kept)
    rest = exact.deduplicated(docs, "last")
    assert rest.columns == docs.columns and rest.count() == len(groups)


def test_colliding_hashes_stay_apart(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    right = exact.dedup(docs).drop("rid").collect()
    for weak in (lambda c: F.lit(b"x"), lambda c: F.substring(F.md5(c), 1, 1)):
        assert norm(exact.dedup(docs, content_hash=weak).drop("rid").collect()) == norm(right)


# ---- mixing ----

def fixpoint(size, weight, total, epochs):
    """Clamp, redistribute by weight, repeat."""
    target, free = {}, set(size)
    while True:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= epochs * size[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = epochs * size[s]
            free.discard(s)
        if not free:
            return target


@pytest.mark.parametrize("sizes", [[10, 1000, 3, 500], [5, 5, 5], [0, 0, 7], [1], [100, 1, 1, 1, 1, 1, 90000], [0]])
def test_water_filling_equals_the_fixpoint(spark, sizes):
    names = [f"s{i:02d}" for i in range(len(sizes) - 1)] + [None]
    frame = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = fixpoint(dict(zip(names, sizes)), {n: mixing.WEIGHTS[i % 3] for i, n in enumerate(names)}, 1.5 * sum(sizes), 2.0)
    assert all(math.isclose(got[n], want[n], abs_tol=1e-6) for n in names)


def test_mix_is_near_its_targets(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    rows = mixing.mix(docs).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert 0 <= r.taken <= 2 * r.size
    for own in by.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1e-6
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r.repeats for r in rows)


# ---- slots ----

def test_shards_hold_near_equal_bytes_in_gapless_places(spark, edge_dir, sample_dir):
    for d in (edge_dir, sample_dir):
        rows, text = Q.op2(spark, d).collect(), rows_of(spark, d, "doc_id", "text")
        raw = [(i, (t or "").encode()) for i, t in text]
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((i, len(b) + 1, zlib.crc32(b)) for i, b in raw)
        places, sizes = defaultdict(list), Counter()
        for r in rows:
            places[r.shard].append(r.slot)
            sizes[r.shard] += r.size
        assert all(sorted(p) == list(range(len(p))) for p in places.values())
        biggest = max(r.size for r in rows)
        assert max(sizes.values()) <= max(biggest, 1.01 * sum(sizes.values()) / 8 + 50)


def test_a_hot_record_is_split_and_rebalancing_moves_little(spark, tmp_path):
    docs = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("doc_id"),
                                    F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.repeat(F.lit("a"), (F.col("id") % 50).cast("int"))).alias("text"))
    rows, folder = slots.records(docs), str(tmp_path / "map")
    load = slots.loads(rows)
    one = slots.first_map(load, 8)
    size = Counter()
    for e in one:
        size[e.shard] += e.bytes
    assert max(size.values()) <= 1.02 * sum(size.values()) / 8
    assert any(e.part != slots.ALL_PARTS for e in one) and sum(e.rows for e in one) == 6000
    two = slots.rebalanced(one, load, 9)
    home = {(e.slot, e.part): e.shard for e in one}
    moved = sum(e.bytes for e in two if home[(e.slot, e.part)] != e.shard)
    size = Counter()
    for e in two:
        size[e.shard] += e.bytes
    assert moved <= 1.05 * sum(size.values()) / 9 and max(size.values()) <= 1.05 * sum(size.values()) / 9
    slots.write_map(spark, folder, 1, one)
    slots.write_map(spark, folder, 2, two)
    assert sorted(map(str, slots.read_map(spark, folder, 2))) == sorted(map(str, two))
    placed = slots.assign(rows, load, slots.read_map(spark, folder, 2)).groupBy("shard").agg(
        F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert len(placed) == 9 and all(r.n == r.d == r.m + 1 for r in placed)
    with pytest.raises(Exception):
        slots.write_map(spark, folder, 2, two)


# ---- archive ----

LONG = "<html>" + "x" * 200 + "</html>\r\n\r\nWARC-Type: revisit\r\n"
PAGES = [(1, "http://a/1", LONG), (2, "http://a/2\r\nX-Page-Id: 9", LONG), (3, None, LONG), (4, "u", None), (5, "u", ""),
         (6, "u", "short"), (7, "u", "short"), (8, "é", "é" * 50), (9, "é", "é" * 50), (10, "é", "é" * 49)]
PAGE_SCHEMA = "page_id long, url string, html string, digest int, header string, rid int"


def test_archive_matches_sql(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(*r, 1, "h", 2) for r in PAGES], PAGE_SCHEMA).repartition(3).write.parquet(f"{d}/pages.parquet")
    got, want = against_oracle(spark, "op3_warc_archive", d, "pages")
    assert got == want


def test_archive_with_repeated_and_null_ids(spark, tmp_path):
    rows = [(None, "u", LONG), (5, "u", LONG), (5, "u", LONG), (None, "u", "z" * 300), (None, None, "z" * 300), (None, None, None)]
    folder = str(tmp_path / "a")
    archive.write(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    out = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in archive.read(spark, folder).collect())
    assert out == Counter([(5, len(LONG), "response", None), (5, len(LONG), "revisit", 5), (None, len(LONG), "revisit", 5),
                           (None, 300, "response", None), (None, 300, "revisit", None), (None, 0, "response", None)])
    assert spark.read.parquet(f"{folder}/payloads").count() == 3
    for r in archive.records(spark, folder).collect():
        record, payload = bytes(r.record), bytes(r.payload)
        body = b"" if b"WARC-Type: revisit" in record[:40] else payload
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n" + body + b"\r\n\r\n")


def test_damaged_payload_is_found(spark, tmp_path):
    folder, other = str(tmp_path / "a"), str(tmp_path / "b")
    archive.write(spark.createDataFrame([(1, "u", "z" * 300)], "page_id long, url string, html string"), folder)
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{other}/headers")
    spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.lit("y" * 300)).write.parquet(f"{other}/payloads")
    with pytest.raises(Exception, match="damaged"):
        archive.read(spark, other).collect()


def test_empty_archive(spark, tmp_path):
    spark.createDataFrame([], PAGE_SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    assert Q.op3(spark, str(tmp_path)).collect() == []
