import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from changeledger.llm import packing
from changeledger.llm import queries as Q
from changeledger.llm.tokens import encoder, vocabulary_path

from .conftest import rows_of

VOCAB = "byte_bpe_50k.json"


def ids(text):
    e = encoder(vocabulary_path(VOCAB))
    return np.array(e.tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def expected(rows):
    out = Counter()
    for doc_id, text in rows:
        x = ids(text)
        n = len(x)
        first = n if n <= 1024 else n % 1024 or 1024
        cuts = [0, *range(first, n + 1, 1024)] if n > 1024 else [0, n]
        for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
            out[(doc_id, k, i, j - i, zlib.crc32(x[i:j].tobytes()))] += 1
    return out


def check(rows, got):
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected(rows)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(bins)


@pytest.mark.parametrize("where", ["edge_dir", "sample_dir"])
def test_pieces_and_places(spark, where, request):
    d = request.getfixturevalue(where)
    rows, got = rows_of(spark, d, "doc_id", "text"), Q.op10(spark, d).collect()
    n = check(rows, got)
    total = sum(r.length for r in got)
    assert n <= 1.05 * total / 1024 + 2


def test_empty_table(spark, empty_dir):
    assert Q.op10(spark, empty_dir).collect() == []


def test_tree_of_groups_packs_as_well_as_one(spark):
    rng = random.Random(3)
    rows = [(i, 0, 0, rng.choice([3, 40, 300, 511, 513, 600, 800, rng.randint(1, 1023)]), i) for i in range(3000)]
    items = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    one = packing.pack(items, 1024).select("sequence_id").distinct().count()
    got = packing.pack(items, 1024, group_items=300).collect()
    assert sorted((r.doc_id, r.length) for r in got) == sorted((r[0], r[3]) for r in rows)
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024 and len(fill) <= 1.03 * one
    assert sum(f <= 512 for f in fill.values()) <= 1


def test_best_fit_is_best_fit():
    assert packing.best_fit([6, 5, 4, 3, 2], 10) == [[0, 2], [1, 3, 4]]
    assert packing.best_fit([], 10) == []


def test_sequences_hold_the_ids(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet").where("doc_id < 40")
    items = packing.pieces(docs, vocabulary_path(VOCAB), 2, 1024, with_ids=True)
    placed = packing.pack(items.drop("ids"), 1024)
    out = {r.sequence_id: bytes(r.ids) for r in packing.sequences(placed, items).collect()}
    text = dict(rows_of(spark, sample_dir, "doc_id", "text"))
    for r in placed.collect():
        assert out[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == ids(text[r.doc_id])[r.start:r.start + r.length].tobytes()
