import zlib

import numpy as np
import pytest

from changeledger.llm import queries as Q
from changeledger.llm import rans
from changeledger.llm.tokens import encoder, vocabulary_path

from .conftest import rows_of

VOCAB = "word_bpe_49k.json"


def ids(text, end):
    e = encoder(vocabulary_path(VOCAB))
    return np.array(e.tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.mark.parametrize("where", ["edge_dir", "sample_dir"])
def test_digests_match_direct_encoding(spark, where, request):
    d = request.getfixturevalue(where)
    got = sorted(map(tuple, Q.op1(spark, d).collect()), key=lambda r: r[1])
    rows = {(i, t): None for i, t in rows_of(spark, d, "doc_id", "text")}
    want = sorted((i, len(ids(t, 1)), zlib.crc32(ids(t, 1).tobytes())) for i, t in rows_of(spark, d, "doc_id", "text") if i is not None)
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] is not None) == want
    assert rows and [r[0] or -1 for r in got] == sorted(r[0] or -1 for r in got)   # ascending, nulls first
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n


def test_empty_table(spark, empty_dir):
    assert Q.op1(spark, empty_dir).collect() == []


def test_files_round_trip_over_small_blocks(spark, sample_dir, tmp_path):
    """Documents cut over many blocks come back whole; a changed byte is found."""
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    folder = str(tmp_path / "f")
    rans.write(docs, folder, vocabulary_path(VOCAB), 1, block_tokens=300)
    text = dict(rows_of(spark, sample_dir, "doc_id", "text"))
    pieces = {}
    for r in rans.read(spark, folder).collect():
        pieces.setdefault(r.doc_id, []).append((r.before, bytes(r.ids)))
    assert {k: b"".join(x for _, x in sorted(v)) for k, v in pieces.items()} == {k: ids(t, 1).tobytes() for k, t in text.items()}
    assert max(map(len, pieces.values())) > 1
    assert {(r.doc_id, r.ids_crc32) for r in rans.digests(spark, folder).collect()} == {(k, zlib.crc32(ids(t, 1).tobytes())) for k, t in text.items()}


def test_decoding_from_any_checkpoint():
    rng = np.random.default_rng(0)
    tokens = np.minimum(rng.zipf(1.3, 70_000), 900).astype(np.int64)
    i, f = rans.scaled(dict(zip(*(x.tolist() for x in np.unique(tokens, return_counts=True)))))
    assert f.sum() == 1 << rans.SCALE_BITS and f.min() >= 1
    coder = rans.Coder(i, f)
    for n, lanes in ((70_000, 512), (1, 1), (513, 512), (5000, 3)):
        states, words, marks = coder.encode(tokens[:n], lanes)
        assert (coder.decode(n, lanes, states, words, marks) == tokens[:n]).all()
        step = rans.CHECKPOINT_ROWS * lanes
        parts = [coder.decode(n, lanes, states, words, marks, k, k + 1) for k in range(len(marks) + 1)]
        assert (np.concatenate(parts) == tokens[:n]).all() and all(len(p) == step for p in parts[:-1])
    assert len(words) < 5000 * 2


def test_one_symbol_and_checksum():
    i, f = rans.scaled({5: 10})
    c = rans.Coder(i, f)
    states, words, marks = c.encode(np.full(1000, 5), 16)
    assert (c.decode(1000, 16, states, words, marks) == 5).all() and words == b""


def test_checksum_shift():
    a, b = b"some bytes", b"and more of them" * 9
    assert rans.crc32_shift(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)
