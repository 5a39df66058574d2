"""Ids and decoded texts against the untouched library; the lexicon against plain sets of words."""

import functools
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changeledger.llm import bpe
from changeledger.llm import queries as Q
from changeledger.llm.lexicon import Lexicon, build
from changeledger.llm.tokens import vocabulary_path

from .conftest import rows_of

PATH = vocabulary_path("byte_bpe_50k.json")
PIECES = [*"abzAB '\n\t .,!-12", "st", "'ll", "'re", " ", "\n\n", "  ", "\r\n", "é", "ß", "×", "ɏ", "ʰ", "中文", "日", "😀", "‍", "́", "ำ",
          "\x00", "\x1c", "\x7f", "\x85", "\xa0", " ", " ", " ", " ", "　", "​", "﻿", "“", "…", "٣", "Ⅷ",
          "aaaa", "<|endoftext|>", "<|endoftext", " the", " of"]


@functools.cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def file_of(words, folder):
    words = sorted(w.encode() for w in set(words) if w)
    ids, ends = bpe.merger(PATH).ids([w.decode() for w in words])
    path = folder / "lexicon.bin"
    path.write_bytes(build(words, ids, ends))
    return Lexicon(str(path)), words


def same(texts, coder):
    lib = library()
    ids, ends = coder.encode(pa.array(texts, pa.large_string()))
    at = 0
    for text, end in zip(texts, ends.tolist()):
        want = lib.encode(text, add_special_tokens=False).ids
        assert ids[at:end].tolist() == want, text
        assert coder.decode(ids[at:end]) == lib.decode(want, skip_special_tokens=False)
        at = end
    assert at == len(ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=20))
def test_any_text_by_merging(texts):
    same(texts, bpe.Encoder(bpe.merger(PATH), None))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=20))
def test_any_character(texts):
    same(texts, bpe.Encoder(bpe.merger(PATH), None))


def test_lexicon_changes_no_id(tmp_path):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    words = [w for w in bpe.cut(pa.array(texts, pa.large_string()))[0].to_pylist() if rng.random() < 0.5]
    lexicon, _ = file_of(words, tmp_path)
    same(texts, bpe.Encoder(bpe.merger(PATH), lexicon))


def test_long_words():
    same(["a" * 5000, "ab" * 3000, " " * 700, "x" + " " * 300 + "y", "!" * 2000, "é" * 400, "", "ab-" * 300], bpe.Encoder(bpe.merger(PATH), None))


def test_lexicon_finds_its_words_and_no_other(tmp_path):
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(800)}
    inside = set(rng.sample(sorted(words), len(words) // 2))
    lexicon, order = file_of(inside, tmp_path)
    found = lexicon.find(pa.array(sorted(words) + [""], pa.large_string())).tolist()
    assert found == [order.index(w.encode()) if w in inside else -1 for w in sorted(words)] + [-1]


def test_lexicon_is_minimal(tmp_path):
    """As many states as different sets of endings, and equal endings stored once."""
    words = [a + b for a in ("w", "talk", "play", "x") for b in ("", "s", "ed", "ing")]
    lexicon, order = file_of(words, tmp_path)
    endings = {frozenset(w[len(p):] for w in order if w.startswith(p)) for w in order for p in (w[:k] for k in range(len(w) + 1))}
    assert len(lexicon.final) == len(endings)


def test_empty_lexicon(tmp_path):
    lexicon, _ = file_of([], tmp_path)
    assert lexicon.find(pa.array(["a", ""], pa.large_string())).tolist() == [-1, -1]


def digest(text):
    ids = library().encode(text or "", add_special_tokens=False).ids
    decoded = library().decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize("where", ["edge_dir", "sample_dir"])
def test_query_against_the_library(spark, where, request):
    folder = request.getfixturevalue(where)
    got = Q.QUERIES["op12_lexicon_bpe"](spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter((i, *digest(t)) for i, t in rows_of(spark, folder, "doc_id", "text"))


def test_empty_table(spark, empty_dir):
    assert Q.QUERIES["op12_lexicon_bpe"](spark, empty_dir).count() == 0


def test_round_trip_keeps_other_columns(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    out = bpe.decode(bpe.encode(docs, PATH, bpe.lexicon(docs, PATH, max_words=50)), PATH)
    assert out.columns == [*docs.columns, "ids", "decoded"]
    assert all(r.decoded == (r.text or "") for r in out.collect())


def test_word_counts_cover_all_texts(spark, edge_dir):
    texts = [t or "" for t, in rows_of(spark, edge_dir, "text")]
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    got = {r.word: r.n for r in bpe.word_counts(docs).collect()}
    words, upto = bpe.cut(pa.array(texts, pa.large_string()))
    assert got == Counter(words.to_pylist())
    assert ["".join(words.to_pylist()[i:j]) for i, j in zip(np.append(0, upto[:-1]), upto)] == texts


def test_small_limits_change_nothing(spark, edge_dir, monkeypatch):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    want = Counter(map(tuple, bpe.digests(docs, PATH, bpe.lexicon(docs, PATH)).collect()))
    assert Counter(map(tuple, bpe.digests(docs, PATH, bpe.lexicon(docs, PATH, max_words=3)).collect())) == want
    assert Counter(map(tuple, bpe.digests(docs, PATH).collect())) == want
