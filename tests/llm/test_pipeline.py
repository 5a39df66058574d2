"""The pipeline against a brute-force version of its stages."""

import zlib
from collections import Counter

import pytest

import corpus_pipeline as P
from changeledger.llm import exact, langid, mixing

from .conftest import rows_of
from .test_op7_simhash import brute_components, brute_fingerprint
from .test_op10_packing import check


def brute(spark, d):
    """doc rows (doc_id, text, source) after stages 1 to 3; stage 1 uses the parser on one text at a time."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    parser = langid.Parser(langid.sample(docs))
    rows = [r for r in rows_of(spark, d, "doc_id", "text", "source") if parser.predict([r[1]])[0][0] != "und"]
    low = str.maketrans(exact.UPPER, exact.LOWER)
    best = {}
    for r in rows:
        k = r[1].translate(low)
        if k not in best or (r[0] if r[0] is not None else -1) > (best[k][0] if best[k][0] is not None else -1):
            best[k] = r
    rows = list(best.values())
    label = brute_components({brute_fingerprint(r[1]) for r in rows}, 4)
    first = {}
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        first.setdefault(label[brute_fingerprint(r[1])], r)
    return list(first.values())


@pytest.mark.parametrize("where", ["edge_dir", "sample_dir"])
def test_stages_match_brute_force(spark, where, request, tmp_path):
    d = request.getfixturevalue(where)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    for name, stage in P.STAGES[:3]:
        stage(spark, docs, d).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
    got = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    want = brute(spark, d)
    # Rows that tie in text and id may differ in other columns; which of them stays is free.
    assert Counter(r[:2] for r in got) == Counter(r[:2] for r in want)
    plan = mixing.mix(docs).collect()
    mixed = P.mix(spark, docs, d)
    assert mixed.columns == columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(r.doc_id for r in plan for _ in range(r.repeats))
    mixed.write.parquet(str(tmp_path / "mix"))
    mixed = spark.read.parquet(str(tmp_path / "mix"))
    check([tuple(r) for r in mixed.select("doc_id", "text").collect()], P.pack(spark, mixed, d).collect())


def test_run_gives_the_last_stage(spark, sample_dir):
    out = P.run(spark, sample_dir)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0


def test_empty_table(spark, empty_dir):
    assert P.run(spark, empty_dir).collect() == []


@pytest.mark.parametrize("lang", [None, "en"])
def test_no_language_learned(spark, tmp_path, lang):
    """All rows without a label, or all labelled rows held out."""
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    texts = ["some text", "日本語", "12 é", "", None, "12 34 !", "\n", "²"]
    rows = [(i, t, lang, "s1") for i, t in zip(ids, texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert langid.sample(docs) == {}
    assert sorted(map(tuple, P.language(spark, docs, str(tmp_path)).collect())) == rows[:3]
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()}
