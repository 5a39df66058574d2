"""Phrases, cuts, coverage and ranks against a plain count of everything."""

import random
import re
from collections import Counter

import pytest

from changeledger.llm import phrases
from changeledger.llm import queries as Q

from .conftest import SCHEMA, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, covered=50, reported=2000):
    """rows of (lang, text) → all result rows."""
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for n in (1, 2, 3):
                f.update((lang, tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    candidates = {(lang, p): a for (lang, p), a in f.items() if len(p) > 1 and a >= least}
    drop = {(lang, p[i:i + 2]) for (lang, p), a in candidates.items() if len(p) == 3 for i in (0, 1)
            if 100 * a >= covered * f[lang, p[i:i + 2]]}
    out = {}
    for (lang, p), a in candidates.items():
        if (lang, p) not in drop:
            score, _, l, r = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, k + 1, p.decode(), -a, l, r, total[lang], -s) for lang, found in out.items() for k, (s, a, p, l, r) in enumerate(sorted(found)[:reported]))


def mined(docs, **kw):
    out = phrases.mine(docs, **kw)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert all(t == "bigint" for c, t in out.dtypes if c not in ("lang", "phrase"))
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("where", ["edge_dir", "sample_dir"])
def test_query(spark, where, request):
    folder = request.getfixturevalue(where)
    want = brute(rows_of(spark, folder, "lang", "text"))
    assert want
    assert sorted(map(tuple, Q.QUERIES["op13_phrase_streams"](spark, folder).collect())) == want


def test_empty_table(spark, empty_dir):
    assert Q.QUERIES["op13_phrase_streams"](spark, empty_dir).count() == 0


def few_words(n, letters, seed):
    rng = random.Random(seed)
    return [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice([*letters, "The", "the", "é", "日"]) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "-"]) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("ranges", [1, 7, 60])
def test_phrases_that_cross_ranges(spark, ranges):
    """Few words, so that all phrases share beginnings and endings, dealt to more ranges than a language has words."""
    rows = few_words(150, "abcd", ranges)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert mined(spark.createDataFrame(rows, "lang string, text string"), least=2) == brute(rows, least=2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_limits_of_batches_and_filter_change_nothing(spark, monkeypatch):
    rows = few_words(200, "abcdefgh", 9)
    monkeypatch.setattr(phrases, "MAX_BITS", 1 << 10)
    monkeypatch.setattr(phrases, "BATCH_BYTES", 300)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert mined(docs, least=3, covered=70, reported=5) == brute(rows, 3, 70, 5)


def test_hot_word_and_phrase(spark):
    rows = [("en", "a a a a a b. of the")] * 900 + few_words(100, "xyz", 2) + [(None, None), ("en", ""), ("en", "a " * 4000)]
    assert mined(spark.createDataFrame(rows, "lang string, text string")) == brute(rows)


def test_counts_beyond_64_bits(spark):
    """The products of counts of a hundred billion: the cut's arithmetic alone, by streams of given counts."""
    a, l, r = 10**11, 3 * 10**12, 7 * 10**12
    streams = [spark.createDataFrame(rows, "lang string, phrase string, f long") for rows in
               ([("x", "p", l), ("x", "q", r)], [("x", "p q", a)], [("x", "p p p", 0)])]
    old = phrases.frequent_phrases
    phrases.frequent_phrases = lambda *_: ([streams[0], streams[1], streams[2].limit(0)], spark.createDataFrame([("x", 10**13)], "lang string, n long"))
    try:
        assert mined(spark.createDataFrame([], SCHEMA)) == [("x", 1, "p q", a, l, r, 10**13, 10**6 * a * a // (l * r))]
    finally:
        phrases.frequent_phrases = old
