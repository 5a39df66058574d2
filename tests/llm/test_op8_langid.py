import random
import zlib

import numpy as np
import pytest

from changeledger.llm import langid
from changeledger.llm import queries as Q

from .conftest import rows_of


def folded(text):
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "


def brute_phrases(text, training, other):
    """Greedy longest matches by substring search, from the first symbol to the last."""
    s = folded(text)
    n = i = 0
    while i < len(s):
        k = 0
        while i + k < len(s) and s[i:i + k + 1] in training and s[i + k] not in other:
            k += 1
        i += max(1, k)
        n += 1
    return n, len(s)


@pytest.mark.parametrize("stretch", [1, 2, 3, 7, 40])
def test_stretches_do_not_break_the_parse(monkeypatch, stretch):
    """Also where the parse of a stretch never meets the one before: periodic texts, and texts that the training holds whole."""
    rng = random.Random(stretch)
    whole = "".join(rng.choices("abc ", k=300))
    training = {"p": ["abcabc" * 40], "q": [whole], "r": ["".join(rng.choices("ab", k=200))]}
    monkeypatch.setattr(langid, "STRETCH", stretch)
    p = langid.Parser(training)
    texts = ["abc" * 50, "bcab" * 30, whole, whole[7:150] + whole, "".join(rng.choices("abcd ", k=200)), "a", "ab" * 60, "z" * 50]
    count, _ = p.phrases(texts)
    joined = {k: "".join(" " + folded(t) for t in v) for k, v in training.items()}
    for t, c in zip(texts, count):
        for k, lang in enumerate(p.languages):
            assert int(c[k]) == brute_phrases(t, joined[lang], "")[0], (t, lang)


def test_languages_with_hardly_any_text_take_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    for tiny in ("ok", "Saluton mondo"):
        extra = spark.createDataFrame([(10**9, tiny, "xx")], "doc_id long, text string, lang string")
        tested = [r for r in langid.identify(docs.unionByName(extra, allowMissingColumns=True)).collect() if r.held_out and lang.get(r.doc_id)]
        assert sum(r.lang_pred == lang[r.doc_id] for r in tested) >= 0.98 * len(tested)
        assert not any(r.lang_pred == "xx" for r in tested)


def test_many_languages_in_bounded_memory():
    rng = random.Random(8)
    training = {}
    for k in range(200):
        letters = [chr(0x100 + rng.randrange(0x500)) for _ in range(25)]
        letters = [c for c in letters if c.isalpha() and c.lower() == c] or ["a"]
        training[f"l{k:03d}"] = ["".join(rng.choices([*letters, " "], k=langid.CHARS_PER_ROW)) for _ in range(langid.SAMPLE_ROWS // 200)]
    p = langid.Parser(training)
    held = sum(x.nbytes for x in (p.table, p.rare, p.rare_to, p.of_char))
    assert held < 300e6
    texts = [t[100:400] for t in (training["l007"][3], training["l150"][0])]
    assert p.predict(texts)[0] == ["l007", "l150"]


def test_the_sample_is_bounded_over_all_languages(spark):
    rows = [(i, f"text of language number {i % 700} word{i}", f"l{i % 700}") for i in range(7000)]
    got = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(got) == 700 and sum(map(len, got.values())) <= langid.SAMPLE_ROWS


def test_phrase_counts_match_substring_search():
    rng = random.Random(1)
    alphabet = "abcdeé "
    training = {k: ["".join(rng.choices(alphabet, w, k=400)) for _ in range(2)] for k, w in [("x", [5, 4, 3, 2, 1, 1, 3]), ("y", [1, 2, 3, 4, 5, 1, 3])]}
    p = langid.Parser(training)
    texts = ["a", "Abc, bca!  ddd", "zzz q", "é" * 30, "\x00 a", "日本 abc"] + ["".join(rng.choices(alphabet + "zA.", k=n)) for n in (10, 1023, 1024, 1025, 5000)]
    count, n = p.phrases(texts)
    joined = {k: "".join(" " + folded(t) for t in v) for k, v in training.items()}
    for t, c, m in zip(texts, count, n):
        for k, lang in enumerate(p.languages):
            assert (int(c[k]), int(m)) == brute_phrases(t, joined[lang], ""), (t, lang)


def test_automaton_accepts_exactly_the_substrings():
    rng = random.Random(2)
    s = rng.choices(range(3), k=60)
    table = langid.suffix_automaton(s, 3)
    words = {tuple(s[i:j]) for i in range(60) for j in range(i + 1, min(60, i + 6) + 1)}
    for w in np.ndindex(3, 3, 3, 3, 3):
        state = 0
        for c in w:
            state = table[state, c]
            if not state:
                break
        assert bool(state) == (tuple(w) in words)


def test_held_out_accuracy_and_reruns(spark):
    d = "/root/testdata/sf0.01"
    lang = dict(rows_of(spark, d, "doc_id", "lang"))
    rows = Q.op8(spark, d).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    tested = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in tested) >= 0.98 * len(tested) > 0
    assert all(0 <= r.score <= 1 for r in rows)
    assert sorted(Q.op8(spark, d).collect()) == sorted(rows)


def test_held_out_labels_are_not_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from pyspark.sql import functions as F
    changed = docs.withColumn("lang", F.when(langid.held_out(), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    assert sorted(langid.identify(changed).collect()) == sorted(langid.identify(docs).collect())


@pytest.mark.parametrize("where", ["edge_dir", "empty_dir"])
def test_defined_results(spark, where, request):
    d = request.getfixturevalue(where)
    rows = rows_of(spark, d, "doc_id", "text")
    got = Q.op8(spark, d).collect()
    no_letter = sum(t is None or not any(map(str.isalpha, t)) for _, t in rows)
    assert len(got) == len(rows) and sum(r.lang_pred == "und" for r in got) == no_letter
    assert all(r.score == 0 for r in got if r.lang_pred == "und")


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in langid.identify(docs).collect()} == {("und", 0.0)}


def scripts(rng, n):
    """Texts of languages in three scripts, with over 800 letters together; two of the languages share a script."""
    def words(letters):
        own = ["".join(rng.choices(letters, k=rng.randint(2, 5))) for _ in range(400)]
        return [" ".join(rng.choices(own, k=60)) for _ in range(n)]

    han = [chr(c) for c in range(0x4E00, 0x4E00 + 700)]
    return {"en": words("abcdefghijklmnopqrstuvwxyz"), "ru": words("абвгдежзийклмнопрстуфхцчшщъыьэюя"), "yue": words(han[:500]), "zh": words(han[200:])}


@pytest.mark.parametrize("letters", [61, 62, 63, 64, 65, 700])
def test_phrase_counts_with_many_letters(letters):
    """Also where the letters just fill the table of steps."""
    rng = random.Random(letters)
    chars = [chr(0x4E00 + k) for k in range(letters)]
    training = {k: ["".join(chars) + " " + "".join(rng.choices([*part, " "], k=700)) for _ in range(2)]
                for k, part in [("x", chars), ("y", chars[:20]), ("z", chars[-20:])]}
    p = langid.Parser(training)
    texts = ["".join(rng.choices([*chars, " ", "ก", "q"], k=n)) for n in (30, 1025, 2500)] + [training["z"][1][:600], "qก"]
    count, n = p.phrases(texts)
    joined = {k: "".join(" " + folded(t) for t in v) for k, v in training.items()}
    for t, c, m in zip(texts, count, n):
        for k, lang in enumerate(p.languages):
            assert (int(c[k]), int(m)) == brute_phrases(t, joined[lang], ""), (t, lang)


def test_three_scripts(spark):
    texts = scripts(random.Random(6), 30)
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in texts.items() for t in ts)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert sum(r.held_out for r in got) > 20
    assert {r.doc_id: r.lang_pred for r in got} == {i: lang for i, _, lang in rows}
