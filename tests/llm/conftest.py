"""Documents with nulls, empty and long texts, ties, repeated rows and extra columns, as a table folder."""

import random

import pytest
from pyspark.sql import types as T

WORDS = "the house was built near a river by people who liked quiet water and old trees".split()


def prose(rng, n):
    out = []
    while len(out) < n:
        s = [rng.choice(WORDS) + rng.choice(["", "", "", "s", "ed", "ing"]) for _ in range(rng.randint(6, 14))]
        out += [s[0].capitalize(), *s[1:-1], s[-1] + "."]
    return " ".join(out[:n])


def edge_rows():
    """(doc_id, text, lang, source, n_chars, and columns whose names the operators use themselves)."""
    rng = random.Random(7)
    base = prose(rng, 400)
    passage = prose(rng, 80)
    texts = [prose(rng, rng.randint(60, 300)) for _ in range(25)]
    texts += [base, base, base.upper(), base.replace("river", "lake", 1), base + " End."]
    texts += [prose(rng, 120) + " " + passage + " " + prose(rng, 90) for _ in range(4)]
    texts += ["", None, None, "", " ", "\n\n\t", "one", "ONE", "é ñ ü — “x”", "a\r\nb\tc  d", "12 34", "\x00", "!!!",
              "<|endoftext|> a", "日本語 の 文章", "ab" * 900, "\U0001f600 smile " * 40, prose(rng, 9000), "x " * 3000]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "S", None, "é"]), len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[25], (None, "no id", "en", None, 5), (None, None, None, None, None),
             (7, "same id, other text", "en", "s1", 3), (2**40, base, None, "", 1)]
    return [r + (1, "h", 2.0, "k") for r in rows]


SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()), ("rid", T.LongType()), ("hash", T.StringType()), ("size", T.DoubleType()),
    ("fp", T.StringType())]])


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("edge"))
    spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    return d


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    return d


@pytest.fixture(scope="session")
def sample_dir():
    return "/root/testdata/sf0.001"


def rows_of(spark, folder, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*columns).collect()]
