"""Row numbers hold when later scans of the same input are split otherwise, as after the loss of an executor."""

import random
from collections import Counter

import pytest

from changeledger.llm import common, components, exact, mixing, repeats, simhash

from .conftest import prose
from .test_op9_repeats import brute

SPLIT = "spark.sql.files.minPartitionNum"


@pytest.fixture
def resplit(spark, monkeypatch):
    """Scans after the first stored table see other splits than those before."""
    stored = common.stored

    def then_resplit(*args, **kwargs):
        out = stored(*args, **kwargs)
        spark.conf.set(SPLIT, "64")
        return out

    for module in (common, components, exact, mixing, repeats, simhash):
        monkeypatch.setattr(module, "stored", then_resplit)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set(SPLIT, "1")
    yield
    spark.conf.unset("spark.sql.files.openCostInBytes")
    spark.conf.unset(SPLIT)


def documents(spark, folder):
    """80 texts in 8 files, each twice: ids i and 100 + i."""
    rng = random.Random(4)
    rows = [(i + k, t, "ab"[i % 2]) for i, t in enumerate(prose(rng, 60) for _ in range(80)) for k in (0, 100)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8).write.parquet(str(folder))
    return spark.read.parquet(str(folder)), rows


def test_exact_dedup(spark, tmp_path, resplit):
    docs, rows = documents(spark, tmp_path / "d")
    assert sorted(map(tuple, exact.deduplicated(docs, keep="last").collect())) == sorted(r for r in rows if r[0] >= 100)


def test_simhash_dedup(spark, tmp_path, resplit):
    docs, rows = documents(spark, tmp_path / "d")
    assert sorted(map(tuple, simhash.deduplicated(docs, max_bits=0).collect())) == sorted(r for r in rows if r[0] < 100)


def test_mixing(spark, tmp_path, resplit):
    docs, rows = documents(spark, tmp_path / "d")
    plan = {r.doc_id: r.repeats for r in mixing.mix(docs).collect()}
    spark.conf.set(SPLIT, "1")
    assert len(plan) == len(rows) and len(set(plan.values())) > 1
    assert Counter(map(tuple, mixing.mixed(docs).collect())) == Counter({r: plan[r[0]] for r in rows if plan[r[0]]})


def test_repeats(spark, tmp_path, resplit):
    docs, rows = documents(spark, tmp_path / "d")
    report = repeats.Repeats(docs).report().select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, report.collect())) == brute([r[:2] for r in rows])
