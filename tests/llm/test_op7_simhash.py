import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from changeledger.llm import queries as Q
from changeledger.llm import components as hooking
from changeledger.llm import simhash
from changeledger.llm.components import components

from .conftest import rows_of

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    u = sorted(fps)
    arr = np.array(u, np.uint64)
    for f in u:
        for g in arr[np.bitwise_count(arr ^ np.uint64(f)) <= max_bits].tolist():
            a, b = find(f), find(g)
            parent[max(a, b)] = min(a, b)
    return {f: find(f) for f in u}


@pytest.mark.parametrize("where", ["edge_dir", "sample_dir", "/root/testdata/sf0.01"])
def test_query_matches_all_pairs(spark, where, request):
    d = where if where[0] == "/" else request.getfixturevalue(where)
    rows = [(i, brute_fingerprint(t)) for i, t in rows_of(spark, d, "doc_id", "text")]
    label = brute_components({f for _, f in rows}, 4)
    smallest = defaultdict(lambda: None)
    for i, f in rows:
        if i is not None and (smallest[label[f]] is None or i < smallest[label[f]]):
            smallest[label[f]] = i
    want = Counter((i, f"{f:016x}", smallest[label[f]]) for i, f in rows)
    assert Counter(map(tuple, Q.op7(spark, d).collect())) == want


def test_empty_table(spark, empty_dir):
    assert Q.op7(spark, empty_dir).collect() == []


def clusters(rng, n):
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 5, 60])):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("bucket, short", [(1 << 15, 32), (20, 4), (3, 1)])
def test_links_connect_all_close_pairs(spark, monkeypatch, bucket, short):
    """Also when nearly every bucket is too large and must be cut again."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "SHORT_RUN", short)
    rng = random.Random(bucket)
    center = rng.getrandbits(64)  # a dense group: all values of 9 bits, and clusters
    fps = sorted({center ^ (k << 20) for k in range(512)} | set(clusters(rng, 900)))
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    frame = spark.createDataFrame(signed, "fp long").repartition(3)
    found = {r.node: r.label for r in components(simhash.linked(frame), "t").collect()}
    want = brute_components(set(fps), 4)
    groups, mine = defaultdict(set), defaultdict(set)
    for f, (s,) in zip(fps, signed):
        groups[want[f]].add(s)
        mine[found.get(s, s)].add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components_of_awkward_graphs(spark):
    chain = [(i, i + 1) for i in range(60)]
    back = [(1000 - i, 999 - i) for i in range(60)]
    hub = [(5000, 5001 + i) for i in range(300)] + [(5300, 6000)]
    rng = random.Random(1)
    order = rng.sample(range(10_000, 10_200), 200)
    zigzag = list(zip(order, order[1:]))
    found = {r.node: r.label for r in components(spark.createDataFrame(chain + back + hub + zigzag + [(7, 7)], "a long, b long"), "t").collect()}
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(940, 1001)} == {940}
    assert found[6000] == 5000 == found[5150] and {found[i] for i in order} == {10_000}


def test_one_row_of_each_component_stays(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    rest = simhash.deduplicated(docs)
    rows = rows_of(spark, edge_dir, "doc_id", "text")
    label = brute_components({brute_fingerprint(t) for _, t in rows}, 4)
    assert rest.columns == docs.columns
    assert sorted(label[brute_fingerprint(r.text)] for r in rest.collect()) == sorted(set(label.values()))


@pytest.mark.parametrize("shape", ["rising", "falling", "shuffled", "star", "grid"])
def test_components_in_few_rounds(spark, monkeypatch, shape):
    """A chain of 1000 nodes, however its labels lie, takes a handful of rounds."""
    n = 1000
    order = {"rising": list(range(n)), "falling": list(range(n))[::-1], "shuffled": random.Random(1).sample(range(n), n)}.get(shape)
    links = list(zip(order, order[1:])) if order else [(0, i) for i in range(1, n)] if shape == "star" else \
        [(i, i + 1) for i in range(n - 1) if i % 40 != 39] + [(i, i + 40) for i in range(n - 40)]
    rounds, stored = [], hooking.stored

    def counted(df, name, *args):
        rounds.append(name)
        return stored(df, name, *args)

    monkeypatch.setattr(hooking, "stored", counted)
    got = components(spark.createDataFrame(links, "a long, b long"), "chain").collect()
    assert {r.node for r in got} == set(range(n)) and {r.label for r in got} == {0}
    assert rounds.count("chain-links") - 1 <= 8 and rounds.count("chain-hook") <= 30
