import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from changeledger.llm import queries as Q
from changeledger.llm import repeats

from .conftest import SCHEMA, rows_of

W = 200


def brute(rows):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter()
    for _, b in data:
        for s in range(len(b) - W + 1):
            seen[hashlib.blake2b(b[s:s + W], digest_size=16).digest()] += 1
    out = Counter()
    for i, b in data:
        cover = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - W + 1):
            if seen[hashlib.blake2b(b[s:s + W], digest_size=16).digest()] > 1:
                cover[s:s + W] = True
        n_spans = int((cover[:-1] & ~np.concatenate([[False], cover[:-2]])).sum()) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~cover[:-1]].tobytes()
        out[(i, len(b), int(cover.sum()), n_spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def check(spark, d):
    got = Counter(map(tuple, Q.op9(spark, d).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
    want = brute(rows_of(spark, d, "doc_id", "text"))
    assert got == want, (list((got - want).items())[:5], list((want - got).items())[:5])


@pytest.mark.parametrize("where", ["edge_dir", "sample_dir"])
def test_query_matches_all_windows(spark, where, request):
    check(spark, request.getfixturevalue(where))


def test_empty_table(spark, empty_dir):
    assert Q.op9(spark, empty_dir).collect() == []


def awkward(rng):
    """Passages at random places, cut, overlapping, periodic, changed in single bytes, at the length limit."""
    letters = "abcdefgh "
    word = lambda n: "".join(rng.choices(letters, k=n))
    passages = [word(n) for n in (199, 200, 201, 260, 500)] + ["ab" * 150, "x" * 300, "é" * 120, word(70) * 4]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            if rng.random() < 0.4:
                p = p[rng.randint(0, 60):]
            if rng.random() < 0.3:
                k = rng.randrange(len(p))
                p = p[:k] + "Z" + p[k + 1:]
            parts += [word(rng.randint(0, 120)), p]
        texts.append("".join(parts) + word(rng.randint(0, 60)))
    return [(i, t) for i, t in enumerate(texts)]


def write(spark, rows, folder):
    spark.createDataFrame([(i, t, None, None, None, 1, "h", 2.0, "k") for i, t in rows], SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")


@pytest.mark.parametrize("group, held, folded", [(4096, 1 << 18, 200_000), (3, 1 << 18, 1), (1, 8, 1), (2, 5, 50)])
def test_awkward_passages(spark, tmp_path, monkeypatch, group, held, folded):
    """Also when nearly all groups count as large and are halved, and when the marking task holds a few rows only."""
    monkeypatch.setattr(repeats, "GROUP", group)
    monkeypatch.setattr(repeats, "HELD", held)
    monkeypatch.setattr(repeats, "FOLDED", folded)
    write(spark, awkward(random.Random(group)), tmp_path)
    check(spark, str(tmp_path))


def test_intervals_are_the_tree():
    suffixes = sorted("mississippi"[i:] for i in range(11))
    prefixes = [repeats.common(a.encode(), b.encode()) for a, b in zip(suffixes, suffixes[1:])]
    got = set(repeats.intervals(prefixes))
    want = set()
    for i in range(11):
        for j in range(i + 1, 11):
            r = min(prefixes[i:j])
            if (i == 0 or prefixes[i - 1] < r) and (j == 10 or prefixes[j] < r):
                want.add((r, i, j))
    assert got == want


def test_every_window_has_its_anchors():
    rng = np.random.default_rng(1)
    for data in (rng.integers(97, 101, 900), rng.integers(97, 99, 400), np.full(300, 97), np.tile(rng.integers(97, 120, 30), 20), rng.integers(97, 101, 200)):
        data = data.astype(np.uint8)
        h = repeats.gram_hashes(data, repeats.GRAM)
        want = defaultdict(set)
        for s in range(len(data) - W + 1):
            own = h[s:s + W - repeats.GRAM + 1]
            for k in np.flatnonzero(own == own.min()).tolist():
                want[s].add(s + k)
        got = defaultdict(set)
        for p, a, b, g in zip(*(x.tolist() for x in repeats.anchors(data))):
            assert g == h[p]
            for o in range(a, b + 1):
                got[p - o].add(p)
        assert got == want


def test_groups_are_the_maximal_repeats():
    """Every maximal repeat through the key, with all its occurrences, by comparing all pairs."""
    rng = random.Random(5)
    for _ in range(40):
        key, window = "K" * 4, 10
        group = []
        for rid in range(rng.randint(2, 12)):
            before, after = "".join(rng.choices("ab", k=6)), "".join(rng.choices("ab", k=6))
            group.append((rid, 100 * rid, 0, 6, before.encode(), (key + after).encode()))
        group.sort(key=lambda x: x[5])
        want = set()
        for x in group:
            for y in group:
                if x[0] != y[0]:
                    high, r = repeats.common(x[4], y[4]), repeats.common(x[5], y[5])
                    if high + r >= window:
                        want |= {(z[0], z[1] - high, z[1] + r) for z in group if z[4][:high] == x[4][:high] and z[5][:r] == x[5][:r]}
        found = defaultdict(set)
        for rid, start, stop, name in repeats.repeats_of(group, window, every=True):
            found[name].add((rid, start, stop))
        assert set().union(*found.values()) == want and all(len(v) > 1 for v in found.values())
        cover = lambda rows: {(r, k) for r, i, j in rows for k in range(i, j)}
        assert cover(x[:3] for x in repeats.repeats_of(group, window)) == cover(want)


def test_kept_bytes(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choices("abcdefghij ", k=n))
    passage = word(400)
    docs = spark.createDataFrame([(i, word(300 + 10 * i) + passage + word(300)) for i in range(5)] + [(9, word(900))], "doc_id long, text string")
    r = repeats.Repeats(docs)
    kept = {x.rid: bytes(x.kept) for x in r.kept().collect()}
    assert len(kept) == 5 and all(passage.encode() not in k for k in kept.values())
    names = defaultdict(set)
    for s in r.spans.collect():
        names[s.repeat].add(s.rid)
    assert max(map(len, names.values())) == 5
