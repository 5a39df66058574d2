"""SimHash near-duplicates by pigeonhole blocks (operator 7).

A fingerprint has 64 bits; bit i is set when it is set in over half of the XXH64 hashes (seed 42) of the document's word
shingles.  Equal fingerprints are one class; only distinct ones are compared.  A fingerprint is cut into ``BLOCKS`` blocks: two
that differ in at most ``max_bits`` bits differ in at most as many blocks, so they agree in ``BLOCKS - max_bits`` of them.  Every
choice of that many blocks is a bucket key (35 keys of about 27 bits for 7 blocks and 4 bits), and pairs that meet in a bucket are
verified by their Hamming distance.

A bucket's links are found by breadth-first search, which compares a reached fingerprint only with those not reached yet, and
leave the task as a star around the smallest of each component; no pairs within a group are listed.  A bucket of more than
``BUCKET`` distinct fingerprints is not gathered at all: its rows get longer keys, by the pigeonhole principle on the bits that the key
has not used, and go round again.  So no link is lost and no bucket is unbounded.

Defined results: texts of fewer words than a shingle are one shingle; texts without words and nulls have fingerprint 0 and
link like others; a component's id is its smallest id that is not null, null only if there is none; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, row_number, slices, stored
from .components import components

SHINGLE = 4
MAX_BITS = 4
BLOCKS = 7
BUCKET = 1 << 15
SEED = 42
#: Runs up to this length are compared at once with all others of the batch.
SHORT_RUN = 32


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Lower-cases A-Z and splits on ASCII white space only, as bytes methods do."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    begin = (end - size)[:len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(begin, end[shingle - 1:].tolist())], "<u8")
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, rid: str | None = None) -> DataFrame:
    """rid (the column ``rid``, or a new number), doc_id, fp (the 64 bits as a signed long) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.record_batch([b.column("rid"), b.column("doc_id"), pa.array(fp.view(np.int64))], ["rid", "doc_id", "fp"])

    return docs.select(row_number(rid), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, "rid long, doc_id long, fp long")


def cut(bits: list[int], blocks: int, agree: int) -> list[int]:
    """Masks of every choice of ``agree`` out of ``blocks`` nearly equal blocks of ``bits``."""
    parts = [int(sum(1 << int(b) for b in p)) for p in np.array_split(np.array(bits), blocks)]
    return [sum(c) for c in combinations(parts, agree)]


def bucketed(fps: np.ndarray, mask: int) -> np.ndarray:
    """A 64-bit key of the masked bits and the mask (an odd factor and a shift mix them)."""
    x = (fps & np.uint64(mask)) ^ np.uint64((mask * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def longer(mask: int, max_bits: int) -> list[int]:
    """Masks for a bucket of ``mask``: max_bits + 1 blocks of the bits that are free, of which close pairs agree in one."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | m for m in cut(free, max_bits + 1, 1)]


def star(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest of its component) of distinct fingerprints, by breadth-first search."""
    left = np.sort(fps)
    a, b = [], []
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = np.array([root])
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for f in front:
                near |= np.bitwise_count(left ^ f) <= max_bits
                if near.all():
                    break
            front, left = left[near], left[~near]
            a.append(front)
            b.append(np.full(len(front), root))
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def short_runs(key: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for many short runs of equal keys at once."""
    parent = np.arange(len(fps))
    pairs = []
    for step in range(1, len(fps)):
        same = np.flatnonzero(key[step:] == key[:-step])
        if not len(same):
            break
        close = same[np.bitwise_count(fps[same] ^ fps[same + step]) <= max_bits]
        pairs.append((close, close + step))
    if not pairs:
        return fps[:0], fps[:0]
    i, j = (np.concatenate(x) for x in zip(*pairs))
    while len(i):  # smallest label over the links, until nothing changes
        old = parent.copy()
        np.minimum.at(parent, j, parent[i])
        np.minimum.at(parent, i, parent[j])
        parent = parent[parent]
        if (parent == old).all():
            break
    linked = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[linked], fps[parent[linked]]


def _links(rows: DataFrame, max_bits: int) -> DataFrame:
    """(key, mask, fp) → links (a, b), and (a, null, mask) for members of buckets that are too large."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b, mask=None):
            n = len(a)
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)) if mask is None else pa.nulls(n, pa.int64()),
                                    pa.nulls(n, pa.int64()) if mask is None else pa.array(mask.view(np.int64))], ["a", "b", "mask"])

        def whole(key, mask, fp):
            """Complete runs."""
            if not len(key):
                return
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])])
            key, mask, fp = key[new], mask[new], fp[new]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(first, len(key)))
            short = np.repeat((size > 1) & (size <= SHORT_RUN), size)
            if short.any():
                a, b = short_runs(key[short], fp[short], max_bits)
                if len(a):
                    yield out(a, b)
            for at, n in zip(first[size > SHORT_RUN].tolist(), size[size > SHORT_RUN].tolist()):
                a, b = star(fp[at:at + n], max_bits)
                if len(a):
                    yield out(a, b)

        held = [np.zeros(0, np.uint64)] * 3
        hot = None  # the key of a bucket that is being passed on
        for batch in batches:
            now = [batch.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in ("key", "mask", "fp")]
            if not len(now[0]):
                continue
            if hot is not None:
                n = int(np.searchsorted(now[0] != hot, True)) if now[0][-1] != hot else len(now[0])
                if n:
                    yield out(now[2][:n], now[2][:n], now[1][:n])
                now = [x[n:] for x in now]
                if not len(now[0]):
                    continue
                hot = None
            held = [np.concatenate(x) for x in zip(held, now)]
            last = int(np.flatnonzero(held[0] == held[0][-1])[0])
            yield from whole(*(x[:last] for x in held))
            held = [x[last:] for x in held]
            if len(held[0]) > BUCKET:
                yield out(held[2], held[2], held[1])
                hot, held = held[0][0], [x[:0] for x in held]
        yield from whole(*held)

    return rows.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "a long, b long, mask long")


def _keyed(rows: DataFrame, masks_of, level: str) -> DataFrame:
    """Bucket keys of fingerprints; ``masks_of`` gives the masks for a row's present one (null at first)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 4096):
            fps = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            present = b.column("mask").to_numpy(zero_copy_only=False).view(np.uint64)
            for m in np.unique(present):
                own = fps[present == m]
                for mask in masks_of(int(m)):
                    yield pa.record_batch([pa.array(bucketed(own, mask).view(np.int64)), pa.array(np.full(len(own), mask, np.uint64).view(np.int64)),
                                           pa.array(own.view(np.int64))], ["key", "mask", "fp"])

    return rows.mapInArrow(run, "key long, mask long, fp long")


def linked(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Links (a, b) that connect all distinct ``fp`` at most ``max_bits`` bits apart."""
    first = cut(list(range(64)), blocks, blocks - max_bits)
    rows = _keyed(fps.select("fp", F.lit(0).cast("long").alias("mask")), lambda _: first, "0")
    links, level = [], 0
    while True:
        found = stored(_links(rows, max_bits), f"op7-links{level}")
        links.append(found.where("b IS NOT NULL").select("a", "b"))
        hot = found.where("b IS NULL").select(F.col("a").alias("fp"), "mask").distinct()
        if hot.isEmpty():
            break
        level += 1
        rows = _keyed(hot, lambda m: longer(m, max_bits), str(level)).distinct()
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, rid: str | None = None) -> DataFrame:
    """Per row: rid, doc_id, fp, label (smallest fingerprint of the component), component_id."""
    rows = stored(fingerprints(docs, shingle, rid), "op7-fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "op7-classes")
    labels = components(linked(classes.select("fp"), max_bits), "op7")
    named = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first_id", F.coalesce("label", "fp").alias("label"))
    ids = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return rows.join(named.drop("first_id").join(ids, "label"), "fp")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component: the smallest id, of equal ids the first row."""
    rows, rid = numbered(docs, "op7-docs")
    found = near_duplicates(rows, shingle, max_bits, rid)
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("label").agg(F.min("rid").alias(rid)).select(rid)
    return rows.join(stay, rid, "left_semi").drop(rid)
