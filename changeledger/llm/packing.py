"""Best-fit packing of token pieces into sequences by hierarchical residual packing (operator 10).

Documents are tokenised; one longer than a sequence is cut into full pieces, of which the first may be shorter
and the others fill a sequence each.  All shorter pieces are items.  Round 0 deals the items by hash into groups
of about ``GROUP_ITEMS``; each group packs best-fit in order of decreasing length.  Nearly full bins (at most
``SLACK`` free places) are done.  Underfull bins go up a tree as items: every round joins ``FAN_IN`` groups and
packs their bins by best fit again, until one group is left.

Two bins of a group never fit together, so a group has one bin of at most half a sequence, and the next round
joins at most ``FAN_IN`` such small ones.  They need at most ``FAN_IN`` partners of each free length; a group sends
those up and its other bins are done.  So a group never receives more than FAN_IN² · capacity bins.

Defined results: a null text is empty and has the end id alone; rows that repeat, also with the same id, are
packed each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs, slices, stored, text_or_empty
from .tokens import encoder

SLACK = 8
GROUP_ITEMS = 50_000
FAN_IN = 8

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_MEMBER = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("offset", pa.int64())])
_BINS = ("done boolean, fill int, bin long, "
         "members array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>>")


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document (its ids, then ``end_id``), with their CRC-32 as 32-bit ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in slices(batches, 1000):
            out = []
            ids, ends = enc.encode_ended(b.column("text"), end_id)
            data, at = memoryview(ids.astype("<u4").tobytes()), 0
            for doc_id, stop in zip(b.column("doc_id").to_pylist(), ends.tolist()):
                n = stop - at
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
                    part = data[4 * (at + i):4 * (at + j)]
                    out.append((doc_id, k, i, j - i, zlib.crc32(part), *([bytes(part)] if with_ids else [])))
                at = stop
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, _PIECE + ", ids binary" * with_ids)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices per bin: longest first, each into the fullest bin that has room, else into a new one."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]  # free places → bins
    some = 0  # bit f is set if by_free[f] has a bin
    for i in np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist():
        n = lengths[i]
        fit = some >> n
        if fit:
            free = n + (fit & -fit).bit_length() - 1
            k = by_free[free].pop()
            if not by_free[free]:
                some ^= 1 << free
            bins[k].append(i)
        else:
            free, k = capacity, len(bins)
            bins.append([i])
        free -= n
        by_free[free].append(k)
        some |= 1 << free
    return bins


def sent_up(fills: list[int], capacity: int, last: bool) -> list[bool]:
    """Which bins of a group the next round can use (see the module's text)."""
    free_of = [0] * (capacity + 1)
    up = []
    for fill in fills:
        free = capacity - fill
        free_of[free] += 1
        up.append(not last and free > SLACK and free_of[free] <= FAN_IN)
    return up


def _round(rows: DataFrame, level: int, groups: int, capacity: int) -> DataFrame:
    """Pack the rows (grp, fill, members) of each group."""
    last = groups == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, "grp"):
            grp = t.column("grp")[0].as_py()
            fills, members = t.column("fill").to_pylist(), t.column("members").combine_chunks()
            bins = best_fit(fills, capacity)
            total = [sum(fills[i] for i in b) for b in bins]
            # Members of the bins in order; their offsets move by what the bin holds before them.
            order = np.array([i for b in bins for i in b], np.int64)
            shift = np.array([s for b in bins for s in np.concatenate([[0], np.cumsum([fills[i] for i in b])[:-1]])], np.int64)
            size = np.diff(members.offsets.to_numpy())
            picked = members.take(pa.array(order))
            flat = picked.flatten()
            columns = [flat.field(k) for k in range(5)]
            offset = flat.field(5).to_numpy() + np.repeat(shift, size[order])
            structs = pa.StructArray.from_arrays([*columns, pa.array(offset)], fields=list(_MEMBER))
            ends = np.concatenate([[0], np.cumsum([sum(int(size[i]) for i in b) for b in bins])]).astype(np.int32)
            ids = (level << 56) + (grp << 28) + np.arange(len(bins), dtype=np.int64)
            yield pa.record_batch([pa.array([not u for u in sent_up(total, capacity, last)]), pa.array(total, pa.int32()),
                                   pa.array(ids), pa.ListArray.from_arrays(pa.array(ends), structs)],
                                  ["done", "fill", "bin", "members"])

    return rows.repartition(groups, "grp").sortWithinPartitions("grp").mapInArrow(run, _BINS)


def pack(items: DataFrame, capacity: int, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32): the same rows with sequence_id and offset."""
    items = stored(items, "op10-pieces")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = items.where(F.col("length") >= capacity).select(
        *names, (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = items.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group_items))
    rows = short.select(
        F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)).alias("grp"),
        F.col("length").cast("int").alias("fill"),
        F.array(F.struct(*names, F.lit(0).cast("long").alias("offset"))).alias("members"))
    done, level = [], 0
    while True:
        bins = stored(_round(rows, level, groups, capacity), f"op10-round{level}")
        done.append(bins.where("done"))
        if groups == 1:
            break
        groups, level = -(-groups // FAN_IN), level + 1
        rows = bins.where("NOT done").select(
            # Groups of the last round stay together, FAN_IN of them in one.
            F.shiftright(F.col("bin").bitwiseAND(F.lit((1 << 56) - 1)), 28).cast("long").alias("old"), "fill", "members") \
            .select(F.expr(f"old div {FAN_IN}").cast("long").alias("grp"), "fill", "members")
    placed = full
    for bins in done:
        placed = placed.unionByName(
            bins.select("bin", F.explode("members").alias("m"))
            .select(*[F.col(f"m.{c}").alias(c) for c in names], F.col("bin").alias("sequence_id"), F.col("m.offset").alias("offset")))
    return placed


def sequences(placed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """The token sequences: pieces' ids (bytes of 32 bits) joined in their places."""
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    first = with_ids.groupBy(*key).agg(F.first("ids").alias("ids"))  # pieces that agree in the key have equal ids
    return (placed.join(first, [placed[c].eqNullSafe(first[c]) for c in key])
            .groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", F.expr("aggregate(transform(p, x -> x.ids), X'', (a, x) -> a || x)").alias("ids")))
