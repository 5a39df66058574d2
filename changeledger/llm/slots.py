"""Sharding by fixed virtual slots (operator 2).

Records are hashed into ``SLOTS`` virtual slots, for good.  Bytes and rows are summed per slot, and a versioned map
says which shard holds a slot; changing the number of shards edits the map and moves whole slots only.  Within a slot,
records fall into ``PARTS`` parts by row number: a slot that is too heavy for one shard (one id on a third of all rows)
is mapped by its parts, every other slot by one entry.  The map has at most SLOTS * PARTS entries at any input
size, which bounds what the driver and a broadcast hold.

Law ``bytes``: sizes of shards are near equal.  Slots go, heaviest first, each to the shard with the fewest bytes.

Defined results: a null text has no bytes (size 1); null ids hash as such, with the text; repeated rows are a record
each; an empty table gives no rows and an empty map; other columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, text_or_empty

SLOTS = 4096
PARTS = 16
#: A slot above this part of a shard's mean bytes is mapped by its parts.
HEAVY = 0.125
ALL_PARTS = -1


@dataclass(frozen=True)
class Entry:
    slot: int
    part: int  # ALL_PARTS: the whole slot
    shard: int
    bytes: int
    rows: int


def records(docs: DataFrame) -> DataFrame:
    """rid, doc_id, size, text_crc32, virtual_slot, part per record, stored once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t"),
                       F.monotonically_increasing_id().alias("rid"))
    rows = rows.select("rid", "doc_id", (F.octet_length("t") + F.lit(1)).cast("long").alias("size"), F.crc32("t").alias("text_crc32"))
    return stored(rows.select("*", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOTS)).cast("int").alias("virtual_slot"),
                              F.pmod(F.xxhash64("rid"), F.lit(PARTS)).cast("int").alias("part")), "op2-records")


def loads(rows: DataFrame) -> list[tuple[int, int, int, int]]:
    """(slot, part, bytes, rows); at most SLOTS * PARTS of them."""
    return sorted(tuple(r) for r in rows.groupBy("virtual_slot", "part").agg(F.sum("size"), F.count(F.lit(1))).collect())


def _items(load: list[tuple[int, int, int, int]], shards: int, split: set[int] = frozenset()) -> list[tuple[int, int, int, int]]:
    """Slots, and the parts of slots that are heavy or were split before, as (slot, part, bytes, rows)."""
    whole: dict[int, list[int]] = {}
    for slot, _, size, n in load:
        w = whole.setdefault(slot, [0, 0])
        w[0] += size
        w[1] += n
    limit = HEAVY * sum(w[0] for w in whole.values()) / max(1, shards)
    apart = {s for s, w in whole.items() if w[0] > limit} | set(split)
    return [x for x in load if x[0] in apart] + [(s, ALL_PARTS, *w) for s, w in whole.items() if s not in apart]


def first_map(load: list[tuple[int, int, int, int]], shards: int) -> list[Entry]:
    heap = [(0, k) for k in range(shards)]
    out = []
    for slot, part, size, n in sorted(_items(load, shards), key=lambda x: (-x[2], x[0], x[1])):
        used, k = heapq.heappop(heap)
        out.append(Entry(slot, part, k, size, n))
        heapq.heappush(heap, (used + size, k))
    return out


def rebalanced(old: list[Entry], load: list[tuple[int, int, int, int]], shards: int) -> list[Entry]:
    """The map edited for new loads or another number of shards: slots leave shards that are above the mean, heaviest that
    fits first, and those of closed shards, for the shards with the fewest bytes.  All others stay where they are."""
    split = {e.slot for e in old if e.part != ALL_PARTS}
    home = {(e.slot, e.part): e.shard for e in old}
    items = _items(load, shards, split)
    mean = sum(x[2] for x in items) / shards
    held: list[list[tuple[int, int, int, int]]] = [[] for _ in range(shards)]
    moving = []
    for x in items:
        k = home.get((x[0], x[1]), home.get((x[0], ALL_PARTS), -1))
        (held[k] if 0 <= k < shards else moving).append(x)
    for own in held:
        over = sum(x[2] for x in own) - mean
        for x in sorted(own, key=lambda x: (-x[2], x[0], x[1])):
            if 0 < x[2] <= over:
                own.remove(x)
                moving.append(x)
                over -= x[2]
    heap = [(sum(x[2] for x in own), k) for k, own in enumerate(held)]
    heapq.heapify(heap)
    for x in sorted(moving, key=lambda x: (-x[2], x[0], x[1])):
        used, k = heapq.heappop(heap)
        held[k].append(x)
        heapq.heappush(heap, (used + x[2], k))
    return [Entry(s, p, k, size, n) for k, own in enumerate(held) for s, p, size, n in own]


def write_map(spark: SparkSession, folder: str, version: int, entries: list[Entry]) -> None:
    """Versions are written once and never changed; a map in use stays readable while a new one is made."""
    rows = [(e.slot, e.part, e.shard, e.bytes, e.rows) for e in entries]
    spark.createDataFrame(rows, "slot int, part int, shard int, bytes long, rows long").coalesce(1) \
        .write.mode("errorifexists").parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int) -> list[Entry]:
    return [Entry(*r) for r in spark.read.schema("slot int, part int, shard int, bytes long, rows long")
            .parquet(f"{folder}/version={version}").collect()]


def assign(rows: DataFrame, load: list[tuple[int, int, int, int]], entries: list[Entry]) -> DataFrame:
    """Shard of each record and its gapless place there: the rows of the parts before it, then its place in its part."""
    shard = {(e.slot, e.part): e.shard for e in entries}
    places, used = [], {}
    for slot, part, _, n in load:
        k = shard.get((slot, part), shard.get((slot, ALL_PARTS)))
        places.append((slot, part, k, used.get(k, 0)))
        used[k] = used.get(k, 0) + n
    lookup = rows.sparkSession.createDataFrame(places, "virtual_slot int, part int, shard int, ahead long")
    within = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "rid")
    return (rows.withColumn("n", F.row_number().over(within))
            .join(F.broadcast(lookup), ["virtual_slot", "part"])  # at most SLOTS * PARTS rows of 20 bytes
            .withColumn("slot", F.col("ahead") + F.col("n") - 1).drop("ahead", "n"))


def shard(docs: DataFrame, shards: int, folder: str) -> DataFrame:
    """Shard ``docs`` by map version 1, which is written to ``folder`` and read back."""
    rows = records(docs)
    load = loads(rows)
    write_map(docs.sparkSession, folder, 1, first_map(load, shards))
    return assign(rows, load, read_map(docs.sparkSession, folder, 1))
