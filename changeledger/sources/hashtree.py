"""Versions of a keyed table with a tree of digests, so that two versions are compared where they differ.

Rows are spread over ``2 ** LEAF_BITS`` slots by the first bits of their key's hash, and stored in a folder a slot.  A version's
tree has a digest for each slot, and one for each group of slots that share their first bits, up to one for the whole
table.  ``diff`` walks both trees from the top and follows differing nodes alone, a small read a level, then reads the differing
slots of both versions; equal slots are neither read nor shuffled.  A digest is the number of rows and two sums of 64-bit row hashes.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import history as h
from ..operators.layout import distribute_for_write

LEAF_BITS = 8
STEP_BITS = 4
SLOT = "_slot"
TREE = "level int, node int, rows long, digest string"


def slot_of(key: str, bits: int = LEAF_BITS) -> Column:
    """The slot of a key; null keys share one."""
    return F.shiftrightunsigned(F.xxhash64(F.col(key)), 64 - bits).cast("int")


def _comparable(df: DataFrame, c: str) -> Column:
    return F.array_sort(F.map_entries(c)) if isinstance(df.schema[c].dataType, T.MapType) else F.col(c)


def digests(rows: DataFrame, bits: int = LEAF_BITS, step: int = STEP_BITS) -> DataFrame:
    """The tree of rows that have their slot: (level, node, rows, digest), level 0 the whole table."""
    cols = [_comparable(rows, c) for c in sorted(rows.columns) if c != SLOT]
    sums = rows.groupBy(SLOT).agg(F.count(F.lit(1)).alias("rows"),
                                  *[F.sum(F.xxhash64(F.lit(salt), *cols).cast("decimal(38,0)")).alias(f"s{salt}") for salt in (1, 2)])
    levels = sorted({*range(0, bits, step), bits})
    nodes = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright(F.col(SLOT), bits - n).alias("node")) for n in levels]))
    spread = sums.select(nodes.alias("at"), "rows", "s1", "s2").groupBy("at.level", "at.node").agg(*[F.sum(c).alias(c) for c in ("rows", "s1", "s2")])
    return spread.select("level", "node", "rows", F.concat_ws("/", F.col("s1").cast("string"), F.col("s2").cast("string")).alias("digest"))


def write_version(rows: DataFrame, path: str, key: str = "order_id", bits: int = LEAF_BITS) -> str:
    """Store a version with its tree.  The tree is made from the stored rows, so it says what was written."""
    placed = distribute_for_write(rows.withColumn(SLOT, slot_of(key, bits)), SLOT, [key])
    placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(SLOT).parquet(f"{path}/rows")
    schema = T.StructType([*rows.schema.fields, T.StructField(SLOT, T.IntegerType())])
    stored = rows.sparkSession.read.schema(schema).parquet(f"{path}/rows")
    rows.sparkSession.createDataFrame([(rows.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").parquet(f"{path}/schema")
    digests(stored, bits).coalesce(1).write.mode("overwrite").parquet(f"{path}/tree")
    return path


def read_version(spark: SparkSession, path: str, slots: list[int] | None = None) -> DataFrame:
    """A version's rows; ``slots`` restricts the scan to their folders."""
    schema = T.StructType.fromJson(json.loads(spark.read.schema("schema string").parquet(f"{path}/schema").first()[0]))
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(SLOT, T.IntegerType())])).parquet(f"{path}/rows")
    if slots is not None:
        rows = rows.where(F.col(SLOT).isin(slots)) if slots else rows.limit(0)
    return rows.drop(SLOT)


def differing_slots(spark: SparkSession, old: str, new: str) -> list[int]:
    """The slots whose digests differ, by walking both trees from the top."""
    trees = [spark.read.schema(TREE).parquet(f"{p}/tree") for p in (old, new)]
    levels = [sorted(r[0] for r in t.select("level").distinct().collect()) for t in trees]
    depth = max((x[-1] for x in levels if x), default=0)
    if any(x and x[-1] != depth for x in levels):
        raise ValueError("versions with different numbers of slots can't be compared")
    nodes: list[int] | None = None
    above = 0
    for level in sorted({*levels[0], *levels[1]}):
        at = F.col("level") == level
        if nodes is not None:
            at &= F.shiftright(F.col("node"), level - above).isin(nodes)
        a, b = ({r.node: (r.rows, r.digest) for r in t.where(at).collect()} for t in trees)  # at most the children of differing nodes
        nodes, above = sorted(n for n in {*a, *b} if a.get(n) != b.get(n)), level
        if not nodes:
            return []
    return nodes or []


def diff(spark: SparkSession, old: str, new: str, key: str = "order_id") -> DataFrame:
    """Rows added, removed or changed from one stored version to another, as ``history.snapshot_diff`` tells them."""
    slots = differing_slots(spark, old, new)
    sides = [read_version(spark, p, slots) for p in (old, new)]
    return h.snapshot_diff(*(s.select(*[_comparable(s, c).alias(c) for c in s.columns]) for s in sides), key)
