"""Exact deduplication by 128-bit content hash with byte comparison inside groups (operator 5).

Texts are equal when identical after lower-casing A-Z.  Documents are grouped by the 128-bit MD5 of the
normalised text together with the text itself: the aggregation compares the bytes of every pair of rows that
meet under one hash, so two texts that collide stay apart.  Map-side aggregation folds the copies of a text
before the shuffle, so a group of any size sends one row per task.

One row of each group stays: that with the smallest id, or the largest with ``keep="last"``; of rows with
that same id, one.  Defined results: null texts are empty and equal each other; a row without an id stays only
where its whole group has none; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, row_number, stored, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(name: str = "text") -> Column:
    """The text, empty for null, with A-Z lower-cased."""
    return F.translate(text_or_empty(name), UPPER, LOWER)


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def dedup(docs: DataFrame, keep: str = "first", content_hash: Callable[[Column], Column] = hash128,
          rid: str | None = None) -> DataFrame:
    """Per document: rid, doc_id, keep_id, group_size, kept, text_sha256; rid is the column ``rid`` of ``docs``, or numbers its rows.

    ``text_sha256`` of the normalised text names a group within its hash.  Should two texts of one hash also
    agree in it, the run fails rather than mix them.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lowered().alias("norm"),
                       row_number(rid)) \
        .withColumn("hash", content_hash(F.col("norm")))
    slim = stored(rows.select("rid", "doc_id", "hash", F.sha2("norm", 256).alias("text_sha256")), "op5-rows")
    key = ["hash", "text_sha256"]
    # Copies of a text fold map-side; what is left of one hash is told apart by its bytes.
    texts = (rows.groupBy("hash", "norm").agg(F.count(F.lit(1)).alias("n"))
             .select("hash", F.sha2("norm", 256).alias("text_sha256"), "n")
             .groupBy(*key).agg(F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("texts")))
    # With a sign the largest id is the smallest; null ids come last for both, and the row number breaks ties.
    sign = 1 if keep == "first" else -1
    first = slim.groupBy(*key).agg(F.min(F.struct(F.col("doc_id").isNull(), (F.col("doc_id") * sign).alias("id"), "rid")).alias("best"))
    one = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts agree in both digests")).cast("long"))
    # Only groups with copies need the join; a row without one is a group of its own.
    copied = stored(texts.join(first, key).where((F.col("group_size") > 1) | (F.col("texts") > 1)).select(
        *key, one.alias("group_size"), (F.col("best.id") * sign).alias("keep_id"), F.col("best.rid").alias("keep_rid")), "op5-groups")
    alone = F.col("group_size").isNull()
    return slim.join(copied, key, "left").select(
        "rid", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("rid") == F.col("keep_rid"))).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, keep: str = "first") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, rid = numbered(docs, "op5-docs")
    stay = dedup(rows, keep, rid=rid).where("kept").select(F.col("rid").alias(rid))
    return rows.join(stay, rid, "left_semi").drop(rid)
