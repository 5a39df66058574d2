"""Change-log semantics: replay, per-batch merge, erasure, tombstones, late events.

A change row is ``(seq, key, op, <value columns>)``.  ``seq`` is the event's place in order: an
offset, or where the events of a key may come from several partitions, the struct of
``functions.cdc.event_order``.  The state of a key is
defined by the events after its last delete: the key exists when at least one
upsert follows that delete, and every column holds its last non-null value
(a null in an update never clears a value).  This is exactly what applying the
events one by one with ``MERGE … UPDATE SET c = COALESCE(source.c, target.c)``
produces, but it is computed with one hash aggregation per key, so partial
(map-side) aggregation collapses hot keys before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CHANGE_COLUMNS, DELETE_OP, UPSERT_OPS

KEY = "order_id"
VALUE_COLUMNS = [c for c in CHANGE_COLUMNS if c != KEY]
# State rows re-enter a fold as updates older than every logged event.
STATE_SEQ = -(2 ** 62)


def _is_delete(op: str) -> Column:
    return F.col(op) == F.lit(DELETE_OP)


def _is_upsert(op: str) -> Column:
    return F.col(op).isin(*UPSERT_OPS)


def accumulators(value_cols: list[str], live: Column, prefix: str = "", seq: str = "seq",
                 op: str = "op") -> list[Column]:
    """What a fold keeps of a key's ``live`` rows: the last delete, the last upsert, and
    each column's last non-null value with its ``seq``."""
    is_del, is_up = _is_delete(op) & live, _is_upsert(op) & live
    aggs = [F.max(F.when(is_del, F.col(seq))).alias(f"{prefix}_last_del"),
            F.max(F.when(is_up, F.col(seq))).alias(f"{prefix}_last_up")]
    for c in value_cols:
        at = F.when(is_up & F.col(c).isNotNull(), F.col(seq))
        aggs.append(F.max_by(F.col(c), at).alias(f"{prefix}{c}"))
        aggs.append(F.max(at).alias(f"{prefix}_seq_{c}"))
    return aggs


def _after(a: Column, b: Column) -> Column:
    """``a`` is later than ``b``, or there is no ``b``; positions may be of any type with an order, also structs."""
    return F.coalesce(a > b, a.isNotNull() & b.isNull())


def exists(prefix: str = "") -> Column:
    """A folded key exists when an upsert follows its last delete."""
    return _after(F.col(f"{prefix}_last_up"), F.col(f"{prefix}_last_del"))


def current(c: str, prefix: str = "") -> Column:
    """A folded key's value of column ``c``: the last one, unless a delete followed it."""
    return F.when(_after(F.col(f"{prefix}_seq_{c}"), F.col(f"{prefix}_last_del")), F.col(f"{prefix}{c}"))


def fold(changes: DataFrame, key: str = KEY, value_cols: list[str] | None = None,
         seq: str = "seq", op: str = "op") -> DataFrame:
    """The accumulators of every key, deleted keys included."""
    value_cols = value_cols or [c for c in VALUE_COLUMNS if c in changes.columns]
    changes = changes.where(F.col(key).isNotNull())   # keyless events are dead letters
    return changes.groupBy(key).agg(*accumulators(value_cols, F.lit(True), seq=seq, op=op))


def folded_state(folded: DataFrame, key: str = KEY, value_cols: list[str] | None = None) -> DataFrame:
    """The rows that a fold says exist."""
    value_cols = value_cols or [c for c in VALUE_COLUMNS if c in folded.columns]
    return folded.where(exists()).select(key, *[current(c).alias(c) for c in value_cols])


def merge_folds(base: DataFrame, tail: DataFrame, key: str = KEY,
                value_cols: list[str] | None = None) -> DataFrame:
    """The fold of two logs from their folds, whatever the order in which rows arrived.

    The joins carry no hint: AQE broadcasts a small tail, so the base is not shuffled.
    """
    value_cols = value_cols or [c for c in VALUE_COLUMNS if c in base.columns]
    new = tail.select(key, *[F.col(c).alias(f"_t_{c}") for c in tail.columns if c != key])
    merged = [F.greatest(c, f"_t_{c}").alias(c) for c in ("_last_del", "_last_up")]
    for c in value_cols:
        newer = _after(F.col(f"_t__seq_{c}"), F.col(f"_seq_{c}"))
        merged.append(F.when(newer, F.col(f"_t_{c}")).otherwise(F.col(c)).alias(c))
        merged.append(F.greatest(f"_seq_{c}", f"_t__seq_{c}").alias(f"_seq_{c}"))
    held = base.join(tail.select(key), key, "left_semi").select(key)
    return base.join(new, key, "left").select(key, *merged).unionByName(tail.join(held, key, "left_anti"))


def replay(changes: DataFrame, key: str = KEY, value_cols: list[str] | None = None,
           seq: str = "seq", op: str = "op") -> DataFrame:
    """Current state of every key from a change log.

    Rows whose ``op`` is neither an upsert nor a delete take no part, as in a
    MERGE whose branches never match them.
    """
    value_cols = value_cols or [c for c in VALUE_COLUMNS if c in changes.columns]
    return folded_state(fold(changes, key, value_cols, seq, op), key, value_cols)


def keyed_by_id() -> Column:
    """A delete that brought the database id alone."""
    return F.coalesce(_is_delete("op") & (F.col(KEY) == F.col("source_id")), F.lit(False))


def id_deletes(rows: DataFrame) -> DataFrame:
    return rows.where(keyed_by_id())


def id_pairs(rows: DataFrame) -> DataFrame:
    """Which business keys each database id's documents had, and since which ``seq``."""
    return (rows.where(_is_upsert("op") & F.col("source_id").isNotNull())
                .groupBy("source_id", KEY).agg(F.min("seq").alias("first_seq")))


def resolve_deletes(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Deletes that carry a database id get the business keys of that id's earlier documents.

    A delete without an earlier document keeps the id as its key.
    """
    known = pairs.select(F.col("source_id").alias("_sid"), F.col(KEY).alias("_key"), "first_seq")
    found = (id_deletes(rows)
             .join(known, (F.col("source_id") == F.col("_sid")) & (F.col("seq") > F.col("first_seq")), "left")
             .withColumn(KEY, F.coalesce("_key", KEY)).select(rows.columns))
    return rows.where(~keyed_by_id()).unionByName(found)


def state_as_changes(state: DataFrame, key: str = KEY, value_cols: list[str] | None = None,
                     seq_value: int | Column = STATE_SEQ) -> DataFrame:
    """State rows as synthetic ``update`` events at ``seq_value``."""
    value_cols = value_cols or [c for c in state.columns if c != key]
    at = seq_value if isinstance(seq_value, Column) else F.lit(seq_value).cast("long")
    return state.select(at.alias("seq"), key,
                        F.lit("update").alias("op"), *value_cols)


def fold_batch(batch: DataFrame, key: str, value_cols: list[str]) -> DataFrame:
    """What a batch does to each key: ``_deleted`` (rows of before go), ``_exists``
    (an upsert follows the last delete) and each column's last non-null value after it."""
    batch = batch.where(F.col(key).isNotNull())
    folded = replay(batch, key, value_cols).withColumn("_exists", F.lit(True))
    seen = batch.groupBy(key).agg(F.coalesce(F.bool_or(_is_delete("op")), F.lit(False)).alias("_deleted"))
    return seen.join(folded, key, "left").withColumn("_exists", F.coalesce("_exists", F.lit(False)))


def cdc_merge(state: DataFrame, batch: DataFrame, key: str = KEY) -> DataFrame:
    """Apply one micro-batch of change rows to a state table.

    matched+delete → removed; matched+upsert → per-column COALESCE(new, old);
    unmatched+upsert → inserted; unmatched+delete → nothing.  Several events of
    one key inside a batch are folded in ``seq`` order (delete-then-insert does
    not leak old values).  As in a MERGE, state rows are never deduplicated: rows
    without a key stay, and every row of a repeated key is updated or removed.

    The joins carry no hint: a small folded batch is broadcast by AQE from its
    measured size, so the state is not shuffled; a large one is shuffled and
    its hot keys are split.
    """
    value_cols = [c for c in state.columns if c != key]
    patch = fold_batch(batch.select("seq", key, "op", *value_cols), key, value_cols)
    new = patch.select(key, "_deleted", *[F.col(c).alias(f"_new_{c}") for c in value_cols])
    updated = (state.join(new, key, "left").where(~F.coalesce("_deleted", F.lit(False)))
               .select(key, *[F.coalesce(f"_new_{c}", c).alias(c) for c in value_cols]))
    present = state.join(patch.select(key), key, "left_semi").select(key).distinct() \
        .withColumn("_present", F.lit(True))
    inserted = (patch.where("_exists").join(present, key, "left")
                .where(F.col("_deleted") | F.col("_present").isNull()).select(key, *value_cols))
    return updated.select(*state.columns).unionByName(inserted.select(*state.columns))


def tombstones(changes: DataFrame, key: str = KEY, seq: str = "seq", op: str = "op") -> DataFrame:
    """Keys whose final state is deleted, with the seq of the removing delete."""
    g = changes.groupBy(key).agg(
        F.max(F.when(_is_delete(op), F.col(seq))).alias("deleted_seq"),
        F.max(F.when(_is_upsert(op), F.col(seq))).alias("_last_up"))
    return g.where(F.col("deleted_seq").isNotNull()
                   & (F.col("_last_up").isNull() | (F.col("_last_up") < F.col("deleted_seq")))
                   ).select(key, "deleted_seq")


def erase_keys(df: DataFrame, erase: DataFrame, key: str = KEY) -> DataFrame:
    """Privacy erasure: drop every row of the listed keys.

    The erase list is deduplicated; AQE broadcasts it when it has measured it to be
    small, so that the (large) dataset is filtered without being shuffled.
    """
    keys = erase.select(key).where(F.col(key).isNotNull()).distinct()
    return df.join(keys, key, "left_anti")


def compact_log(changes: DataFrame, upto_seq: int | Column, key: str = KEY,
                value_cols: list[str] | None = None) -> DataFrame:
    """Fold the log prefix ``seq <= upto_seq`` into base rows.

    Base rows are ``update`` events at ``upto_seq`` so ``replay(base ∪ tail)``
    equals ``replay(log)``.
    """
    value_cols = value_cols or [c for c in VALUE_COLUMNS if c in changes.columns]
    base = replay(changes.where(F.col("seq") <= upto_seq), key, value_cols)
    return state_as_changes(base, key, value_cols, upto_seq)


def late_events(tail: DataFrame, base_seq: int | Column) -> DataFrame:
    """Events that arrive after a compaction but belong before it.

    Folding them silently would reorder history, so they are set aside.
    """
    return tail.where(F.col("seq") <= F.lit(base_seq))


def erase_from_files(spark, path: str, erase: DataFrame, new_path: str, key: str = KEY,
                     partition_col: str | None = None) -> str:
    """Rewrite a stored dataset without the erased keys (O29 on data at rest).

    The whole dataset is written anew to ``new_path`` and readers switch to it, so
    the source is never read and overwritten at once.
    """
    data = spark.read.parquet(path)
    kept = erase_keys(data, erase, key)
    w = kept.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(new_path)
    return new_path
