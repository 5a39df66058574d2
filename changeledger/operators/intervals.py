"""Validity intervals of a change log, and joins that ask for a key's row at each fact's own time.

``validity`` turns the log into rows ``(key, values, valid_from, valid_to)``: the state of a key from one event to the next that
changes it.  Any version is a filter on the intervals, without a replay.  ``as_of_join`` gives each row of another table the
state that its key had at that row's time.

Both walk a key's rows in order.  A key that holds a third of all rows isn't walked in one task: its rows are cut into slices of
the ordering column, a first pass folds each slice, and every slice is then walked by itself from the state that the slices before it leave.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .changes import KEY, VALUE_COLUMNS, _after, accumulators
from ..schemas import DELETE_OP, UPSERT_OPS
from ..session import cut_lineage

#: Rows of a key and slice that one task walks, about.
SLICE_ROWS = 100_000


def slice_of(rows: DataFrame, at: str, key: str, slice_rows: int = SLICE_ROWS) -> Column:
    """The slice of a row: its place between the smallest and largest ``at``, in as many parts as the fullest key needs."""
    number = F.col(at).cast("long") if rows.schema[at].dataType.typeName() in ("long", "integer") else F.unix_micros(F.col(at).cast("timestamp"))
    most, lo, hi = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi")) \
        .agg(F.max("n"), F.min("lo"), F.max("hi")).first()
    parts = max(1, -(-(most or 0) // slice_rows))
    width = max(1, -(-((hi or 0) - (lo or 0) + 1) // parts))
    return F.floor((number - F.lit(lo or 0)) / F.lit(width)).cast("int")


def _carried(changes: DataFrame, cols: list[str], key: str) -> DataFrame:
    """For each key and slice, the state that the slices before it leave, as an event before all of the slice's own."""
    folded = changes.groupBy(key, "_slice").agg(*accumulators(cols, F.lit(True)))
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    held = folded.select(key, "_slice", F.max("_last_del").over(before).alias("_last_del"), F.max("_last_up").over(before).alias("_last_up"),
                         *[F.max(F.when(F.col(f"_seq_{c}").isNotNull(), F.struct(F.col(f"_seq_{c}").alias("at"), F.col(c).alias("v")))).over(before).alias(c) for c in cols])
    alive = held.where(_after(F.col("_last_up"), F.col("_last_del")))
    return alive.select(key, "_slice", F.lit(None).cast("long").alias("seq"), F.lit("replace").alias("op"),
                        *[F.when(_after(F.col(f"{c}.at"), F.col("_last_del")), F.col(f"{c}.v")).alias(c) for c in cols])


def validity(changes: DataFrame, key: str = KEY, value_cols: list[str] | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Intervals ``[valid_from, valid_to)`` in ``seq`` (``valid_to`` null: still valid) with the key's row in each.

    Events that leave a row as it was open no interval; deleted keys have none from the delete on.  ``seq`` is a number that no two events of a key share.
    """
    cols = value_cols or [c for c in VALUE_COLUMNS if c in changes.columns]
    values = [F.when(F.col("op") != DELETE_OP, F.col(c)).alias(c) for c in cols]  # what a delete carries sets nothing
    events = changes.where(F.col(key).isNotNull() & F.col("op").isin(DELETE_OP, *UPSERT_OPS)).select(key, "seq", "op", *values)
    events = events.withColumn("_slice", slice_of(events, "seq", key, slice_rows))
    rows = events.unionByName(_carried(events, cols, key), allowMissingColumns=True)
    walk = Window.partitionBy(key, "_slice").orderBy(F.col("seq").asc_nulls_first())
    upto = walk.rowsBetween(Window.unboundedPreceding, 0)
    epoch = rows.withColumn("_epoch", F.sum(F.when(F.col("op") == DELETE_OP, 1).otherwise(0)).over(upto))
    life = Window.partitionBy(key, "_slice", "_epoch").orderBy(F.col("seq").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    state = epoch.select(key, "_slice", "seq", (F.col("op") != DELETE_OP).alias("_alive"),
                         *[F.when(F.col("op") != DELETE_OP, F.last(c, ignorenulls=True).over(life)).alias(c) for c in cols])
    row = F.struct("_alive", *cols)
    changed = state.withColumn("_before", F.lag(row).over(walk)).where(
        F.col("seq").isNotNull() & ~row.eqNullSafe(F.col("_before")) & (F.col("_alive") | F.col("_before").isNotNull()))
    order = Window.partitionBy(key).orderBy("seq")
    until = changed.withColumn("valid_to", F.lead("seq").over(order))  # one row a change that is left
    return until.where("_alive").select(key, *cols, F.col("seq").alias("valid_from"), "valid_to")


def at_version(intervals: DataFrame, seq: int, key: str = KEY) -> DataFrame:
    """The table as it was after event ``seq``: a filter, without a replay."""
    valid = (F.col("valid_from") <= seq) & (F.col("valid_to").isNull() | (F.col("valid_to") > seq))
    return intervals.where(valid).drop("valid_from", "valid_to")


def as_of_join(facts: DataFrame, intervals: DataFrame, fact_key: str, fact_at: str, key: str = KEY, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Each fact with its key's row at the fact's own place ``fact_at`` (null columns where the key had none).

    Facts and interval borders are walked together in order, so a fact meets one interval and no pairs are made and thrown away.
    """
    cols = [c for c in intervals.columns if c not in (key, "valid_from", "valid_to")]
    row = F.struct(*cols)
    intervals = cut_lineage(intervals, "intervals")  # a computed input is computed once
    starts = intervals.select(F.col(key).alias("_k"), F.col("valid_from").alias("_at"), F.struct(F.lit(True).alias("alive"), row.alias("row")).alias("_state"))
    ends = intervals.where("valid_to is not null").select(F.col(key).alias("_k"), F.col("valid_to").alias("_at"),
                                                         F.struct(F.lit(False).alias("alive"), F.lit(None).cast(intervals.select(row).schema[0].dataType).alias("row")).alias("_state"))
    # where an interval ends and the next begins at one place, the beginning counts: true is the larger of the two
    borders = starts.unionByName(ends).groupBy("_k", "_at").agg(F.max_by("_state", F.col("_state.alive")).alias("_state"))
    asked = facts.where(F.col(fact_key).isNotNull() & F.col(fact_at).isNotNull()).select(
        F.col(fact_key).alias("_k"), F.col(fact_at).alias("_at"), F.struct(*facts.columns).alias("_fact"))
    both = borders.withColumn("_fact", F.lit(None).cast(asked.schema["_fact"].dataType)).unionByName(asked.withColumn("_state", F.lit(None).cast(borders.schema["_state"].dataType)))
    both = cut_lineage(both, "as-of-rows")  # read for the slices, their last states and the walk
    both = both.withColumn("_slice", slice_of(both, "_at", "_k", slice_rows))
    last = both.groupBy("_k", "_slice").agg(F.max_by("_state", F.when(F.col("_state").isNotNull(), F.col("_at"))).alias("_state"))
    before = Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("_k", "_slice", F.lit(None).cast(both.schema["_at"].dataType).alias("_at"), F.last("_state", ignorenulls=True).over(before).alias("_state")) \
        .where("_state is not null")
    walk = Window.partitionBy("_k", "_slice").orderBy(F.col("_at").asc_nulls_first(), F.col("_fact").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    met = both.unionByName(carried, allowMissingColumns=True).withColumn("_found", F.last("_state", ignorenulls=True).over(walk)).where("_fact is not null")
    none = facts.where(F.col(fact_key).isNull() | F.col(fact_at).isNull())
    taken = {c.lower() for c in facts.columns}
    named = {c: c if c.lower() not in taken else f"{c}_as_of" for c in cols}
    found = met.select("_fact.*", *[F.when(F.col("_found.alive"), F.col(f"_found.row.{c}")).alias(n) for c, n in named.items()])
    return found.unionByName(none, allowMissingColumns=True)
