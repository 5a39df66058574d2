"""Mixing sources to target weights by capped water-filling (operator 4).

Sources, ordered by code point with null last, get the weights in turn; the mix has ``budget`` times the words of
all documents.  A source's target is its share by weight, clamped at ``max_epochs`` times its words; the excess goes
to the other sources by weight until none is above.  That end state has one water level: the sources in order of
``cap / weight`` are clamped as long as this ratio is at most the level that the sources from there on would share, so one
pass over the per-source sums finds it.

A source's documents are each taken ``floor(target / words)`` times, and for the rest of the target a prefix of them in
an order given by a seeded hash once more: a document belongs to the prefix when the middle of its words does, so the words
taken differ from the target by at most half a document.  The prefix is found in two steps, the sums of hash buckets and
then the documents of the one bucket that is cut, so no source passes one task.

Defined results: null texts have no words; sources without words get target 0 and their documents are taken never or
whole times with 0 words; rows with equal ids and texts are each their own, and which of them is taken
once more makes no difference; null ids count as one id, null texts as empty; columns other than doc_id, source and text aren't read; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, numbered, row_number, stored, text_or_empty

WEIGHTS = (3, 1, 2)
#: Leading hex digits of the seeded hash that name a bucket: 4096 buckets a source.
BUCKET_DIGITS = 3


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """(source, source_size) → the same with ``target``.  One row per source, so the windows run over few rows."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", (F.row_number().over(order) - 1) % len(weights))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("rank") + 1)) \
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) * F.lit(float(budget)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / \
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    clamped = ranked.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    # The first source that is not clamped sets the level of all from there on.
    water = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(whole)
    return clamped.withColumn("water", water["level"]).select(
        "source", "source_size",
        F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("water"))).alias("target"))


def mix(docs: DataFrame, seed: str = "mix-1", weights=WEIGHTS, budget: float = 1.5, max_epochs: float = 2.0,
        rid: str | None = None) -> DataFrame:
    """Per document: rid (the column ``rid``, or a new number), doc_id, source, size, source_size, target, repeats, taken."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
                       F.md5(text_or_empty().cast("binary")).alias("text_order"), row_number(rid)) \
        .withColumn("order", F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    rows = stored(rows, "op4-rows")
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, max_epochs) \
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")) \
        .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    goal = stored(goal.withColumn("ahead", F.lit(0).cast("long")).withColumnRenamed("source", "s"), "op4-targets")
    open_, done = rows.join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s"), []
    steps = _steps()
    for n, step in enumerate(steps, 1):
        sums = open_.withColumn("step", step).groupBy("source", "step", "part", "ahead").agg(F.sum("size").alias("words"))
        before = Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
        ahead = F.col("ahead") + F.coalesce(F.sum("words").over(before), F.lit(0).cast("long"))
        taken = (2 * ahead + F.col("words") <= 2 * F.col("part")).cast("int")  # of one document
        if n < len(steps):
            taken = F.when(ahead + F.col("words") <= F.col("part"), 1).when(ahead >= F.col("part"), 0).otherwise(2)
        cut = sums.select(F.col("source").alias("s"), F.col("step").alias("b"), ahead.alias("now"), taken.alias("state"))
        judged = open_.withColumn("step", step).join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("step") == F.col("b"))) \
            .withColumn("ahead", F.col("now")).drop("s", "b", "now", "step")
        if n < len(steps):
            judged = stored(judged, "op4-judged") if n == 1 else judged
            open_ = stored(judged.where("state = 2").drop("state"), "op4-cut")
        done.append(judged.where("state < 2"))
    return reduce(DataFrame.unionByName, done).withColumn("repeats", F.col("whole") + F.col("state")) \
        .select("rid", "doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def _steps() -> list[Column]:
    """How the group in which a source's prefix ends is divided, step by step, down to one document.

    Ids by the first digits of their hash, then one by one; of equal ids, texts by the first digits of theirs, then one by one; of equal rows, which
    are interchangeable, the parts of the input that hold them, then one by one.  No step sorts more than some thousand sums of a source, or the
    members of one group of the step before.
    """
    digits = lambda c: F.substring(c, 1, BUCKET_DIGITS)
    return [digits("order"), F.col("order"), digits("text_order"), F.col("text_order"), F.shiftright("rid", 33).cast("string"), F.lpad(F.col("rid").cast("string"), 20, "0")]


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    rows, rid = numbered(docs, "op4-docs")
    n = fresh(rows, "repeats")
    plan = mix(rows, **options, rid=rid).where("repeats > 0").select(F.col("rid").alias(rid), F.col("repeats").alias(n))
    return rows.join(plan, rid) \
        .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))).select(*docs.columns)
