"""Connected components of a link table, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, name: str) -> DataFrame:
    """(a, b) links between longs → (node, label): the smallest node of its component, for every node that has a link.

    Each round hooks every node to its smallest neighbour if that is smaller, doubles the pointers until they all point to the ends of
    their chains, and replaces the ends of all links by what they point to; links inside one component fall away.  A chain of n
    nodes takes log2(n) doublings, and every node but the ends of chains is gone after the round.  All steps are aggregations and joins of
    tables in the shared folder; a node with very many links is folded map-side, and its join is split as skewed.
    """
    spark = links.sparkSession
    links = stored(links.where("a <> b").distinct(), f"{name}-links")
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("to")), f"{name}-hook")
        moved = True
        while moved:
            further = hook.select(F.col("node").alias("to"), F.col("to").alias("root"))
            hook = stored(hook.join(further, "to").select("node", F.col("root").alias("to"), (F.col("root") != F.col("to")).alias("moved")), f"{name}-hook")
            moved, hook = not hook.where("moved").isEmpty(), hook.drop("moved")
        ends = hook.select(F.col("node").alias("a"), F.col("to").alias("x"))
        other = hook.select(F.col("node").alias("b"), F.col("to").alias("y"))
        links = stored(links.join(ends, "a").join(other, "b").where("x <> y")
                       .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{name}-links")
        if labels is None:
            labels = hook.withColumnRenamed("to", "label")
        else:
            step = hook.select(F.col("node").alias("label"), F.col("to").alias("next"))
            labels = stored(labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label")), f"{name}-labels")
    if labels is None:
        return spark.createDataFrame([], "node long, label long")
    return labels
