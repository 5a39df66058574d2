"""Pre-aggregations and refined (silver / gold) tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import latest_per_key

MONEY = "decimal(18,2)"
VALID_STATUS = ["created", "approved", "refunded"]


def money_sum(c: str | Column) -> Column:
    """Sum of money as exact decimals (order-independent), returned as double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(MONEY)).cast("double")


def merchant_totals(orders: DataFrame, dim: str = "merchant_id") -> DataFrame:
    """``sum(amount), count(*) by merchant_id`` (O30); partial + final aggregation."""
    return orders.groupBy(dim).agg(money_sum("amount").alias("sum_amount"),
                                   F.count(F.lit(1)).alias("order_count"))


def merchant_totals_refresh(stored: DataFrame, orders_now: DataFrame,
                            touched: DataFrame, dim: str = "merchant_id") -> DataFrame:
    """Refresh a stored aggregate for the groups touched since the last run.

    Only rows of touched merchants are re-aggregated; the other stored rows pass
    through.  The joins compare null-safely: rows without a merchant are a group
    too.  AQE broadcasts a small touched set, so neither side is shuffled for it.
    """
    groups = touched.select(F.col(dim).alias("_group")).distinct()

    def same(df: DataFrame):
        return df[dim].eqNullSafe(groups["_group"])

    fresh = merchant_totals(orders_now.join(groups, same(orders_now), "left_semi"), dim)
    return stored.join(groups, same(stored), "left_anti").unionByName(fresh)


def touched_groups(before: DataFrame, delta: DataFrame, key: str = "order_id",
                   dim: str = "merchant_id") -> DataFrame:
    """Groups of changed rows, old and new version (a row may move merchants)."""
    keys = delta.select(key).distinct()
    old = before.join(keys, key, "left_semi").select(dim)
    return old.unionByName(delta.select(dim)).distinct()


def exact_totals(orders: DataFrame, dim: str = "merchant_id") -> DataFrame:
    """``merchant_totals`` in a form that rows can be taken out of again: exact sum, number of amounts, number of rows."""
    return orders.groupBy(dim).agg(F.sum(F.col("amount").cast(MONEY)).cast("decimal(38,2)").alias("sum_exact"),
                                   F.count("amount").alias("amount_count"), F.count(F.lit(1)).alias("order_count"))


def apply_signed(stored: DataFrame, signed: DataFrame, dim: str = "merchant_id") -> DataFrame:
    """Refresh ``exact_totals`` by signed rows alone (O31): a row's old image is subtracted from its old group, the new
    one added to its new group, and a group without rows goes.

    Only the changes and the stored groups are read, never the table.  Changes are added up before they
    meet the groups, so a hot group costs a row a task.
    """
    sign, amount = F.col("sign"), F.col("amount").cast(MONEY)
    delta = signed.groupBy(dim).agg(F.sum(sign * amount).cast("decimal(38,2)").alias("sum_exact"),
                                    F.sum(F.when(F.col("amount").isNotNull(), sign).otherwise(0)).cast("long").alias("amount_count"),
                                    F.sum(sign).cast("long").alias("order_count"))
    total = stored.unionByName(delta).groupBy(dim).agg(F.sum("sum_exact").cast("decimal(38,2)").alias("sum_exact"),
                                                       F.sum("amount_count").alias("amount_count"), F.sum("order_count").alias("order_count"))
    return total.where(F.col("order_count") > 0)


def totals_view(exact: DataFrame, dim: str = "merchant_id") -> DataFrame:
    """``exact_totals`` as ``merchant_totals`` shows them: a group without any amount has no sum."""
    return exact.select(dim, F.when(F.col("amount_count") > 0, F.col("sum_exact")).cast("double").alias("sum_amount"), "order_count")


def raw_projection(state: DataFrame) -> DataFrame:
    """Stored projection order_id, merchant_id, status, event_ts."""
    return state.select("order_id", "merchant_id", "status", "event_ts")


def silver_orders(bronze: DataFrame, dedupe: bool = True) -> DataFrame:
    """Cleaned, conformed orders: valid rows only, typed, one row per key."""
    valid = bronze.where(
        F.col("order_id").isNotNull() & F.col("event_ts").isNotNull()
        & F.col("amount").isNotNull() & (F.col("amount") >= 0)
        & F.col("status").isin(*VALID_STATUS))
    if dedupe:
        valid = latest_per_key(valid, "order_id", ["event_ts"])
    return valid.select(
        "order_id", "merchant_id", "status",
        F.col("amount").cast(MONEY).cast("double").alias("amount"),
        F.upper(F.col("currency")).alias("currency"),
        "event_ts",
        F.to_date("event_ts").alias("event_date"))


def gold_daily(silver: DataFrame) -> DataFrame:
    """Curated sums and counts per day and merchant."""
    return silver.groupBy("event_date", "merchant_id").agg(
        money_sum("amount").alias("sum_amount"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum(F.when(F.col("status") == "refunded", 1).otherwise(0)).alias("refunded_count"))
