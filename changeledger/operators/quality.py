"""Data-quality checks that gate publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

REPORT_COLUMNS = ["check_name", "value", "threshold", "passed"]


def row_count_delta(previous: DataFrame, current: DataFrame, max_change: float = 0.5) -> DataFrame:
    """Row counts of two snapshots, relative change, pass flag (O32). One scan of each."""
    both = (previous.select(F.lit(1).alias("_p"), F.lit(0).alias("_c"))
            .unionByName(current.select(F.lit(0).alias("_p"), F.lit(1).alias("_c"))))
    counts = both.agg(F.sum("_p").cast("long").alias("previous_rows"),
                      F.sum("_c").cast("long").alias("current_rows"))
    prev = F.coalesce(F.col("previous_rows"), F.lit(0))
    cur = F.coalesce(F.col("current_rows"), F.lit(0))
    change = F.when(prev == 0, F.when(cur == 0, 0.0).otherwise(1.0)) \
              .otherwise(F.abs(cur - prev) / prev)
    return counts.select(prev.alias("previous_rows"), cur.alias("current_rows"),
                         change.cast("double").alias("change_ratio"),
                         F.lit(float(max_change)).alias("threshold"),
                         (change <= max_change).alias("passed"))


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of nulls per key attribute in one pass, one row per column."""
    rates = df.agg(*[F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(c)
                     for c in columns])
    return rates.unpivot([], columns, "column_name", "null_rate") \
                .select("column_name", F.coalesce("null_rate", F.lit(0.0)).alias("null_rate"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Business keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def partition_presence(observed_days: DataFrame, start: str | None = None,
                       end: str | None = None, day: str = "dt") -> DataFrame:
    """Expected days with no data.

    Expected days are every day between ``start`` and ``end`` (defaults: the
    observed minimum and maximum); their number is bounded by the date span.
    """
    days = observed_days.select(F.col(day).cast("date").alias("dt")).distinct()
    span = days.agg(F.min("dt").alias("lo"), F.max("dt").alias("hi"))
    lo = F.lit(start).cast("date") if start else F.col("lo")
    hi = F.lit(end).cast("date") if end else F.col("hi")
    expected = span.select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("dt"))
    return expected.join(days, "dt", "left_anti").select(F.col("dt").alias("missing_dt"))


def quality_report(previous: DataFrame, current: DataFrame, key: list[str],
                   attributes: list[str], day_col: str | None = None,
                   max_change: float = 0.5, max_null_rate: float = 0.05,
                   materialize: bool = True) -> DataFrame:
    """All checks as rows (check_name, value, threshold, passed).

    ``current`` is checkpointed once to the shared checkpoint folder (unless it
    is already a stored table), so the checks scan stored rows instead of
    re-running the plan that produced them.  Row count and null rates come
    from one aggregate pass; duplicates and missing days need one more each.
    """
    if materialize:
        current = cut_lineage(current)
    prev_n = previous.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    stats = current.agg(F.count(F.lit(1)).alias("_n"),
                        *[F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(c)
                          for c in attributes])
    change = F.when(F.lit(prev_n) == 0, F.when(F.col("_n") == 0, 0.0).otherwise(1.0)) \
              .otherwise(F.abs(F.col("_n") - F.lit(prev_n)) / F.lit(prev_n)).cast("double")
    delta = stats.select(F.lit("row_count_delta").alias("check_name"), change.alias("value"),
                         F.lit(float(max_change)).alias("threshold"),
                         (change <= max_change).alias("passed"))
    nulls = stats.unpivot([], attributes, "column_name", "null_rate").select(
        F.concat(F.lit("null_rate:"), F.col("column_name")).alias("check_name"),
        F.coalesce("null_rate", F.lit(0.0)).alias("value"),
        F.lit(float(max_null_rate)).alias("threshold"),
        (F.coalesce("null_rate", F.lit(0.0)) <= max_null_rate).alias("passed"))
    dups = duplicate_keys(current, key).agg(F.count(F.lit(1)).cast("double").alias("value")) \
        .select(F.lit("duplicate_keys").alias("check_name"), "value",
                F.lit(0.0).alias("threshold"), (F.col("value") <= 0).alias("passed"))
    parts = [delta, nulls, dups]
    if day_col:
        missing = partition_presence(current.select(F.to_date(day_col).alias("dt")), day="dt") \
            .agg(F.count(F.lit(1)).cast("double").alias("value")) \
            .select(F.lit("missing_days").alias("check_name"), "value",
                    F.lit(0.0).alias("threshold"), (F.col("value") <= 0).alias("passed"))
        parts.append(missing)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def all_passed(report: DataFrame) -> bool:
    """Gate: True when no check failed (one small aggregate to the driver)."""
    row = report.agg(F.min(F.col("passed").cast("int")).alias("ok")).first()
    return bool(row and row["ok"] == 1)
