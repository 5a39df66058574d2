"""Partition-bound helper: a range on ``event_ts`` also bounds ``event_date``.

Parquet partition pruning only looks at partition columns; a predicate on the
timestamp alone gives no ``PartitionFilters``.  Adding the implied date bounds
lets the scan skip whole day folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ts_range(df: DataFrame, lo: str | None = None, hi: str | None = None,
             ts: str = "event_ts", day: str = "event_date", hi_inclusive: bool = False) -> DataFrame:
    cond: Column = F.lit(True)
    if lo is not None:
        lo_c = F.lit(lo).cast("timestamp_ntz")
        cond = cond & (F.col(ts) >= lo_c) & (F.col(day) >= F.to_date(lo_c))
    if hi is not None:
        hi_c = F.lit(hi).cast("timestamp_ntz")
        cond = cond & ((F.col(ts) <= hi_c) if hi_inclusive else (F.col(ts) < hi_c))
        cond = cond & (F.col(day) <= F.to_date(hi_c))
    return df.where(cond)
