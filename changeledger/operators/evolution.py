"""Schema evolution on Parquet: added, promoted and renamed columns (O54a-d).

Parquet files are immutable, so evolution is a list of steps applied on read:
``(snapshot_id, kind, args)`` with kinds ``add`` (column, type), ``promote``
(column, map column, key) and ``rename`` (old, new).  Reading snapshot ``v``
applies the steps with ``snapshot_id <= v`` in order; older snapshots keep
their older shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rest import conditional_update

Step = tuple  # (snapshot_id, kind, *args)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order, missing ones as typed NULLs."""
    have = set(df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in have
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def append_by_name(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows added to a table with columns matched by name."""
    return target.unionByName(align_to_schema(rows, target.schema))


def read_merged(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files written under different schemas read as one; absent columns read NULL."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def add_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))


def apply_steps(df: DataFrame, steps: list[Step], upto: int | None = None) -> DataFrame:
    """Apply evolution steps up to snapshot ``upto`` (all when None) (O54d)."""
    for step in sorted(steps, key=lambda s: s[0]):
        sid, kind, *args = step
        if upto is not None and sid > upto:
            break
        if kind == "add":
            df = add_column(df, args[0], args[1])
        elif kind == "promote":
            column, map_col, key = args
            df = conditional_update(add_column(df, column, "string"), column, map_col, key)
        elif kind == "rename":
            old, new = args
            df = df.withColumnsRenamed({old: new})
        else:
            raise ValueError(f"unknown evolution step {kind}")
    return df


def columns_at(schema: T.StructType, steps: list[Step], upto: int) -> list[str]:
    """Column names a reader of snapshot ``upto`` sees."""
    names = [f.name for f in schema.fields]
    for sid, kind, *args in sorted(steps, key=lambda s: s[0]):
        if sid > upto:
            break
        if kind in ("add", "promote") and args[0] not in names:
            names.append(args[0])
        elif kind == "rename":
            names = [args[1] if n == args[0] else n for n in names]
    return names
