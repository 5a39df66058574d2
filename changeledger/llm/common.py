"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

#: Words of the contracts: runs without space, tab, newline, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Every reader of the result scans the same files, so row ids made before the write stay fixed, lineage is
    cut, and a lost executor costs no recomputation of the stages before.
    """
    path = work_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` stored with a row number, and that column's name.  A number made in a scan may change in the next one, as the
    input is split by the parallelism of the moment, so a decision and what is joined to it both read the stored one.
    """
    rid = fresh(docs, "rid")
    return stored(docs.withColumn(rid, F.monotonically_increasing_id()), name), rid


def row_number(rid: str | None) -> Column:
    """The stored number in column ``rid``, or without one a new number, for a scan whose result is stored itself."""
    return (F.monotonically_increasing_id() if rid is None else F.col(rid)).alias("rid")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, prefixed until no column of ``df`` is called so (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that Python objects of few texts live at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows sorted by ``key`` in tables that never split a run of equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        column = batch.column(key)
        last = column[n - 1].as_py()
        if held and held[-1].column(key)[held[-1].num_rows - 1].as_py() != column[0].as_py():
            yield pa.Table.from_batches(held)
            held = []
        values = column.to_pylist()
        cut = n - 1
        while cut > 0 and values[cut - 1] == last:
            cut -= 1
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
