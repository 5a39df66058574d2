"""The open ``_rest`` map: pack unknown attributes, read them back, promote them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ORDER_COLUMNS, REST_TYPE
from .flatten import quote

REST = "_rest"


def _as_text(field: T.StructField) -> Column:
    c = F.col(quote(field.name))
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def rest_pack(df: DataFrame, expected: list[str] | None = None, rest: str = REST) -> DataFrame:
    """Move every column outside ``expected`` into a ``map<string,string>``.

    Scalars are cast to text, complex values become JSON; absent (null)
    attributes are left out of the map.  With no extra columns the map is empty.
    """
    expected = expected if expected is not None else ORDER_COLUMNS
    extra = [f for f in df.schema.fields if f.name not in expected]
    if not extra:
        return df.withColumn(rest, F.create_map().cast(REST_TYPE))
    packed = F.map_from_arrays(
        F.array(*[F.lit(f.name) for f in extra]),
        F.array(*[_as_text(f) for f in extra]))
    packed = F.map_filter(packed, lambda _k, v: v.isNotNull()).cast(REST_TYPE)
    return df.withColumn(rest, packed).drop(*[f.name for f in extra])


def rest_value(key: str, rest: str = REST) -> Column:
    """One attribute of the map, null when absent."""
    return F.try_element_at(F.col(rest), F.lit(key))


def conditional_update(df: DataFrame, column: str, map_col: str, key: str | None = None) -> DataFrame:
    """``SET column = map[key] WHERE map[key] IS NOT NULL``."""
    key = key or column
    value = F.try_element_at(F.col(map_col), F.lit(key))
    if column in df.columns:
        return df.withColumn(column, F.coalesce(value, F.col(column)))
    return df.withColumn(column, value)


def rest_entries(df: DataFrame, key_col: str, rest: str = REST) -> DataFrame:
    """The map as rows ``(key_col, key, value)``."""
    return df.select(key_col, F.explode(rest).alias("key", "value"))
