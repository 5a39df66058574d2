"""Schema walk that flattens nested structs into one ``select``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Extended-JSON wrappers that stand for a scalar: {"$date": …}, {"$oid": …}.
SCALAR_WRAPPERS = ("$date", "$oid", "$numberLong", "$numberDecimal")


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _wrapped_scalar(dt: T.DataType) -> list[str]:
    """Field path of a wrapped scalar, also of nested wrappers: {"$date": {"$numberLong": …}}."""
    path = []
    while isinstance(dt, T.StructType) and len(dt.fields) == 1 and dt.fields[0].name in SCALAR_WRAPPERS:
        path.append(dt.fields[0].name)
        dt = dt.fields[0].dataType
    return [] if isinstance(dt, T.StructType) else path


def flatten_columns(schema: T.StructType, sep: str = "_") -> list[Column]:
    """Columns that turn ``a.b.c`` into ``a_b_c``; arrays and maps stay whole.

    One-field extended-JSON wrappers are unwrapped first, so ``{"$date": x}``
    keeps its parent's name.  A flattened name that collides with an existing
    one gets a ``__2``/``__3`` suffix instead of producing an ambiguous column.
    """
    out: list[tuple[str, Column]] = []

    def walk(col: Column, name: str, dt: T.DataType) -> None:
        wrapper = _wrapped_scalar(dt)
        if wrapper:
            for part in wrapper:
                col = col.getField(part)
            out.append((name, col))
        elif isinstance(dt, T.StructType):
            for f in dt.fields:
                walk(col.getField(f.name), f"{name}{sep}{f.name}", f.dataType)
        else:
            out.append((name, col))

    for f in schema.fields:
        walk(F.col(quote(f.name)), f.name, f.dataType)

    seen: dict[str, int] = {}
    taken = {n for n, _ in out}
    cols = []
    for name, c in out:
        final = name
        if name in seen:
            i = seen[name] + 1
            while f"{name}__{i}" in taken:
                i += 1
            seen[name] = i
            final = f"{name}__{i}"
            taken.add(final)
        else:
            seen[name] = 1
        cols.append(c.alias(final))
    return cols


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    return df.select(*flatten_columns(df.schema, sep))
