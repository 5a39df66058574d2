"""Three-way merge of a table's branches by key (O64, O65): base, main and branch versions of the same table.

A key's row is compared column by column with the version that both sides come from.  What one side changed is taken
from it; what both changed alike is taken once; what they changed differently is a conflict:

==================  =====================================================
kind                main and branch, seen from the base
==================  =====================================================
``update/update``   a column changed on both sides to different values
``update/delete``   changed on main, deleted on the branch
``delete/update``   deleted on main, changed on the branch
``add/add``         added on both sides with different values
``repeated_key``    several rows of one key on a side: no row to compare
``no_key``          a side has rows without a key, and they are not the base's
==================  =====================================================

All sides are read once and meet in one shuffle on the key; partial aggregation collapses rows without a key before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIDES = ("base", "main", "branch")


def compare(base: DataFrame, main: DataFrame, branch: DataFrame, key: str = "order_id") -> DataFrame:
    """One row per key: ``base``, ``main``, ``branch`` (structs, null where the side lacks the key), ``kind`` of conflict
    (null: none), ``columns`` in conflict, and ``merged``, the resulting row (null: none)."""
    cols = [c for c in main.columns if c != key]
    maps = {f.name for f in main.schema.fields if isinstance(f.dataType, T.MapType)}

    def has(side: str) -> Column:
        return F.col(f"_n_{side}") > 0

    def value(side: str, c: str) -> Column:
        return F.col(side).getField(c)

    def compared(row: str, c: str) -> Column:
        """Maps have no equality; their sorted entries do."""
        return F.array_sort(F.map_entries(value(row, c))) if c in maps else value(row, c)

    def changed(side: str, c: str) -> Column:
        return ~compared(side, c).eqNullSafe(compared("base", c))

    tagged = [df.select(key, F.struct(*cols).alias("_row"), F.lit(side).alias("_side")) for side, df in zip(SIDES, (base, main, branch))]
    of = {side: F.col("_side") == side for side in SIDES}
    digest = F.xxhash64(*[compared("_row", c) for c in cols]).cast("decimal(38,0)")
    grouped = reduce(DataFrame.unionByName, tagged).groupBy(key).agg(
        *[F.count(F.when(of[s], 1)).alias(f"_n_{s}") for s in SIDES],
        *[F.sum(F.when(of[s], digest)).alias(f"_sum_{s}") for s in SIDES],
        *[F.any_value(F.when(of[s], F.col("_row")), True).alias(s) for s in SIDES])

    any_change = {s: reduce(lambda a, b: a | b, [changed(s, c) for c in cols], F.lit(False)) for s in ("main", "branch")}
    both_differ = {c: ~compared("main", c).eqNullSafe(compared("branch", c)) for c in cols}
    clash = {c: both_differ[c] & F.when(has("base"), changed("main", c) & changed("branch", c)).otherwise(True) for c in cols}
    clashing = F.array_compact(F.array(*[F.when(clash[c], F.lit(c)) for c in cols]))
    same_rows = reduce(lambda a, b: a & b, [F.col(f"_n_{s}").eqNullSafe(F.col("_n_base")) & F.col(f"_sum_{s}").eqNullSafe(F.col("_sum_base")) for s in ("main", "branch")])
    kind = (F.when(F.col(key).isNull(), F.when(~same_rows, "no_key"))
             .when(F.greatest(*[F.col(f"_n_{s}") for s in SIDES]) > 1, F.when(~same_rows, "repeated_key"))
             .when(has("base") & has("main") & ~has("branch") & any_change["main"], "update/delete")
             .when(has("base") & ~has("main") & has("branch") & any_change["branch"], "delete/update")
             .when(has("main") & has("branch") & (F.size(clashing) > 0), F.when(has("base"), "update/update").otherwise("add/add")))
    from_branch = F.struct(*[F.when(changed("branch", c), value("branch", c)).otherwise(value("main", c)).alias(c) for c in cols])
    merged = (F.when(has("base") & ~(has("main") & has("branch")), F.lit(None))  # one side deleted it
               .when(has("base"), from_branch)
               .otherwise(F.coalesce("main", "branch")))
    return grouped.select(key, *SIDES, kind.alias("kind"),
                          F.when(kind.isin("update/update", "add/add"), F.array_join(clashing, ",")).alias("columns"),
                          F.when(kind.isNull(), merged).alias("merged"),
                          (F.col(key).isNull() | (F.greatest(*[F.col(f"_n_{s}") for s in SIDES]) > 1)).alias("_unkeyed"))


def conflicts(compared: DataFrame, key: str = "order_id") -> DataFrame:
    """The keys that no rule decides, with both sides as JSON for the person who does."""
    return compared.where(F.col("kind").isNotNull()).select(key, "kind", "columns", F.to_json("main").alias("main"), F.to_json("branch").alias("branch"))


def merged_rows(compared: DataFrame, main: DataFrame, key: str = "order_id", prefer: str | None = None) -> DataFrame:
    """The merged table.  Conflicts take the row of ``prefer`` (``main`` or ``branch``); without it their keys keep main's rows.

    Repeated keys and rows without a key can't be merged row by row: main's rows of theirs stay.
    """
    if prefer not in (None, "main", "branch"):
        raise ValueError(f"prefer main or branch, not {prefer}")
    cols = [c for c in main.columns if c != key]
    decided = F.when(F.col("kind").isNull(), F.col("merged")).otherwise(F.col(prefer or "main"))
    one = compared.where(~F.col("_unkeyed")).select(key, decided.alias("_row")).where(F.col("_row").isNotNull())
    unkeyed = compared.where("_unkeyed").select(F.col(key).alias("_key"))
    kept = main.join(unkeyed, main[key].eqNullSafe(unkeyed["_key"]), "left_semi")
    return one.select(key, *[F.col(f"_row.{c}").alias(c) for c in cols]).select(*main.columns).unionByName(kept)
