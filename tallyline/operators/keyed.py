"""Keyed tables: whole-row put (last write wins) and column-level merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The last row of each key. Only the best row per key and input partition is shuffled."""
    newest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order_by])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def keyed_put(base: DataFrame, changes: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """`base` after writing `changes` over it, the last write of a key replacing the whole row.

    Where a change and the base row are equal in `order_by`, the change wins.
    """
    both = base.withColumn("_change", F.lit(0)).unionByName(changes.withColumn("_change", F.lit(1)))
    return latest_per_key(both, keys, [*order_by, "_change"]).drop("_change")


def keyed_merge(
    base: DataFrame,
    changes: DataFrame,
    keys: list[str],
    order_by: list[str],
    set: list[str] = (),
    add: list[str] = (),
    set_if_absent: list[str] = (),
    delete_flag: str | None = None,
) -> DataFrame:
    """`base` (unique keys) after a log of column-level changes.

    In order: `set` columns take the last value given, `add` columns grow by each value,
    `set_if_absent` columns keep the first value they ever got. A change with `delete_flag`
    true drops the row; later changes start a new one. A change on an absent key creates it.
    NULL in a change means the column is not touched. Columns of none of the three lists
    keep the base value.
    """
    at = F.struct(*order_by)
    deleted = None
    if delete_flag:
        is_delete = F.coalesce(F.col(delete_flag), F.lit(False))
        deleted = (
            changes.filter(is_delete).groupBy(*keys).agg(F.max(at).alias("_deleted_at"))
        )
        changes = (
            changes.filter(~is_delete)
            .join(deleted, keys, "left")
            .filter(F.col("_deleted_at").isNull() | (at > F.col("_deleted_at")))
        )
        base = base.join(deleted, keys, "left_anti")

    def given(column: str) -> Column:
        """(order, value) of the changes that touch the column, NULL for the others."""
        return F.when(F.col(column).isNotNull(), F.struct(*order_by, F.col(column).alias("_v")))

    totals = changes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_changes"),
        *[F.max(given(c))["_v"].alias(f"_set_{c}") for c in set],
        *[F.sum(c).alias(f"_add_{c}") for c in add],
        *[F.min(given(c))["_v"].alias(f"_first_{c}") for c in set_if_absent],
    )
    columns = []
    for c in base.columns:
        if c in keys:
            columns.append(F.col(c))
        elif c in set:
            columns.append(F.coalesce(f"_set_{c}", c).alias(c))
        elif c in add:
            total = F.coalesce(c, F.lit(0)) + F.coalesce(f"_add_{c}", F.lit(0))
            columns.append(
                F.when(F.col(c).isNull() & F.col(f"_add_{c}").isNull(), F.col(c)).otherwise(total).alias(c)
            )
        elif c in set_if_absent:
            columns.append(F.coalesce(c, f"_first_{c}").alias(c))
        else:
            columns.append(F.col(c))
    return base.join(totals, keys, "full_outer").select(*columns)
