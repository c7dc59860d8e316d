"""Running totals per key that stay distributed when one key holds most of the rows.

A window partitioned by a tenant, session or file name puts that whole key into one task.
Here only the *hot* keys (more than `hot_rows` rows) are cut into consecutive slices of
their order (time or sequence ranges). A slice is summed before any shuffle, the slice
totals are carried forward in a small window, and the row window runs inside one slice.
Every other key stays one slice, so the ordinary case is the ordinary window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000
HOT, SLICE = "_hot", "_slice"
WHOLE_KEY = -(1 << 62)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than `hot_rows` rows.

    At most rows / hot_rows keys exist, which is the size bound behind broadcasting them.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > hot_rows).select(*keys, F.lit(True).alias(HOT))


def same_key_join(df: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys, where NULL equals NULL; the keys are those of `df`."""
    renamed = other.withColumnsRenamed({k: f"_other_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & df[k].eqNullSafe(renamed[f"_other_{k}"])
    return df.join(renamed, condition, how).drop(*[f"_other_{k}" for k in keys])


def with_slices(df: DataFrame, keys: list[str], slice_no: Column, hot: DataFrame) -> DataFrame:
    """Add `_hot` and `_slice`: `slice_no` for hot keys, one constant for all others.

    `slice_no` must be a BIGINT that never falls along the order of the key's rows.
    """
    marked = same_key_join(df, F.broadcast(hot), keys, "left").withColumn(HOT, F.coalesce(HOT, F.lit(False)))
    return marked.withColumn(SLICE, F.when(F.col(HOT), slice_no).otherwise(F.lit(WHOLE_KEY)))


def earlier_slices(sliced: DataFrame, keys: list[str], own: bool = False, **totals) -> DataFrame:
    """Per hot slice, what all earlier slices of its key amount to.

    Each total is (aggregate over a slice, function combining slices), e.g.
    `before=(F.sum("tokens"), F.sum)`. The first slice of a key gets NULL. With `own`, the
    slice's own totals are added as `<name>_own`.
    """
    per_slice = (
        sliced.filter(HOT)
        .groupBy(*keys, SLICE)
        .agg(*[total.alias(name) for name, (total, _) in totals.items()])
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(SLICE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    return per_slice.select(
        *keys,
        SLICE,
        *[combine(F.col(name)).over(earlier).alias(name) for name, (_, combine) in totals.items()],
        *[F.col(name).alias(f"{name}_own") for name in totals if own],
    )


def slice_window(keys: list[str], *order) -> Window:
    """The window of one slice in the given order."""
    return Window.partitionBy(*keys, SLICE).orderBy(*order)


def in_pages(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    slice_no: Column,
    page: str,
    page_rows: int,
    *totals: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Aggregate each key's rows, in order, by pages of `page_rows` rows numbered from 0.

    An ordinary key is numbered and grouped after one shuffle. Only rows of hot keys, whose
    pages may span two slices, are shuffled again.
    """
    placed = numbered(df, keys, order, slice_no, "_pos", hot_rows).withColumn(
        page, F.expr(f"_pos div {int(page_rows)}")
    )
    whole = F.col(SLICE) == WHOLE_KEY
    ordinary = placed.filter(whole).groupBy(*keys, SLICE, page).agg(*totals).drop(SLICE)
    return ordinary.unionByName(placed.filter(~whole).groupBy(*keys, page).agg(*totals))


def numbered(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    slice_no: Column,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add `name`, the 0-based position of each row in its key's order, and the slice."""
    sliced = with_slices(df, keys, slice_no, hot_keys(df, keys, hot_rows))
    carried = earlier_slices(sliced, keys, _start=(F.count(F.lit(1)), F.sum))
    position = F.row_number().over(slice_window(keys, *order)) - 1
    return (
        same_key_join(sliced, carried, [*keys, SLICE], "left")
        .withColumn(name, F.coalesce("_start", F.lit(0)) + position)
        .drop("_start", HOT)
    )


def seconds_slice(ts: str, seconds: int) -> Column:
    """Slice number of a timestamp column for slices of the given length."""
    return F.expr(f"unix_seconds({ts}) div {int(seconds)}")


def sequence_slice(seq: str, rows: int) -> Column:
    """Slice number of an integer sequence column for slices of the given length."""
    return F.expr(f"cast({seq} as bigint) div {int(rows)}")


def salted_join(
    one: DataFrame, many: DataFrame, keys: list[str], hot: DataFrame, spread: Column, salts: int = 64
) -> DataFrame:
    """Inner join of a table with unique keys to a table where some keys are hot.

    Rows of a hot key on the many side are spread over `salts` tasks by `spread`; only the
    matching single rows of the other side are repeated.
    """
    hot = F.broadcast(hot)
    salted_many = same_key_join(many, hot, keys, "left").withColumn(
        "_salt", F.when(F.col(HOT), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(0)
    )
    salted_one = same_key_join(one, hot, keys, "left").withColumn(
        "_salt",
        F.explode(F.when(F.col(HOT), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))),
    )
    return salted_one.drop(HOT).join(salted_many.drop(HOT), [*keys, "_salt"]).drop("_salt")
