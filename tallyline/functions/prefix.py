"""Running totals per key in the order of its rows, as a prefix scan in two levels.

A window over a key puts the whole key into one task. Here the rows are cut into ranges of
(key, order) of about equal size, as many as there are shuffle partitions. A first pass over
the few columns that matter sums every key within every range; what lies in the ranges before is
carried on along the ranges of a key. Only a key that spans ranges has anything to carry, and a
range can break off two keys at most, so the carried sums are fewer than twice the ranges and are
broadcast. The rows then find their range from its first row, and windows run inside (key, range).

One route serves all keys: a key of any size, NULL among them, and rows that share one time are
cut where the ranges are.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.skew import same_key_join

SLICE, SPLIT = "_slice", "_split"
_GROUP = 64

Totals = dict[str, tuple[Column, Callable]]


class Cuts(NamedTuple):
    """Where keys are cut: one row per key that spans ranges, or None where no key does."""

    keys: list[str]
    order: list[str]
    kinds: dict[str, str]
    table: DataFrame | None


def cut(
    df: DataFrame, keys: list[str], order: list[str], uses: tuple[str, ...] = (), parts: int | None = None, **totals
) -> Cuts:
    """Cut the rows of `df` by `keys` and `order` and sum up each key's ranges.

    Each total is (aggregate over a range, function combining ranges), e.g.
    `before=(F.sum("tokens"), F.sum)`; `uses` names the columns it reads besides keys and order.
    This runs a job over these columns. `parts` sets the number of ranges, by default that of
    the session's shuffle partitions, which adaptive execution lowers for little data.
    """
    narrow = df.select(*dict.fromkeys([*keys, *order, *uses]))
    by = [*keys, *order]
    ranged = narrow.repartitionByRange(parts, *by) if parts else narrow.repartitionByRange(*by)
    sums = (
        ranged.withColumn("_range", F.spark_partition_id())
        .groupBy(*keys, "_range")
        .agg(F.min(F.struct(*order)).alias("_start"), *[total.alias(name) for name, (total, _) in totals.items()])
    )
    key = Window.partitionBy(*keys)
    earlier = key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.struct(
        F.lit(0).alias("_none"),
        *[combine(F.col(name)).over(earlier).alias(name) for name, (_, combine) in totals.items()],
        *[F.col(name).alias(f"{name}_own") for name in totals],
    )
    spanning = (
        sums.withColumn("_ranges", F.count(F.lit(1)).over(key))
        .filter("_ranges > 1")
        .select(*keys, F.struct("_range", "_start", carried.alias("_carried")).alias("_r"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("_r")).alias("_all"))
    )
    starts = F.transform("_all", lambda r: r["_start"])
    groups = F.sequence(F.lit(0), F.expr(f"(size(_all) - 1) div {_GROUP}"))
    table = spanning.select(
        *keys,
        F.transform(groups, lambda g: F.slice(starts, g * _GROUP + 1, F.lit(_GROUP))).alias("_groups"),
        F.transform("_all", lambda r: r["_carried"]).alias("_sums"),
    )
    fields = table.schema["_sums"].dataType.elementType
    kinds = {f.name: f.dataType.simpleString() for f in fields if f.name != "_none"}
    found = table.toArrow()
    return Cuts(keys, order, kinds, df.sparkSession.createDataFrame(found, table.schema) if len(found) else None)


def sliced(df: DataFrame, cuts: Cuts) -> DataFrame:
    """Add SLICE, the number of a row's range within its key, SPLIT, whether the key has several,
    and each total: `<name>` over all earlier ranges (NULL before the first) and `<name>_own`."""
    if cuts.table is None:
        return df.withColumns(
            {SLICE: F.lit(0), SPLIT: F.lit(False)} | {name: F.lit(None).cast(kind) for name, kind in cuts.kinds.items()}
        )
    at = F.struct(*cuts.order)
    marked = same_key_join(df, F.broadcast(cuts.table), cuts.keys, "left")
    group = F.size(F.filter("_groups", lambda g: g[0] <= at))
    within = F.size(F.filter(F.element_at("_groups", F.col("_g")), lambda s: s <= at))
    number = F.when(F.col("_groups").isNull(), 0).otherwise((F.col("_g") - 1) * _GROUP + within - 1)
    placed = (
        marked.withColumn("_g", F.when(F.col("_groups").isNotNull(), group))
        .withColumns({SLICE: number, SPLIT: F.col("_groups").isNotNull()})
        .withColumn("_c", F.element_at("_sums", F.col(SLICE) + 1))
    )
    return placed.withColumns({name: F.col("_c")[name] for name in cuts.kinds}).drop("_groups", "_sums", "_g", "_c")


def per_slice(table: DataFrame, cuts: Cuts) -> DataFrame:
    """Rows of a table with one row per key, repeated for each slice of the key, with SLICE."""
    if cuts.table is None:
        return table.withColumn(SLICE, F.lit(0))
    counts = cuts.table.select(*cuts.keys, F.size("_sums").alias("_n"))
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1))
    return same_key_join(table, F.broadcast(counts), cuts.keys, "left").withColumn(SLICE, every).drop("_n")


def carry(df: DataFrame, cuts: Cuts, **totals) -> DataFrame:
    """Add totals that only the rows of `df`, which `sliced` made, give: as in `cut`, over earlier slices.

    Costs a second look at the rows of keys that span ranges, and nothing where there are none.
    """
    keys = [*cuts.keys, SLICE]
    if cuts.table is None:
        kinds = df.groupBy(*keys).agg(*[total.alias(name) for name, (total, _) in totals.items()]).schema
        return df.withColumns({name: F.lit(None).cast(kinds[name].dataType) for name in totals})
    earlier = Window.partitionBy(*cuts.keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.filter(SPLIT).groupBy(*keys).agg(*[total.alias(name) for name, (total, _) in totals.items()])
    before = sums.select(*keys, *[combine(F.col(name)).over(earlier).alias(name) for name, (_, combine) in totals.items()])
    return same_key_join(df, F.broadcast(before), keys, "left")


def slice_window(cuts: Cuts) -> Window:
    """The window of one slice in its order."""
    return Window.partitionBy(*cuts.keys, SLICE).orderBy(*cuts.order)


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """Add `name`, the 0-based position of each row in its key's order, with SLICE and SPLIT."""
    cuts = cut(df, keys, order, parts=parts, _rows=(F.count(F.lit(1)), F.sum))
    position = F.coalesce("_rows", F.lit(0)) + F.row_number().over(slice_window(cuts)) - 1
    return sliced(df, cuts).withColumn(name, position).drop("_rows", "_rows_own")


def in_pages(
    df: DataFrame, keys: list[str], order: list[str], page: str, page_rows: int, *totals: Column, parts: int | None = None
) -> DataFrame:
    """Aggregate each key's rows, in order, by pages of `page_rows` rows numbered from 0.

    Pages of an ordinary key are formed where its rows are numbered; only rows of keys that span
    ranges, whose pages may span two slices, are shuffled again.
    """
    placed = numbered(df, keys, order, "_pos", parts).withColumn(page, F.expr(f"_pos div {int(page_rows)}"))
    ordinary = placed.filter(~F.col(SPLIT)).groupBy(*keys, SLICE, page).agg(*totals).drop(SLICE)
    return ordinary.unionByName(placed.filter(SPLIT).groupBy(*keys, page).agg(*totals))
