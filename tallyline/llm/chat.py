"""Chat transcripts: snapshots of growing conversations collapse to the longest, then render.

A conversation that is logged again after every turn is a prefix of its later snapshots. Rolling
hashes stand for turn prefixes: the hash of the first n turns combines a hash of each turn with
its place. A conversation is dropped by an anti-join where a longer one has its hash at its
length. Only DataFrame functions are used.

A conversation of very many turns is cut into slices of the turn number, so that running
hashes and pages need no window over the whole of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.tables import kept

SLICE_TURNS = 1000
PAGE_TURNS = 1000


def _turn_hash(seed: int) -> Column:
    parts = [F.lit(seed), F.col("place"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return F.xxhash64(*parts)


def numbered_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, place, role, text, h1, h2): turns of each conversation numbered from 1, with hashes.

    Order is the turn, then role and text; equal rows of one conversation count once. The
    places of a slice of turns follow from the sizes of the slices before it.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    ).distinct()
    rows = rows.withColumn("slice", F.expr(f"coalesce(turn div {SLICE_TURNS}, -9223372036854775808)"))
    sizes = rows.groupBy("conv", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("conv", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv", "slice").orderBy("turn", "role", "text")
    placed = rows.withColumn("within", F.row_number().over(inside)).join(
        sizes.withColumnsRenamed({"conv": "_conv", "slice": "_slice"}),
        F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("slice") == F.col("_slice")),
    )
    placed = placed.withColumn("place", F.col("before") + F.col("within"))
    return placed.select("conv", "slice", "place", "role", "text", _turn_hash(11).alias("h1"), _turn_hash(23).alias("h2"))


def prefix_hashes(numbered: DataFrame) -> DataFrame:
    """(conv, place, h1, h2): the hash of the first `place` turns, for every place."""
    slices = numbered.groupBy("conv", "slice").agg(F.bit_xor("h1").alias("s1"), F.bit_xor("h2").alias("s2"))
    before = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(
        F.col("conv").alias("_conv"),
        F.col("slice").alias("_slice"),
        *[F.coalesce(F.bit_xor(f"s{k}").over(before), F.lit(0)).alias(f"c{k}") for k in (1, 2)],
    )
    inside = Window.partitionBy("conv", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = numbered.select("conv", "slice", "place", *[F.bit_xor(f"h{k}").over(inside).alias(f"r{k}") for k in (1, 2)])
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("slice") == F.col("_slice"))
    return rolled.join(carried, same).select(
        "conv", "place", *[F.col(f"r{k}").bitwiseXOR(F.col(f"c{k}")).alias(f"h{k}") for k in (1, 2)]
    )


def collapsed(numbered: DataFrame) -> DataFrame:
    """(conv) of the conversations that are no prefix of another one.

    Of equal conversations the smallest id stays. Prefixes that many conversations share are
    counted before the shuffle.
    """
    prefixes = prefix_hashes(numbered)
    whole = numbered.groupBy("conv").agg(
        F.max("place").alias("place"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    longest = (
        prefixes.join(
            whole.select(F.col("conv").alias("_conv"), F.col("place").alias("turns")), F.col("conv").eqNullSafe(F.col("_conv"))
        )
        .filter("place < turns")
        .select("place", "h1", "h2")
        .distinct()
    )
    equal = whole.groupBy("place", "h1", "h2").agg(F.min(F.struct(F.col("conv").isNull().alias("last"), "conv")).alias("first"))
    return equal.join(longest, ["place", "h1", "h2"], "left_anti").select("first.conv")


def rendered_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    page_turns: int = PAGE_TURNS,
) -> DataFrame:
    """One row per page of `page_turns` turns of each maximal conversation: conv_id, page, n_turns, chat.

    A turn is rendered as its role between marks, its text and an end mark. A conversation is
    dropped if its turns (role and text, in turn order) are the first turns of a longer one or
    equal those of one with a smaller id.

    Null roles and texts are rendered as `unknown` and empty but differ from such strings when
    conversations are compared; a null turn comes first. Equal rows of a conversation count once;
    different rows of one turn are ordered by role and text. Rows without conv_id form one
    conversation. An empty table gives an empty result; other columns are not used.
    """
    numbered = kept(numbered_turns(turns, conv_id, turn, role, text))
    left = kept(collapsed(numbered)).withColumnRenamed("conv", "_conv")
    pages = (
        numbered.join(left, F.col("conv").eqNullSafe(F.col("_conv")), "left_semi")
        .withColumn("page", F.expr(f"(place - 1) div {int(page_turns)}"))
        .withColumn(
            "line",
            F.concat(
                F.lit("<|im_start|>"), F.coalesce("role", F.lit("unknown")), F.lit("\n"),
                F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"),
            ),
        )
        .groupBy("conv", "page")
        .agg(F.count(F.lit(1)).alias("n_turns"), F.sort_array(F.collect_list(F.struct("place", "line"))).alias("lines"))
    )
    return pages.select(F.col("conv").alias("conv_id"), "page", "n_turns", F.array_join(F.col("lines.line"), "").alias("chat"))
