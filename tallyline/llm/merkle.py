"""A Merkle manifest of a table as a postorder append log.

Rows are leaves of one tree per key, in order; the trees' roots are leaves of one more tree.
Two consecutive nodes become their hash; a last single one becomes the hash of itself alone.

The log holds a tree's nodes in the order in which they are complete. Builders are aligned: one
takes 2^SPAN consecutive leaves from a multiple of 2^SPAN on and writes the whole subtree without
knowing the others. The builders' last nodes are the leaves of the next tier, whose builders
write the nodes above, and so on. Where a node lies follows from the sizes of the subtrees
before it: up to leaf i they hold 2i - popcount(i) nodes, and a node at level L comes L places
behind the last leaf below it. Siblings are addressed by that place; no tree is walked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.tables import kept, small_side

SPAN = 10
DIGEST = 32


def field(value: Column) -> Column:
    """A value as it is hashed: its length in bytes, a colon and its text; `-` for a null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Hexadecimal sha256 of the fields, joined."""
    return F.sha2(F.concat(*[field(x) for x in values]), 256)


def node_place(level: int, number: int, leaves: int) -> int:
    """Place in the log of a tree's node, counted from 0."""
    last = min((number + 1) << level, leaves) - 1
    return 2 * last - last.bit_count() + level


def height(leaves: int) -> int:
    """Levels above the leaves."""
    return (leaves - 1).bit_length()


def node_hash(*digests: bytes) -> bytes:
    """The node above the given ones."""
    return sha256("".join(x.hex() for x in digests).encode()).digest()


def _build(table: pa.Table, span: int) -> pa.Table:
    """One builder's part of the log: the nodes of its subtree as they are complete.

    In tier t, `number` counts nodes of level t * span. A run of nodes that lie side by side in the
    log is one row (tree, tier, builder, place of the first, digests). Leaves of a higher tier
    are in the log already.
    """
    tree, tier, builder, leaves = (table.column(x)[0].as_py() for x in ("tree", "tier", "builder", "leaves"))
    base, top = tier * span, height(leaves)
    order = np.argsort(table.column("number").to_numpy(), kind="stable")
    digests = table.column("digest").to_pylist()
    numbers = table.column("number").to_numpy()
    open_nodes: dict[int, bytes] = {}  # level -> left node waiting for its sibling
    runs: list[tuple[int, list[bytes]]] = []
    last = None
    for k in order.tolist():
        number, digest = int(numbers[k]), digests[k]
        end = ((number + 1) << base) >= leaves
        written = [digest] if tier == 0 else []
        level = 0
        while level < span and base + level < top:
            if number >> level & 1:
                digest = node_hash(open_nodes.pop(level), digest)
            elif end:
                digest = node_hash(digest)
            else:
                open_nodes[level] = digest
                break
            level += 1
            written.append(digest)
        if written:
            place = node_place(base + (tier > 0), number >> (tier > 0), leaves)
            if tier == 0 and runs:
                runs[0][1].extend(written)
            else:
                runs.append((place, written))
        last = digest
    return pa.table(
        {
            "tree": pa.array([tree] * len(runs), pa.int64()),
            "tier": pa.array([tier] * len(runs), pa.int32()),
            "builder": pa.array([builder] * len(runs), pa.int64()),
            "place": pa.array([x for x, _ in runs], pa.int64()),
            "digests": pa.array([b"".join(x) for _, x in runs], pa.binary()),
            "last": pa.array([None] * (len(runs) - 1) + [last], pa.binary()),
        }
    )


def append_log(leaves: DataFrame, sizes: DataFrame, span: int = SPAN) -> DataFrame:
    """The postorder logs of trees: tree, tier, builder, place, digests (side by side, 32 bytes each).

    `leaves` has tree, number (from 0 without gaps) and digest (binary); `sizes` has tree and
    leaves (their number) and is small or shuffled. An empty table gives an empty log.
    """
    level = leaves.select("tree", "number", "digest")
    log = None
    tier = 0
    most = sizes.agg(F.max("leaves")).first()[0] or 0
    while True:
        placed = level.join(sizes, "tree").withColumn("tier", F.lit(tier))
        placed = placed.withColumn("builder", F.shiftright("number", span))
        built = kept(
            placed.groupBy("tree", "builder").applyInArrow(
                lambda table: _build(table, span),
                "tree bigint, tier int, builder bigint, place bigint, digests binary, last binary",
            )
        )
        part = built.select("tree", "tier", "builder", "place", "digests")
        log = part if log is None else log.unionByName(part)
        tier += 1
        if height(max(most, 1)) <= tier * span:
            return log
        # trees that are complete do not go on to the next tier
        level = (
            built.filter("last is not null")
            .join(sizes, "tree")
            .filter(F.col("leaves") > (1 << (span * tier)))
            .select("tree", F.col("builder").alias("number"), F.col("last").alias("digest"))
        )


def roots(log: DataFrame, sizes: DataFrame) -> DataFrame:
    """tree, root (binary): the last node of each tree's log."""
    end = F.col("place") + F.octet_length("digests") / DIGEST
    ends = log.join(sizes, "tree").filter(end == _log_length(F.col("leaves")))
    return ends.select("tree", F.expr(f"substring(digests, -{DIGEST})").alias("root"))


def _height_column(leaves: Column) -> Column:
    return F.when(leaves <= 1, 0).otherwise(F.length(F.bin(leaves - 1)))


def _log_length(leaves: Column) -> Column:
    """Nodes of a tree: those up to its last leaf, and the levels above it."""
    last = leaves - 1
    return 2 * last - F.bit_count(last) + _height_column(leaves) + 1


def upper_siblings(log: DataFrame, sizes: DataFrame, span: int = SPAN) -> DataFrame:
    """Per aligned builder of leaves the siblings above its subtree: tree, builder, upper.

    `upper` is an array of (level, digest), lowest level first, without levels that have no
    sibling. Places are computed and looked up; every one lies in a run that starts at a place
    which is computed as well.
    """
    builders = sizes.filter(F.col("leaves") > (1 << span)).select(
        "tree", "leaves", F.explode(F.expr(f"sequence(0L, shiftright(leaves - 1, {span}))")).alias("builder")
    )
    levels = builders.withColumn("level", F.explode(F.sequence(F.lit(span), _height_column(F.col("leaves")) - 1)))
    number = F.expr(f"shiftright(builder, level - {span}) ^ 1")
    wanted = levels.withColumn("number", number).filter("shiftleft(number, level) < leaves")
    wanted = wanted.withColumn("last", F.least(F.expr("shiftleft(number + 1, level)"), "leaves") - 1)
    # the run holding a node begins at the first leaf of a builder, or one level above a tier
    tier = F.floor((F.col("level") - 1) / span)
    begin_leaf = F.expr(f"shiftleft(shiftright(last, {span}), {span})")
    at = F.expr("2 * last - bit_count(last) + level")
    begin = F.when(tier == 0, 2 * begin_leaf - F.bit_count(begin_leaf)).otherwise(
        F.expr("2 * last - bit_count(last)") + tier * span + 1
    )
    addressed = wanted.select("tree", "builder", "level", begin.alias("place"), (at - begin).cast("int").alias("offset"))
    found = addressed.join(log.select("tree", "place", "digests"), ["tree", "place"])
    digest = F.expr(f"substring(digests, offset * {DIGEST} + 1, {DIGEST})")
    return found.groupBy("tree", "builder").agg(
        F.sort_array(F.collect_list(F.struct("level", digest.alias("digest")))).alias("upper")
    )


def _prove(span: int, carried: list[str]):
    def prove(left: pa.Table, right: pa.Table) -> pa.Table:
        """Siblings and refolded root of each leaf of one builder."""
        leaves = left.column("leaves")[0].as_py()
        runs, begin = right.column("digests")[0].as_py(), right.column("place")[0].as_py()
        upper = {x["level"]: x["digest"] for x in right.column("upper")[0].as_py() or ()}
        top = height(leaves)
        siblings, folded = [], []
        for number, digest in zip(left.column("number").to_pylist(), left.column("digest").to_pylist(), strict=True):
            beside = []
            for level in range(top):
                other = (number >> level) ^ 1
                if other << level >= leaves:
                    digest = node_hash(digest)
                    continue
                at = (node_place(level, other, leaves) - begin) * DIGEST
                sibling = runs[at : at + DIGEST] if level < span else upper[level]
                beside.append(sibling)
                digest = node_hash(sibling, digest) if number >> level & 1 else node_hash(digest, sibling)
            siblings.append(b"".join(beside))
            folded.append(digest)
        own = {x: left.column(x) for x in ("tree", "number", *carried)}
        return pa.table(own | {"siblings": pa.array(siblings, pa.binary()), "folded": pa.array(folded, pa.binary())})

    return prove


def proofs(leaves: DataFrame, sizes: DataFrame, log: DataFrame, carried: tuple[str, ...] = (), span: int = SPAN) -> DataFrame:
    """tree, number, the carried columns, siblings (side by side, lowest level first), folded (root).

    `leaves` has tree, number and `digest`, which is folded with the siblings of the log's leaf of
    that number, and may differ from the log's.
    """
    own = log.filter("tier = 0").select("tree", "builder", "place", "digests")
    parts = own.join(upper_siblings(log, sizes, span), ["tree", "builder"], "left")
    placed = leaves.join(sizes, "tree").withColumn("builder", F.shiftright("number", span))
    kinds = ", ".join(f"{x} {leaves.schema[x].dataType.simpleString()}" for x in carried)
    return (
        placed.select("tree", "builder", "number", "leaves", "digest", *carried)
        .groupBy("tree", "builder")
        .cogroup(parts.groupBy("tree", "builder"))
        .applyInArrow(
            _prove(span, list(carried)),
            f"tree bigint, number bigint{', ' * bool(kinds)}{kinds}, siblings binary, folded binary",
        )
    )


def numbered(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Add `number`, the place of a row among those of its key, from 0.

    Rows are dealt by ranges of `order`, which begins with the key; a range counts its rows of
    each key, and the counts are carried on. No key is gathered anywhere.
    """
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = kept(sorted_rows.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    parts = placed.groupBy(*key, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept(parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))))
    found = small_side(starts.withColumnsRenamed({x: f"_{x}" for x in key}).withColumnRenamed("_part", "_own"))
    same = reduce(Column.__and__, [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in key], F.col("_part") == F.col("_own"))
    number = F.col("_before") + F.col("_at") - F.col("_first")
    return placed.join(found, same).select(*rows.columns, number.alias("number"))


def manifest(
    docs: DataFrame,
    fields: list[str],
    doc_id: str = "doc_id",
    key: str = "lang",
    tampered: dict[str, Column] | None = None,
    span: int = SPAN,
) -> DataFrame:
    """Leaf, roots, proof and check of every row: doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified, key, number, siblings.

    A leaf is the hash of `fields`; there is a tree for each value of `key`, in which rows ascend
    by `doc_id` (null first, rows of equal id by their leaf), and the trees' roots, ordered by
    key (null first, by bytes), are the leaves of the tree whose root is `root`. `siblings` are the
    digests beside the way from leaf to root, 32 bytes each; `proof_sha256` is their hash, of
    nothing where there are none. `folded_root` is computed from the siblings and the leaf of
    the row with the columns of `tampered` in place of its own; `verified` tells whether it is
    the root.

    Nulls are values like any other, repeated rows are leaves each, texts are hashed whole, an
    empty table gives an empty result, and other columns are not looked at. A task holds the
    nodes of one builder, 2^(span + 1) digests at most.
    """
    rows = {x: F.col(x) for x in fields}
    changed = rows | (tampered or {})
    hashed = kept(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(key).cast("string").alias("key"),
            F.unhex(leaf_hash(*rows.values())).alias("leaf"),
            F.unhex(leaf_hash(*changed.values())).alias("changed"),
        )
    )
    # the last column parts rows that are equal in all others
    order = [F.asc_nulls_first("key"), F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("changed"), F.asc("tie")]
    placed = kept(numbered(hashed.withColumn("tie", F.monotonically_increasing_id()), ["key"], order))
    keys = kept(placed.groupBy("key").agg(F.count(F.lit(1)).alias("leaves")).withColumn("all", F.lit(0)))
    trees = kept(numbered(keys, ["all"], [F.asc("all"), F.asc_nulls_first("key")]).withColumnRenamed("number", "tree"))
    sizes = small_side(trees.select("tree", "leaves"))
    of_key = small_side(trees.select(F.col("key").alias("_key"), "tree"))
    leaves = placed.join(of_key, F.col("key").eqNullSafe(F.col("_key"))).select("tree", "number", "key", "doc_id", "leaf", "changed")
    log = append_log(leaves.withColumnRenamed("leaf", "digest"), sizes, span)
    subroots = kept(roots(log, sizes))
    heads = subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("number"), F.col("root").alias("digest"))
    head_size = kept(heads.groupBy("tree").agg(F.count(F.lit(1)).alias("leaves")))
    head_log = append_log(heads, head_size, span)
    ways = proofs(heads, head_size, head_log, span=span).select(F.col("number").alias("tree"), F.col("siblings").alias("above"))
    ways = small_side(kept(ways.join(subroots, "tree")))
    top = roots(head_log, head_size).first()
    count = head_size.first()
    found = proofs(leaves.withColumnRenamed("changed", "digest"), sizes, log, ("key", "doc_id", "leaf"), span)
    # the rest of the fold: from a tree's root up
    fold_on = _fold_on(count.leaves if count else 0)
    root = F.lit(top.root.hex() if top else None).cast("string")
    hexed = lambda name: F.lower(F.hex(name))
    return (
        found.join(ways, "tree")
        .mapInArrow(
            fold_on,
            f"doc_id {docs.schema[doc_id].dataType.simpleString()}, leaf binary, subroot binary, folded binary, key string, "
            "number bigint, siblings binary",
        )
        .select(
            "doc_id",
            hexed("leaf").alias("leaf"),
            hexed("subroot").alias("subroot"),
            root.alias("root"),
            F.sha2(hexed("siblings"), 256).alias("proof_sha256"),
            hexed("folded").alias("folded_root"),
            (hexed("folded") == root).alias("verified"),
            "key",
            "number",
            "siblings",
        )
    )


def _fold_on(trees: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Fold the roots that rows came to with the siblings above them."""
        for batch in batches:
            folded = []
            for tree, digest, above in zip(*(batch.column(x).to_pylist() for x in ("tree", "folded", "above")), strict=True):
                at = 0
                for level in range(height(trees)):
                    if (tree >> level ^ 1) << level >= trees:
                        digest = node_hash(digest)
                        continue
                    sibling = above[at : at + DIGEST]
                    at += DIGEST
                    digest = node_hash(sibling, digest) if tree >> level & 1 else node_hash(digest, sibling)
                folded.append(digest)
            siblings = pa.compute.binary_join_element_wise(batch.column("siblings"), batch.column("above"), b"")
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x) for x in ("doc_id", "leaf", "root")),
                    pa.array(folded, pa.binary()),
                    *(batch.column(x) for x in ("key", "number")),
                    siblings,
                ],
                ["doc_id", "leaf", "subroot", "folded", "key", "number", "siblings"],
            )

    return fold
