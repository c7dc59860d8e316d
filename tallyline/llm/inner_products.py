"""Hard negatives by inner product, searched in a cover tree.

Integer vectors get one more coordinate that brings all candidates to the same norm; a larger inner
product with a query is then a smaller distance. A cover tree nests nets of centres: the centres
of a level are a prefix of those of the next one, each node knows how far its farthest row is
(its covering radius), and with the distance of a query from the centre that bounds the inner
products of all rows below from both sides. A node is skipped for a query when no window of wanted
scores reaches into its bounds, or when enough better ones are known.

The upper levels divide all rows into cells. The rows of a cell are dealt over blocks, and each block
has a tree of its own. A query first searches the cell nearest to it, which gives the scores to
beat, then all cells that can still hold better ones. In a block it goes down level by level and
takes the remaining leaves best first, where inner products are computed exactly. Bounds only skip
what cannot count, so the result is that of comparing with every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.tables import kept, small_side

SAMPLE = 8192
MAX_CELLS = 1024
BLOCK_ROWS, LEAF_ROWS = 2048, 64
QUERIES_AT_ONCE = 1024
ROWS_AT_ONCE = 512
ENDLESS = 1 << 57
_RANKS = 14
_EXACT = float(1 << 47)


class Nets(NamedTuple):
    """Nested nets: level k has the first `counts[k]` centres."""

    centres: np.ndarray  # row numbers of the centres
    counts: list[int]
    parents: list[np.ndarray]  # for each level, the parent of each node one level up


class Block(NamedTuple):
    """A block as it is stored: rows sorted by leaf, and its tree."""

    cuts: np.ndarray
    nets: Nets
    radii: list[np.ndarray]


def lifted(vectors: np.ndarray, norm: float) -> np.ndarray:
    """The vectors with one more coordinate, all of squared norm `norm`."""
    rest = np.sqrt(np.maximum(norm - (vectors * vectors).sum(1), 0))
    return np.hstack([vectors, rest[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0))


def nets(points: np.ndarray, most: int) -> Nets:
    """Nested nets of at most `most` centres: always the farthest point is next, levels halve the radius."""
    chosen, reach = [0], []
    near = distances(points, points[:1])[:, 0]
    while len(chosen) < most and near.max() > 0:
        reach.append(float(near.max()))
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(points, points[chosen[-1:]])[:, 0])
        near[chosen[-1]] = 0
    counts, radius = [1], (reach[0] if reach else 0.0)
    while counts[-1] < len(chosen):
        radius /= 2
        size = 1 + sum(x > radius for x in reach)
        if size > counts[-1]:
            counts.append(size)
    centres = np.array(chosen)
    parents = [np.zeros(1, np.int64)]
    for above, own in zip(counts, counts[1:], strict=False):
        up = distances(points[centres[:own]], points[centres[:above]]).argmin(1)
        up[:above] = np.arange(above)
        parents.append(up)
    return Nets(centres, counts, parents)


def radii(found: Nets, away: np.ndarray, leaf: np.ndarray) -> list[np.ndarray]:
    """Covering radius of each node of each level over rows of known leaves and distances from all centres."""
    out, at = [], leaf
    rows = np.arange(len(leaf))
    for level in range(len(found.counts) - 1, -1, -1):
        farthest = np.zeros(found.counts[level])
        np.maximum.at(farthest, at, away[rows, at])
        out.append(farthest)
        at = found.parents[level][at]
    return out[::-1]


def score_bounds(away: np.ndarray, radius: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of queries with rows within `radius` of centres.

    `total` is the sum of both squared norms.
    """
    slack = 0.25 + 1e-9 * total[:, None]  # scores are whole numbers
    low = (total[:, None] - (away + radius) ** 2) / 2 - slack
    high = (total[:, None] - np.maximum(away - radius, 0) ** 2) / 2 + slack
    return np.minimum(low, ENDLESS), np.maximum(high, -ENDLESS)  # scores beyond count as that


def reachable(found: Nets, radius: list[np.ndarray], away: np.ndarray, total: np.ndarray, floors: np.ndarray, tops: np.ndarray):
    """(queries x leaves) whether a leaf can hold a wanted score, and its greatest score: level by level."""
    alive = np.ones((len(away), 1), bool)
    for level, count in enumerate(found.counts):
        low, high = score_bounds(away[:, :count], radius[level], total)
        alive = alive[:, found.parents[level]] if level else alive
        wanted = np.zeros_like(alive)
        for j in range(floors.shape[1]):
            wanted |= (high >= floors[:, j : j + 1]) & (low <= tops[:, j : j + 1])
        alive = alive & wanted
    return alive, high


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of integral vectors: 64-bit integers where they are `exact`, else Python's."""
    if exact:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(y) for y in row] for row in x], object).reshape(x.shape) for x in (a, b)]
    return np.clip(whole[0].dot(whole[1].T), -ENDLESS, ENDLESS)


def search_block(
    block: Block,
    vectors: np.ndarray,
    norm: float,
    queries: np.ndarray,
    floors: np.ndarray,
    tops: np.ndarray,
    allowed,
    k: int,
    rank: np.ndarray,
) -> Iterator[tuple[int, int, int, int]]:
    """(query, window, row, score) of the best `k` rows of each query and window in a block.

    `floors` and `tops` (queries x windows) are the least and greatest score wanted; `allowed(queries,
    rows)` tells which pairs may count; rows of equal score are taken by their `rank`.
    """
    exact = np.abs(vectors).max(initial=0) * np.abs(queries).max(initial=0) * vectors.shape[1] < _EXACT
    kind, none = (np.int64, -(1 << 62)) if exact else (object, -(1 << 90))
    floors, tops = floors.astype(kind), tops.astype(kind)
    total = (queries * queries).sum(1) + norm
    away = distances(np.hstack([queries, np.zeros((len(queries), 1))]), lifted(vectors[block.nets.centres], norm))
    alive, high = reachable(block.nets, block.radii, away, total, floors, tops)
    best = np.full((*floors.shape, k), none, kind)
    by_rank = np.argsort(rank)
    order = np.where(alive, high, -np.inf).max(0)
    leaves = [x for x in np.argsort(-order, kind="stable").tolist() if order[x] > -np.inf]
    low = 0
    while low < len(leaves):
        taken, rows = [], []
        while low < len(leaves) and (not rows or sum(map(len, rows)) < ROWS_AT_ONCE):
            taken.append(leaves[low])
            rows.append(np.arange(block.cuts[leaves[low]], block.cuts[leaves[low] + 1]))
            low += 1
        chosen = np.concatenate(rows)
        # scores found meanwhile may rule out what the first look let through
        wanted = (high[:, taken, None] >= floors[:, None, :]).any(2) & alive[:, taken]
        asking = np.flatnonzero(wanted.any(1))
        if not len(asking) or not len(chosen):
            continue
        score = products(queries[asking], vectors[chosen], exact)
        may = allowed(asking, chosen)
        key = score * (1 << _RANKS) + ((1 << _RANKS) - 1 - rank[chosen])
        for j in range(floors.shape[1]):
            good = may & (score >= floors[asking, j, None]) & (score <= tops[asking, j, None])
            if good.any():
                merged = np.hstack([best[asking, j], np.where(good, key, none).astype(kind)])
                merged = -np.sort(-merged, axis=1)[:, :k]
                best[asking, j] = merged
                full = merged[:, -1] > none
                floors[asking[full], j] = np.maximum(floors[asking[full], j], merged[full, -1] // (1 << _RANKS))
    for q, j, n in zip(*np.nonzero(best > none), strict=True):
        key = int(best[q, j, n])
        yield int(q), int(j), int(by_rank[(1 << _RANKS) - 1 - (key & ((1 << _RANKS) - 1))]), key >> _RANKS


def _quantise(scale: float):
    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that take part, with whole-numbered components and the squared norm."""
        for batch in batches:
            good, bodies, dims, norms = [], [], [], []
            for k, values in enumerate(batch.column("vector").to_pylist()):
                if not values or None in values:
                    continue
                body = np.array(values, np.float64)
                if np.isfinite(body).all():
                    body = np.floor(body * scale) + 0.0
                    if not np.isfinite(body).all():
                        continue
                    good.append(k)
                    bodies.append(body.tobytes())
                    dims.append(len(body))
                    norms.append(float(body @ body))
            at = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x).take(at) for x in ("rid", "vec_id", "label", "anchor")),
                    pa.array(bodies, pa.binary()),
                    pa.array(dims, pa.int32()),
                    pa.array(norms, pa.float64()),
                ],
                ["rid", "vec_id", "label", "anchor", "vector", "dim", "norm"],
            )

    return quantise


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _assign(shared):
    """The cell of each row, and on the first row of a batch how far the batch's rows are from the nodes above them."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                found, centres, norm = shared.value[int(dim)]
                away = distances(lifted(_matrix(part.column("vector"), int(dim)), norm), centres)
                cell = away.argmin(1)
                far = np.concatenate(radii(found, away, cell))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(x) for x in ("rid", "vec_id", "label", "anchor", "vector", "dim")),
                        pa.array(cell.astype(np.int32)),
                        pa.array([far.tobytes()] + [None] * (len(part) - 1), pa.binary()),
                    ],
                    ["rid", "vec_id", "label", "anchor", "vector", "dim", "cell", "far"],
                )

    return assign


def _widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The covering radii over all rows of a task."""
    most: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, far in zip(batch.column("dim").to_pylist(), batch.column("far").to_pylist(), strict=True):
            own = np.frombuffer(far, np.float64)
            most[dim] = np.maximum(most[dim], own) if dim in most else own
    if most:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(most), pa.int32()), pa.array([x.tobytes() for x in most.values()], pa.binary())], ["dim", "far"]
        )


def _pack(shared, kind: pa.DataType, leaf_rows: int):
    """One row for the rows of a block: sorted by id within leaves, with the block's tree."""

    def pack(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        _, _, norm = shared.value[dim]
        table = table.sort_by([("rid", "ascending")])
        points = lifted(_matrix(table.column("vector"), dim), norm)
        found = nets(points, -(-len(points) // leaf_rows))
        away = distances(points, points[found.centres])
        leaf = away.argmin(1)
        order = np.argsort(leaf, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        table = table.take(pa.array(order))
        small = lambda x: np.asarray(x, np.int32).tobytes()
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "cell": table.column("cell").combine_chunks()[:1],
                "block": table.column("block").combine_chunks()[:1],
                "rids": pa.array([table.column("rid").to_pylist()], pa.list_(pa.int64())),
                "vec_ids": pa.array([table.column("vec_id").to_pylist()], pa.list_(kind)),
                "labels": pa.array([table.column("label").to_pylist()], pa.list_(pa.string())),
                "vectors": pa.array([b"".join(table.column("vector").to_pylist())], pa.binary()),
                "cuts": pa.array([small(np.searchsorted(leaf[order], np.arange(len(found.centres) + 1)))], pa.binary()),
                "centres": pa.array([small(place[found.centres])], pa.binary()),
                "counts": pa.array([small(found.counts)], pa.binary()),
                "parents": pa.array([small(np.concatenate(found.parents))], pa.binary()),
                "radii": pa.array([np.concatenate(radii(found, away, leaf)).tobytes()], pa.binary()),
            }
        )

    return pack


def _cut(flat: np.ndarray, counts: list[int]) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(counts)[:-1])


def _visits(shared, first: bool):
    """The cells a query goes to: the one nearest to it, or all others that can hold a wanted score."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                found, centres, norm, far = shared.value[int(dim)]
                q = _matrix(part.column("vector"), int(dim))
                away = distances(np.hstack([q, np.zeros((len(q), 1))]), centres)
                home = away.argmin(1)
                if first:
                    cells = [[x] for x in home.tolist()]
                else:
                    floors, tops = _windows(part)
                    total = (q * q).sum(1) + norm
                    alive, _ = reachable(found, far, away, total, floors, tops)
                    alive[np.arange(len(q)), home] = False
                    cells = [np.flatnonzero(x).tolist() for x in alive]
                columns = [part.column(x) for x in part.schema.names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cells, pa.list_(pa.int32()))], [*part.schema.names, "cells"])

    return visit


def _windows(table) -> tuple[np.ndarray, np.ndarray]:
    floors = np.array(table.column("floors").to_pylist(), np.int64)
    return floors, np.array(table.column("tops").to_pylist(), np.int64)


def _search(shared, same: bool, k: int, kind: pa.DataType):
    def search(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(queries) and len(blocks):
            dim = blocks.column("dim")[0].as_py()
            norm = shared.value[dim][2]
            row = {x: blocks.column(x)[0].as_py() for x in blocks.column_names}
            ints = lambda x: np.frombuffer(row[x], np.int32)
            counts = ints("counts").tolist()
            tree = Nets(ints("centres"), counts, _cut(ints("parents"), counts))
            block = Block(ints("cuts"), tree, _cut(np.frombuffer(row["radii"]), counts))
            vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
            codes = {x: n for n, x in enumerate(dict.fromkeys(row["labels"]))}
            labels = np.array([codes[x] for x in row["labels"]])
            rids = np.array(row["rids"])
            # equal scores are taken by id
            names = row["vec_ids"]
            order = np.array(sorted(range(len(names)), key=lambda n: (names[n] is not None, *([names[n]] if names[n] is not None else ()), row["rids"][n])))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            own_label = np.array([codes.get(x, -1) for x in queries.column("label").to_pylist()])
            own_rid = queries.column("rid").to_numpy()
            floors, tops = _windows(queries)

            def allowed(asking: np.ndarray, chosen: np.ndarray) -> np.ndarray:
                equal = own_label[asking][:, None] == labels[chosen]
                return (equal if same else ~equal) & (own_rid[asking][:, None] != rids[chosen])

            q = _matrix(queries.column("vector"), dim)
            for a, j, n, score in search_block(block, vectors, norm, q, floors, tops, allowed, k, rank):
                found.append((int(own_rid[a]), j, names[n], int(rids[n]), score))
        columns = list(zip(*found, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.int32(), kind, pa.int64(), pa.int64()]
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["rid", "j", "vec_id", "other", "score"])

    return search


def _index(rows: DataFrame, kind: str, block_rows: int, leaf_rows: int) -> tuple:
    """Blocks with their trees, the upper tree (broadcast), and the number of blocks of each cell."""
    spark = rows.sparkSession
    dims = rows.groupBy("dim").agg(F.max("norm").alias("norm"), F.count(F.lit(1)).alias("rows")).collect()
    total = sum(x.rows for x in dims)
    share = F.pmod(F.xxhash64("rid"), F.lit(1 << 20)) / (1 << 20)
    sample: dict[int, list[bytes]] = {}
    for row in rows.filter(share < min(1.0, SAMPLE / max(1, total))).select("dim", "vector").toLocalIterator():
        sample.setdefault(row.dim, []).append(bytes(row.vector))
    model = {}
    for x in dims:
        own = np.frombuffer(b"".join(sample.get(x.dim, [])), np.float64).reshape(-1, x.dim)
        points = lifted(own if len(own) else np.zeros((1, x.dim)), x.norm)
        found = nets(points, min(MAX_CELLS, -(-x.rows // block_rows)))
        model[x.dim] = found, points[found.centres], x.norm
    shared = spark.sparkContext.broadcast(model)
    names = f"rid bigint, vec_id {kind}, label string, anchor boolean, vector binary, dim int"
    placed = kept(rows.drop("norm").mapInArrow(_assign(shared), f"{names}, cell int, far binary"))
    widest = placed.filter("far is not null").select("dim", "far").mapInArrow(_widest, "dim int, far binary")
    far: dict[int, np.ndarray] = {}
    for row in widest.toLocalIterator():
        own = np.frombuffer(row.far, np.float64)
        far[row.dim] = np.maximum(far[row.dim], own) if row.dim in far else own
    upper = spark.sparkContext.broadcast({d: (*x, _cut(far[d], x[0].counts)) for d, x in model.items()})
    sizes = placed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    sizes = small_side(kept(sizes))
    block = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int").alias("block")
    dealt = placed.join(sizes, ["dim", "cell"]).select("rid", "vec_id", "label", "vector", "dim", "cell", block)
    arrow = _arrow_kind(placed, "vec_id")
    blocks = kept(
        dealt.groupBy("dim", "cell", "block").applyInArrow(
            _pack(shared, arrow, leaf_rows),
            f"dim int, cell int, block int, rids array<bigint>, vec_ids array<{kind}>, labels array<string>, vectors binary, "
            "cuts binary, centres binary, counts binary, parents binary, radii binary",
        )
    )
    return placed, blocks, shared, upper, sizes


def _arrow_kind(df: DataFrame, name: str) -> pa.DataType:
    return df.select(name).limit(0).toArrow().schema.field(0).type


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first `k` rows of each query and window."""
    order = Window.partitionBy("rid", "j").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(queries: DataFrame, index: tuple, same: bool, k: int, kind: str) -> DataFrame:
    """The best `k` rows for each query (rid, label, vector, dim) and window (floors, tops): rid, j, vec_id, other, score, rank."""
    _, blocks, shared, upper, sizes = index
    arrow = _arrow_kind(index[0], "vec_id")
    columns = ["rid", "label", "vector", "dim", "floors", "tops"]
    names = "rid bigint, label string, vector binary, dim int, floors array<bigint>, tops array<bigint>"

    def round_of(asking: DataFrame, first: bool) -> DataFrame:
        went = asking.select(*columns).mapInArrow(_visits(upper, first), f"{names}, cells array<int>")
        went = kept(went.withColumn("cell", F.explode("cells")).drop("cells"))
        calls = went.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES_AT_ONCE).cast("int").alias("packs"))
        plan = small_side(kept(sizes.join(calls, ["dim", "cell"])))
        every = lambda x: F.explode(F.sequence(F.lit(0), F.col(x) - 1))
        visiting = (
            went.join(plan, ["dim", "cell"])
            .withColumn("pack", F.pmod(F.xxhash64("rid"), F.col("packs")).cast("int"))
            .withColumn("block", every("blocks"))
            .select(*columns, "cell", "block", "pack")
        )
        visited = blocks.join(plan, ["dim", "cell"]).withColumn("pack", every("packs")).drop("packs", "blocks")
        place = ["dim", "cell", "block", "pack"]
        tiles = visiting.groupBy(*place).cogroup(visited.groupBy(*place))
        found = tiles.applyInArrow(
            _search(shared, same, k, arrow), f"rid bigint, j int, vec_id {kind}, other bigint, score bigint"
        )
        return kept(_best(found, k).drop("rank"))

    near = round_of(queries, True)
    # a window with enough rows wants nothing below the last of them
    enough = near.groupBy("rid", "j").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    known = enough.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("j", "score"))).alias("known"))
    raised = F.transform("floors", lambda x, j: F.greatest(x, F.coalesce(F.try_element_at("known", j), x)))
    rest = queries.join(known, "rid", "left").withColumn("floors", raised)
    return _best(near.unionByName(round_of(rest, False)), k)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become whole numbers, floor(scale * x); a score is the inner product with the
    anchor, higher ones first, ties by smaller `vec_id` (null first). Rows that fulfil `anchor`
    are anchors. Their positives are the first `positives` other rows of their label; for each
    of them the first `negatives` rows of other labels follow whose score is from `least` to
    `most` percent of the positive's.

    Rows with a null label, a null or empty vector, or a null or non-finite component (also
    after scaling) take no part; vectors of different lengths have no score. Repeated rows are
    other rows, and anchors each. A null `vec_id` is an id like any other. Anchors without
    positives and positives without negatives give no rows, an empty table gives an empty
    result; other columns are not used. Scores beyond 2^57 count as that.

    The upper tree is fitted on about `SAMPLE` rows chosen by hash; every row is in the index and
    the result is exact. Driver and broadcast hold `MAX_CELLS` centres for each vector length, a
    task one block and `QUERIES_AT_ONCE` anchors or so.
    """
    kind = rows.schema[vec_id].dataType.simpleString()
    chosen = rows.select(
        F.col(vec_id).alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).filter("label is not null")
    numbered = chosen.withColumn("rid", F.monotonically_increasing_id())
    usable = kept(
        numbered.mapInArrow(
            _quantise(float(scale)),
            f"rid bigint, vec_id {kind}, label string, anchor boolean, vector binary, dim int, norm double",
        )
    )
    index = _index(usable, kind, block_rows, leaf_rows)
    anchors = kept(index[0].filter("anchor").select("rid", "vec_id", "label", "vector", "dim"))
    bounds = lambda x: F.array(F.lit(x).cast("bigint"))
    asking = anchors.drop("vec_id").withColumns({"floors": bounds(-ENDLESS), "tops": bounds(ENDLESS)})
    near = search(asking, index, True, positives, kind)
    near = kept(near.select("rid", (F.col("rank") - 1).alias("j"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    scores = near.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("j", "positive_score"))).alias("scores"))
    share = lambda x, percent: F.floor(x["positive_score"] * percent / F.lit(100).cast("decimal(3,0)")).cast("bigint")
    windows = {
        "floors": F.transform("scores", lambda x: -share(x, F.lit(-least).cast("decimal(3,0)"))),
        "tops": F.transform("scores", lambda x: share(x, F.lit(most).cast("decimal(3,0)"))),
    }
    wanted = kept(anchors.drop("vec_id").join(scores, "rid").withColumns(windows).drop("scores"))
    far = search(wanted, index, False, negatives, kind)
    named = near.join(anchors.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
    return named.join(far, ["rid", "j"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
