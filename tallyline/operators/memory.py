"""Memory recall: the best records of an actor's namespaces for each query vector.

A namespace of more records than a block holds gets a metric index. Some of its records are
pivots; every record belongs to the block of the nearest pivot by angle, and a block knows its
largest angle. No record of a block is nearer to a query than the angle to its pivot less that
radius, so a query leaves out blocks that cannot reach the threshold or the score of rank `k` in
its best block.

Blocks are as fine as the index wants them, but vectors travel by shelves: blocks of near pivots,
with as many records as a task holds at once. A query is sent once to each shelf that has a block
for it, a shelf once to each pack of its queries, and blocks are left out on the shelf.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.compute import stored

# The three namespaces of an actor and the recall settings.
NAMESPACES = ["/facts/{actor}", "/preferences/{actor}", "/summaries/{actor}/{session}"]
TOP_K = 3
THRESHOLD = 0.5

BLOCK_ROWS = 20_000
# A shelf of records or a pack of queries has about this many vector elements.
SHELF_VALUES = 4_000_000
SCORE_PLACES = 6
SCORES_AT_ONCE = 4_000_000
MAX_PIVOTS = 1024
_SPACE = ["namespace", "_length"]
# Angles of nearly equal vectors are uncertain by the root of the precision; scores are rounded.
_ANGLE_SLACK, _SCORE_SLACK = 1e-7, 1e-6


def actor_namespaces(queries: DataFrame) -> DataFrame:
    """Each query (query_id, actor_id, session_id, embedding) once per namespace it may read."""
    def filled(pattern: str) -> Column:
        text = F.replace(F.lit(pattern), F.lit("{actor}"), F.col("actor_id"))
        return F.replace(text, F.lit("{session}"), F.col("session_id"))

    return queries.select(
        "query_id", "embedding", F.explode(F.array(*[filled(p) for p in NAMESPACES])).alias("namespace")
    )


def topk_per_namespace(scored: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first `k` rows of each key in the given order, with their `rank`."""
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(
        F.col("rank") <= k
    )


def memory_recall(
    queries: DataFrame,
    records: DataFrame,
    k: int = TOP_K,
    threshold: float = THRESHOLD,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Top `k` records per query and namespace of the actor with cosine >= `threshold`."""
    return recall_in_namespace(actor_namespaces(queries), records, k, threshold, block_rows)


def recall_in_namespace(
    queries: DataFrame,
    records: DataFrame,
    k: int = TOP_K,
    threshold: float = THRESHOLD,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact top `k` records (namespace, record_id, embedding) per query (query_id,
    namespace, embedding), by cosine rounded to six places and then record id.

    Each shelf of records meets its queries in matrix products, which keep only the best
    `k` per query, so no pair of rows is ever a row. Namespaces of more than `block_rows`
    records are searched through an index of blocks. Vectors meet vectors of their own length
    only; empty ones and those with a NULL element take no part.
    """
    # Records nobody asks for stay out of the shuffle; the asked namespaces are usually few.
    records = _usable(records.join(queries.select("namespace").distinct(), "namespace", "left_semi"))
    asking = _usable(queries).withColumn("_floor", F.lit(threshold).cast("double"))
    sizes = records.groupBy(*_SPACE).agg(F.count(F.lit(1)).alias("_rows"))
    large = stored(sizes.filter(F.col("_rows") > block_rows))

    def best(asking: DataFrame, shelves: DataFrame, near: bool = False) -> DataFrame:
        return _searched(asking, shelves, k, threshold, block_rows, near)

    if large.isEmpty():
        return _ranked(best(_first_shelf(asking), _plain_shelf(records)), k)
    index = block_index(records, large, block_rows)
    shelves = index.shelves.unionByName(_plain_shelf(records.join(large, _SPACE, "left_anti")))
    if index.wide.isEmpty():
        return _ranked(best(_first_shelf(asking), shelves), k)
    narrow = best(_first_shelf(asking.join(index.wide, _SPACE, "left_anti")), shelves.join(index.wide, _SPACE, "left_anti"))
    asking = asking.join(index.wide, _SPACE, "left_semi")
    spread = index.shelves.join(index.wide, _SPACE, "left_semi")
    first = best(_to_shelves(asking, index, home=True), spread, near=True)
    # a query with k records by now wants nothing below the last of them
    known = first.groupBy("query_id", "namespace").agg(F.min("score").alias("_kth"), F.count(F.lit(1)).alias("_n"))
    known = known.filter(F.col("_n") >= k).select("query_id", "namespace", "_kth")
    rest = asking.join(known, ["query_id", "namespace"], "left").withColumn("_floor", F.greatest("_floor", "_kth"))
    found = best(_to_shelves(rest.drop("_kth"), index, home=False), spread)
    return _ranked(narrow.unionByName(found), k)


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    return topk_per_namespace(scored, ["query_id", "namespace"], [F.desc("score"), F.asc("record_id")], k)


def _usable(df: DataFrame) -> DataFrame:
    usable = "embedding IS NOT NULL AND size(embedding) > 0 AND NOT exists(embedding, x -> x IS NULL)"
    return df.filter(usable).withColumn("_length", F.size("embedding"))


def _first_shelf(df: DataFrame) -> DataFrame:
    return df.withColumn("_shelf", F.lit(0))


def _plain_shelf(records: DataFrame) -> DataFrame:
    """All records of a namespace as one shelf without an index."""
    none = F.lit(None)
    return _first_shelf(records).select(
        *_SPACE, "_shelf", none.cast("int").alias("_pivot"), none.cast("double").alias("_radius"), "record_id", "embedding"
    )


def _to_shelves(asking: DataFrame, index: BlockIndex, home: bool) -> DataFrame:
    """Queries once for each shelf with a block they must look into."""
    went = stored(block_visits(asking, index, home).select(*_SPACE, "query_id", "embedding", "_floor", "_shelves"))
    return went.withColumn("_shelf", F.explode("_shelves"))


def _shelf_rows(block_rows: int) -> Column:
    return F.greatest(F.lit(block_rows), F.lit(SHELF_VALUES) / F.col("_length"))


def _searched(
    asking: DataFrame, shelves: DataFrame, k: int, threshold: float, block_rows: int, near: bool = False
) -> DataFrame:
    """The best `k` of each shelf for the queries (with `_shelf`) that look into it; with `near`
    only of their best blocks there. The queries of a shelf are dealt over packs."""
    keys = [*_SPACE, "_shelf", "_pack"]
    asked = asking.groupBy(*_SPACE, "_shelf").agg(F.count(F.lit(1)).alias("_asked"))
    packs = asked.withColumn("_packs", F.ceil(F.col("_asked") / _shelf_rows(block_rows)).cast("int")).drop("_asked")
    several = packs.filter("_packs > 1").select(*_renamed(*_SPACE, "_shelf", "_packs"))
    pack = F.pmod(F.xxhash64("query_id"), F.coalesce("_packs", F.lit(1))).cast("int")
    dealt = asking.join(several, [*_SPACE, "_shelf"], "left").withColumn("_pack", pack)
    # a shelf is repeated only for the packs that ask for it
    calls = packs.withColumn("_pack", F.explode(F.sequence(F.lit(0), F.col("_packs") - 1))).drop("_packs")
    answering = shelves.join(calls.select(*_renamed(*keys)), [*_SPACE, "_shelf"])
    types = dict(asking.dtypes) | dict(shelves.dtypes)

    def best(queries: pa.Table, rows: pa.Table) -> pa.Table:
        return _best_on_shelf(queries, rows, k, threshold, near)

    return (
        dealt.select(*keys, "query_id", "embedding", "_floor")
        .groupBy(*keys)
        .cogroup(answering.select(*_renamed(*keys, "_pivot", "_radius", "record_id", "embedding")).groupBy(*keys))
        .applyInArrow(
            best,
            f"namespace string, query_id {types['query_id']}, record_id {types['record_id']}, score double",
        )
    )


def _renamed(*names: str) -> list[Column]:
    """Columns told apart from those of a table they come from, which the other side may share."""
    return [F.col(x).alias(x) for x in names]


class BlockIndex(NamedTuple):
    """Large namespaces: their records with `_shelf` and `_pivot`, and a row for each block on a shelf
    with its `_radius` and its pivot as embedding; per namespace all pivots and blocks; the
    namespaces of several shelves."""

    shelves: DataFrame
    pivots: DataFrame
    wide: DataFrame


def block_index(records: DataFrame, large: DataFrame, block_rows: int = BLOCK_ROWS) -> BlockIndex:
    """The index of the namespaces in `large` (namespace, _length, _rows).

    Pivots are the records of least hash, one for each `block_rows` records and at most
    `MAX_PIVOTS`; a block of more records than a shelf holds is dealt over several.
    """
    count = F.least(F.lit(MAX_PIVOTS), F.ceil(F.col("_rows") / block_rows)).cast("int")
    mine = records.join(large.withColumn("_count", count), _SPACE)
    by_hash = Window.partitionBy(*_SPACE).orderBy(F.xxhash64("record_id"), "record_id", "embedding")
    chosen = mine.withColumn("_n", F.row_number().over(by_hash)).filter(F.col("_n") <= MAX_PIVOTS).filter("_n <= _count")
    chosen = stored(chosen.select(*_SPACE, (F.col("_n") - 1).alias("_pivot"), "embedding"))
    pivots = chosen.groupBy(*_SPACE).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pivot", "embedding"))), lambda x: x["embedding"]).alias("_pivots")
    )
    salts = F.ceil(F.col("_rows") / _shelf_rows(block_rows)).cast("int")
    dealt = mine.withColumn("_salt", F.pmod(F.xxhash64("record_id"), salts).cast("int"))
    repeated = pivots.join(large, _SPACE).withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    kind = dict(records.dtypes)["record_id"]
    vector = dict(records.dtypes)["embedding"]
    placed = stored(
        dealt.select(*_SPACE, "_salt", "record_id", "embedding")
        .groupBy(*_SPACE, "_salt")
        .cogroup(repeated.select(*_renamed(*_SPACE, "_salt", "_pivots")).groupBy(*_SPACE, "_salt"))
        .applyInArrow(
            _nearest_pivot,
            f"namespace string, _length int, record_id {kind}, embedding {vector}, _pivot int, _angle double",
        )
    )
    sized = placed.groupBy(*_SPACE, "_pivot").agg(F.max("_angle").alias("_radius"), F.count(F.lit(1)).alias("_rows"))
    on_pivots = sized.join(chosen.select(*_renamed(*_SPACE, "_pivot", "embedding")), [*_SPACE, "_pivot"])
    blocks = stored(
        on_pivots.select(*_SPACE, "_pivot", "embedding", "_radius", "_rows", _shelf_rows(block_rows).alias("_shelf_rows"))
        .groupBy(*_SPACE)
        .applyInArrow(
            _shelved, f"namespace string, _length int, _pivot int, embedding {vector}, _radius double, _shelf int, _parts int"
        )
    )
    known = blocks.groupBy(*_SPACE).agg(
        F.collect_list(F.struct("_pivot", "_radius", "_shelf", "_parts")).alias("_blocks"),
        F.max(F.col("_shelf") + F.col("_parts")).alias("_shelves"),
    )
    part = F.pmod(F.xxhash64("record_id"), F.col("_parts")).cast("int")
    members = (
        placed.join(blocks.select(*_renamed(*_SPACE, "_pivot", "_shelf", "_parts")), [*_SPACE, "_pivot"])
        .withColumn("_shelf", F.col("_shelf") + part)
        .withColumn("_radius", F.lit(None).cast("double"))
    )
    heads = blocks.withColumn("_shelf", F.explode(F.sequence(F.col("_shelf"), F.col("_shelf") + F.col("_parts") - 1)))
    columns = [*_SPACE, "_shelf", "_pivot", "_radius", "record_id", "embedding"]
    shelves = members.select(*columns).unionByName(heads.withColumn("record_id", F.lit(None).cast(kind)).select(*columns))
    wide = known.filter("_shelves > 1").select(*_SPACE)
    return BlockIndex(shelves, pivots.join(known.drop("_shelves"), _SPACE), wide)


def _shelved(blocks: pa.Table) -> pa.Table:
    """The blocks of a namespace with the first of their `_parts` shelves, near pivots together.

    Blocks go by the nearest of as many pivots as there are shelves, and each begins on the shelf
    up to which the rows of those before it reach.
    """
    blocks = blocks.sort_by("_pivot")
    rows, most = blocks["_rows"].to_numpy(), blocks["_shelf_rows"][0].as_py()
    pivots = _unit_rows(blocks["embedding"])
    around = _angles(pivots, pivots[: max(1, int(np.ceil(rows.sum() / most)))]).argmin(1)
    order = np.argsort(around, kind="stable")
    begins = np.empty(len(rows), np.int64)
    begins[order] = np.cumsum(rows[order]) - rows[order]
    own = blocks.select(["namespace", "_length", "_pivot", "embedding", "_radius"])
    return own.append_column("_shelf", pa.array((begins // most).astype(np.int32))).append_column(
        "_parts", pa.array(np.ceil(rows / most).astype(np.int32))
    )


def _pivot_matrix(table: pa.Table) -> np.ndarray:
    return _unit_rows(pa.chunked_array([table["_pivots"].combine_chunks().flatten()]))


def _angles(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ pivots.T, -1, 1))


def _bounds(rows: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """What no score of a row with a record of the blocks can exceed."""
    return np.cos(np.maximum(_angles(rows, pivots) - radius - _ANGLE_SLACK, 0)) + _SCORE_SLACK


def _spans(rows: int, columns: int) -> list[slice]:
    """Rows in runs of at most `SCORES_AT_ONCE` products with so many columns."""
    step = max(1, SCORES_AT_ONCE // max(1, columns))
    return [slice(at, at + step) for at in range(0, rows, step)]


def _nearest_pivot(records: pa.Table, pivots: pa.Table) -> pa.Table:
    rows, at = _unit_rows(records["embedding"]), _pivot_matrix(pivots)
    near, angle = np.empty(len(rows), np.int32), np.empty(len(rows))
    for span in _spans(len(rows), len(at)):
        angles = _angles(rows[span], at)
        near[span] = angles.argmin(1)
        angle[span] = np.take_along_axis(angles, near[span, None], 1)[:, 0]
    own = records.select(["namespace", "_length", "record_id", "embedding"])
    return own.append_column("_pivot", pa.array(near)).append_column("_angle", pa.array(angle))


def block_visits(queries: DataFrame, index: BlockIndex, home: bool) -> DataFrame:
    """Queries (with `_floor`, the least score wanted) and the blocks they must look into: `_visits`,
    `_shelves` with these blocks, and `_known`, the number of blocks. With `home` it is the best
    block alone, else all that can reach `_floor`."""
    salts = 64
    dealt = queries.withColumn("_salt", F.pmod(F.xxhash64("query_id"), F.lit(salts)).cast("int"))
    wanted = dealt.select(*_SPACE, "_salt").distinct()
    types = dict(queries.dtypes)

    def visits(asking: pa.Table, pivots: pa.Table) -> pa.Table:
        return _visits(asking, pivots, home)

    return (
        dealt.select(*_SPACE, "_salt", "query_id", "embedding", "_floor")
        .groupBy(*_SPACE, "_salt")
        .cogroup(index.pivots.join(wanted, _SPACE).select(*_renamed(*_SPACE, "_salt", "_pivots", "_blocks")).groupBy(*_SPACE, "_salt"))
        .applyInArrow(
            visits,
            f"namespace string, _length int, query_id {types['query_id']}, embedding {types['embedding']}, _floor double, "
            "_visits array<int>, _shelves array<int>, _known int",
        )
    )


def _visits(asking: pa.Table, pivots: pa.Table, home: bool) -> pa.Table:
    own = asking.drop_columns("_salt")
    blocks = pivots["_blocks"][0].as_py() if len(asking) and len(pivots) else []
    visits: list = [] if blocks else [[]] * len(asking)
    shelves: list = [] if blocks else [[]] * len(asking)
    if blocks:
        number = np.array([b["_pivot"] for b in blocks])
        radius = np.array([b["_radius"] for b in blocks])
        holds = np.zeros((len(blocks), max(b["_shelf"] + b["_parts"] for b in blocks)), bool)
        for row, b in zip(holds, blocks, strict=True):
            row[b["_shelf"] : b["_shelf"] + b["_parts"]] = True
        rows, at, floor = _unit_rows(asking["embedding"]), _pivot_matrix(pivots)[number], asking["_floor"].to_numpy()
        for span in _spans(len(rows), len(blocks)):
            bound = _bounds(rows[span], at, radius)
            reach = ~(bound < floor[span, None])
            if home:
                reach[:] = False
                reach[np.arange(len(bound)), bound.argmax(1)] = True
            visits += [number[x] for x in reach]
            shelves += [np.flatnonzero(x) for x in reach @ holds]
    ints = pa.list_(pa.int32())
    return (
        own.append_column("_visits", pa.array(visits, ints))
        .append_column("_shelves", pa.array(shelves, ints))
        .append_column("_known", pa.array([len(blocks)] * len(asking), pa.int32()))
    )


def _unit_rows(vectors: pa.ChunkedArray) -> np.ndarray:
    if not len(vectors):
        return np.empty((0, 0))
    flat = pc.list_flatten(vectors).to_numpy().astype(np.float64)
    matrix = flat.reshape(len(vectors), -1)
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def _best_on_shelf(queries: pa.Table, rows: pa.Table, k: int, threshold: float, near: bool) -> pa.Table:
    """The best `k` records of the shelf for each query, as row positions taken from Arrow.

    Queries go by their best block, whose records set the least score that the other blocks must
    be able to reach; a run of queries meets all blocks that one of them needs in one product.
    """
    q_at, r_at, score = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    heads = rows.filter(pc.is_valid(rows["_radius"])).sort_by("_pivot")
    records = rows.filter(pc.is_null(rows["_radius"]))
    if len(queries) and len(records):
        records = records.sort_by("record_id")
        q, r = _unit_rows(queries["embedding"]), _unit_rows(records["embedding"])
        spans, order, home = _spans(len(q), len(r)), np.arange(len(q)), None
        if len(heads):
            pivots, radius = _unit_rows(heads["embedding"]), heads["_radius"].to_numpy()
            block = np.searchsorted(heads["_pivot"].to_numpy(), records["_pivot"].to_numpy())
            home = np.concatenate([_bounds(q[x], pivots, radius).argmax(1) for x in _spans(len(q), len(heads))])
            order = np.argsort(home, kind="stable")
            floor = queries["_floor"].to_numpy()
        for span in spans:
            mine, columns = order[span], np.arange(len(r))
            if home is not None:
                best = np.zeros(len(heads), bool)
                best[home[mine]] = True
                columns = np.flatnonzero(best[block])
                if not near:
                    least = floor[mine]
                    if len(columns) >= k:
                        least = np.maximum(least, np.partition(_scores(q[mine], r[columns]), -k, axis=1)[:, -k])
                    needed = (~(_bounds(q[mine], pivots, radius) < least[:, None])).any(0)
                    columns = np.flatnonzero(needed[block])
            if not len(columns):
                continue
            scores = _scores(q[mine], r if len(columns) == len(r) else r[columns])
            rows_in, found_in = np.nonzero(_top_k_mask(scores, k) & (scores >= threshold))
            q_at.append(mine[rows_in])
            r_at.append(columns[found_in])
            score.append(scores[rows_in, found_in])
    asked = queries.select(["namespace", "query_id"]).take(pa.array(np.concatenate(q_at)))
    found = records["record_id"].take(pa.array(np.concatenate(r_at)))
    return asked.append_column("record_id", found).append_column("score", pa.array(np.concatenate(score)))


def _scores(queries: np.ndarray, records: np.ndarray) -> np.ndarray:
    """Rounded cosines; those of vectors that are no numbers come last."""
    scores = np.round(queries @ records.T, SCORE_PLACES)
    return np.where(np.isnan(scores), -np.inf, scores)


def _top_k_mask(scores: np.ndarray, k: int) -> np.ndarray:
    """The `k` best of each row; among equals the leftmost columns."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, dtype=bool)
    kth = np.partition(scores, -k, axis=1)[:, [-k]]
    above, equal = scores > kth, scores == kth
    room = k - above.sum(axis=1, keepdims=True)
    return above | (equal & (equal.cumsum(axis=1) <= room))
