"""Near-duplicate vectors of equal label by product quantisation.

Coarse centroids divide the unit vectors into inverted lists; what is left after subtracting
the centroid is coded in subspaces. A query visits every list that can hold a vector within
the wanted distance: a vector of list c lies on c's side of the plane between c and the query's
own centroid, which bounds the query's distance from that plane. In a list, distances to the
coded vectors come from lookup tables of the query; a coded vector is off by its known coding
error, so queries within the wanted distance plus that error are all that can link. Their
cosines are then computed in double precision. Both bounds are exact, so no link is lost.

Equal vectors of a label are one class and take part once.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.components import connected_components
from tallyline.llm.tables import kept, small_side

SAMPLE = 20_000
MAX_LISTS = 1024
SUBSPACE = 4
CODEWORDS = 256
MEMBERS, PROBES = 1024, 4096
SLACK = 1e-5


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, sig, vector): the last two are null for vectors that link with nothing."""
    for batch in batches:
        sigs, vectors = [], []
        for label, values in zip(batch.column("label").to_pylist(), batch.column("vector").to_pylist(), strict=True):
            usable = label is not None and values and None not in values
            body = np.array(values, np.float64) + 0.0 if usable else np.zeros(1)
            if usable and np.isfinite(body).all() and body.any():
                sigs.append(blake2b(label.encode() + b"\0" + body.tobytes(), digest_size=16).digest())
                vectors.append(body.tobytes())
            else:
                sigs.append(None)
                vectors.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(sigs, pa.binary()), pa.array(vectors, pa.binary())],
            ["vec_id", "label", "sig", "vector"],
        )


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; rows are scaled first so that squares neither vanish nor overflow."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0)


def _means(points: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centroids by Lloyd's rounds from a fixed random start."""
    start = np.random.default_rng(7).permutation(len(points))[:count]
    found = points[start].copy()
    for _ in range(rounds):
        near = _squares(points, found).argmin(1)
        sums, counts = np.zeros_like(found), np.bincount(near, minlength=len(found))
        np.add.at(sums, near, points)
        found[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return found


def train(vectors: np.ndarray, lists: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Coarse centroids and a codebook for each subspace of the residuals."""
    points = unit(vectors)
    coarse = _means(points, min(lists, len(points)))
    left = points - coarse[_squares(points, coarse).argmin(1)]
    cuts = range(0, points.shape[1], SUBSPACE)
    return coarse, [_means(left[:, c : c + SUBSPACE], min(CODEWORDS, len(points))) for c in cuts]


def _index(shared, radius: float):
    """List, codes and coding error of each class, and the lists it must visit."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(x) // 8 for x in batch.column("vector").to_pylist()])
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                vectors = np.frombuffer(b"".join(part.column("vector").to_pylist()), np.float64).reshape(-1, dim)
                points = unit(vectors)
                coarse, books = shared.value.get(int(dim)) or (np.zeros((1, dim)), [])
                away = _squares(points, coarse)
                own = away.argmin(1)
                codes, error = encode(points - coarse[own], books)
                apart = np.sqrt(_squares(coarse, coarse))
                near = away - away[np.arange(len(own)), own][:, None] <= 2 * radius * apart[own] + SLACK
                near &= np.arange(len(coarse)) >= own[:, None]
                visits = [np.flatnonzero(x).astype(np.int32) for x in near]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(x) for x in ("sig", "label", "rows", "vector")),
                        pa.array(np.full(len(own), dim), pa.int32()),
                        pa.array(own, pa.int32()),
                        pa.array([x.tobytes() for x in codes], pa.binary()),
                        pa.array(error),
                        pa.array(visits, pa.list_(pa.int32())),
                    ],
                    ["sig", "label", "rows", "vector", "dim", "list", "codes", "error", "visits"],
                )

    return index


def encode(left: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of residuals, and how far each coded vector is from its own."""
    codes = np.zeros((len(left), len(books)), np.uint8)
    off = np.zeros(len(left)) if books else (left * left).sum(1)
    for m, book in enumerate(books):
        away = _squares(left[:, m * SUBSPACE : (m + 1) * SUBSPACE], book)
        codes[:, m] = away.argmin(1)
        off += away.min(1)
    return codes, np.sqrt(off)


def table_distances(queries: np.ndarray, centre: np.ndarray, codes: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """(queries x members) distances to the coded members of one list, by lookup tables."""
    left = queries - centre
    if not books:
        return np.repeat(np.sqrt((left * left).sum(1))[:, None], len(codes), 1)
    total = np.zeros((len(queries), len(codes)), np.float32)
    for m, book in enumerate(books):
        table = _squares(left[:, m * SUBSPACE : (m + 1) * SUBSPACE], book).astype(np.float32)
        total += table[:, codes[:, m]]
    return np.sqrt(total)


def _compare(shared, radius: float, least: float):
    """Links of one block of members with one block of visitors of the same list."""

    def compare(group: pa.Table) -> pa.Table:
        visiting = group.column("visiting").to_numpy()
        members, visitors = group.filter(pa.array(~visiting)), group.filter(pa.array(visiting))
        if not len(members) or not len(visitors):
            return _links([], [])
        dim = group.column("dim")[0].as_py()
        coarse, books = shared.value.get(dim) or (np.zeros((1, dim)), [])
        at = group.column("list")[0].as_py()
        y, x = (unit(np.frombuffer(b"".join(t.column("vector").to_pylist()), np.float64).reshape(-1, dim)) for t in (members, visitors))
        codes = np.frombuffer(b"".join(members.column("codes").to_pylist()), np.uint8).reshape(len(members), len(books))
        reach = radius + members.column("error").to_numpy() + SLACK
        y_sig, x_sig = members.column("sig").to_pylist(), visitors.column("sig").to_pylist()
        y_rows, x_rows = members.column("rows").to_numpy(), visitors.column("rows").to_numpy()
        y_name, x_name = np.array(y_sig, "V16"), np.array(x_sig, "V16")
        home = visitors.column("home").to_numpy() == at
        x_count, y_count = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        part = np.arange(len(y))
        edges: list[tuple[bytes, bytes]] = []
        for low in range(0, len(x), 256):
            close = table_distances(x[low : low + 256], coarse[at], codes, books) <= reach
            q, k = np.nonzero(close)
            q += low
            # within the list each pair once; a vector is not its own neighbour
            once = ~home[q] | (x_name[q].view("S16") < y_name[k].view("S16")) if len(q) else np.zeros(0, bool)
            q, k = q[once], k[once]
            good = np.einsum("ij,ij->i", x[q], y[k]) >= least
            q, k = q[good], k[good]
            np.add.at(x_count, q, y_rows[k])
            np.add.at(y_count, k, x_rows[q])
            starts = np.flatnonzero(np.diff(q, prepend=-1))
            for a, mine in zip(q[starts], np.split(k, starts[1:]) if len(k) else (), strict=True):
                # one edge to each part that the members are in so far, which then are one part
                parts, first = np.unique(part[mine], return_index=True)
                edges += [(x_sig[a], y_sig[b]) for b in mine[first]]
                if len(parts) > 1:
                    part[np.isin(part, parts)] = parts[0]
        counts = [(x_sig[a], int(x_count[a])) for a in np.flatnonzero(x_count)]
        counts += [(y_sig[b], int(y_count[b])) for b in np.flatnonzero(y_count)]
        return _links(counts, edges)

    return compare


def _links(counts: list[tuple[bytes, int]], edges: list[tuple[bytes, bytes]]) -> pa.Table:
    return pa.table(
        {
            "sig": pa.array([x for x, _ in counts] + [x for x, _ in edges], pa.binary()),
            "other": pa.array([None] * len(counts) + [x for _, x in edges], pa.binary()),
            "n": pa.array([x for _, x in counts] + [0] * len(edges), pa.int64()),
        }
    )


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.93
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of equal label are linked when their cosine is at least `cosine`. `n_links` counts
    the other rows linked directly, `component_id` is the smallest vec_id reachable, and `kept`
    marks the rows whose vec_id it is.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and those without a
    label, link with nothing; vectors of different lengths do not link. Repeated rows are other
    vectors and link with each other. A null vec_id never names a component of others. An empty
    table gives an empty result; other columns are not used.

    Centroids and codebooks are fitted on about `SAMPLE` classes chosen by hash; every class is
    indexed.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vec_id].dataType.simpleString()
    chosen = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    rows = kept(chosen.mapInArrow(_scan, f"vec_id {kind}, label string, sig binary, vector binary"))
    classes = kept(
        rows.filter("sig is not null")
        .groupBy("sig")
        .agg(F.first("label").alias("label"), F.count(F.lit(1)).alias("rows"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"))
    )
    total = classes.count()
    share = F.pmod(F.xxhash64("sig"), F.lit(1 << 20)) / (1 << 20)
    sample: dict[int, list[bytes]] = {}
    for row in classes.filter(share < min(1.0, SAMPLE / max(1, total))).select("vector").toLocalIterator():
        sample.setdefault(len(row.vector) // 8, []).append(bytes(row.vector))
    lists = int(min(MAX_LISTS, max(1, total**0.5 // 4)))
    models = {d: train(np.frombuffer(b"".join(v), np.float64).reshape(-1, d), lists) for d, v in sample.items()}
    shared = spark.sparkContext.broadcast(models)
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    indexed = kept(
        classes.drop("least").mapInArrow(
            _index(shared, radius),
            "sig binary, label string, rows bigint, vector binary, dim int, list int, codes binary, error double, visits array<int>",
        )
    )
    place = ["label", "dim", "list"]
    visits = indexed.select("sig", "label", "rows", "vector", "dim", F.col("list").alias("home"), F.explode("visits").alias("list"))
    sizes = indexed.groupBy(*place).agg(F.count(F.lit(1)).alias("members"))
    calls = visits.groupBy(*place).agg(F.count(F.lit(1)).alias("calls"))
    blocks = kept(
        sizes.join(calls, place).select(
            *place, F.ceil(F.col("members") / MEMBERS).cast("int").alias("mb"), F.ceil(F.col("calls") / PROBES).cast("int").alias("pb")
        )
    )
    blocks = small_side(blocks)
    salt = lambda n: F.pmod(F.xxhash64("sig"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = [*place, "m", "p", "sig", "rows", "vector", "codes", "error", "home", "visiting"]
    members = indexed.join(blocks, place).withColumn("m", salt("mb")).withColumn("p", every("pb"))
    members = members.withColumn("home", F.col("list")).withColumn("visiting", F.lit(False)).select(*columns)
    calling = visits.join(blocks, place).withColumn("p", salt("pb")).withColumn("m", every("mb"))
    calling = calling.withColumns({"codes": F.lit(None).cast("binary"), "error": F.lit(0.0), "visiting": F.lit(True)}).select(*columns)
    tiles = members.unionByName(calling).groupBy(*place, "m", "p")
    links = kept(tiles.applyInArrow(_compare(shared, radius, cosine), "sig binary, other binary, n bigint"))
    parts = connected_components(links.filter("other is not null"), "sig", "other")
    counts = links.groupBy("sig").agg(F.sum("n").alias("n"))
    placed = (
        classes.select("sig", "rows", "least")
        .join(parts.withColumnRenamed("node", "sig"), "sig", "left")
        .withColumn("component", F.coalesce("component", "sig"))
    )
    heads = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(heads, "component").join(counts, "sig", "left")
    linked = named.filter("rows > 1 or n > 0").select(
        "sig", (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n_links"), "component_id"
    )
    # stored first, so that the join can split the copies of one vector
    found = rows.join(kept(linked), "sig", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
