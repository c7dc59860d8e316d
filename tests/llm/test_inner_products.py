"""Hard negatives against every pair, and bounds of the tree against all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import inner_products as IP

SCHEMA = "vec_id bigint, embedding array<double>, label int, rank string, score int, rid int"
NAN, INF = float("nan"), float("inf")


def plain(rows, positives=5, negatives=10, least=30, most=90):
    used = [
        (v, [int(np.floor(256 * x)) for x in e], label)
        for v, e, label in rows
        if label is not None and e and None not in e and np.isfinite(e).all()
    ]
    out = []
    for a, (anchor, body, label) in enumerate(used):
        if anchor is None or anchor % 10:
            continue
        scored = [
            (-sum(x * y for x, y in zip(body, e, strict=True)), v is not None, v or 0, n, other)
            for n, (v, e, other) in enumerate(used)
            if n != a and len(e) == len(body)
        ]
        scored.sort()
        for p, known, name, _, _ in [x for x in scored if x[4] == label][:positives]:
            wanted = [x for x in scored if x[4] != label and least * -p <= 100 * -x[0] <= most * -p]
            for rank, x in enumerate(wanted[:negatives]):
                out.append((anchor, name if known else None, rank + 1, x[2] if x[1] else None, -p, -x[0]))
    return sorted(map(str, out))


def clustered(n, seed, spread=0.1, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    bodies = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))
    return [(k, [float(x) for x in bodies[k]], int(rng.integers(0, 3))) for k in range(n)]


EDGES = [
    (5000, None, 1), (5010, [1.0] * 8, None), (5020, [NAN] + [1.0] * 7, 1), (5030, [INF] + [1.0] * 7, 1), (5040, [], 1),
    (5050, [None] + [1.0] * 7, 1), (5060, [0.0] * 8, 1), (5070, [1.0, 2.0], 1), (5080, [1.0, 1.0], 2), (5090, [0.5, 0.5], 1),
    (None, [1.0] * 8, 2), (None, [1.0] * 8, 2), (7000, [3000.0] * 8, 1),
]


def found(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    got = IP.hard_negatives(table, F.col("vec_id") % 10 == 0, **options).collect()
    return sorted(str(tuple(r)) for r in got)


@pytest.mark.parametrize("block_rows, leaf_rows", [(40, 5), (2048, 64)])
def test_equals_every_pair(spark, block_rows, leaf_rows):
    copies = [(k, clustered(1, 3)[0][1], k % 3) for k in range(400, 460)]
    rows = clustered(300, 1) + copies + [(7, copies[0][1], 1)] * 3 + [(20, copies[0][1], 2)] * 2 + EDGES
    assert found(spark, rows, block_rows=block_rows, leaf_rows=leaf_rows) == plain(rows)


def test_very_large_components_stay_exact(spark):
    rows = [(k, [float(2.0**40 + 3 * k), float(-(2.0**20) * k)], k % 2) for k in range(40)]
    scores = [eval(x)[4:] for x in found(spark, rows, least=0, most=100)]
    assert scores and all(abs(x) <= IP.ENDLESS for pair in scores for x in pair)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_bounds_hold_and_skip_far_leaves():
    points = np.floor(256 * np.array([x for _, x, _ in clustered(600, 5, 0.05)]))
    norm = float((points * points).sum(1).max())
    lifted = IP.lifted(points, norm)
    nets = IP.nets(lifted, 60)
    assert nets.counts[0] == 1 and nets.counts[-1] == len(nets.centres) == 60
    away = IP.distances(lifted, lifted[nets.centres])
    leaf = away.argmin(1)
    radii = IP.radii(nets, away, leaf)
    queries = points[:20]
    total = (queries * queries).sum(1) + norm
    distance = IP.distances(np.hstack([queries, np.zeros((20, 1))]), lifted[nets.centres])
    low, high = IP.score_bounds(distance, radii[-1], total)
    scores = queries @ points.T
    assert (scores <= high[:, leaf]).all() and (scores >= low[:, leaf]).all()
    best = np.sort(scores, 1)[:, -5:-4].astype(np.int64)
    alive, _ = IP.reachable(nets, radii, distance, total, best, np.full_like(best, IP.ENDLESS))
    assert (~alive).sum() > alive.sum()  # most leaves are skipped
    assert all(alive[q, leaf[n]] for q, n in zip(*np.nonzero(scores >= best), strict=True))
