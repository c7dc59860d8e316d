import numpy as np
import pytest

from tallyline.llm import vector_dedup
from tallyline.llm.vector_dedup import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, sig string, list int, rows string"


def cloud(seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for centre in rng.normal(size=(25, 12)):
        for _ in range(rng.integers(1, 9)):
            rows.append((centre + rng.normal(size=12) * rng.choice([0.05, 0.2, 0.3])).astype(np.float32).tolist())
    rows += rows[:3] + rows[:1]
    out = [(k, v, int(k % 2)) for k, v in enumerate(rows)]
    odd = [None, [], [0.0] * 12, [float("nan")] + [1.0] * 11, [None] + [1.0] * 11, [float("inf")] + [1.0] * 11, [1.0, 2.0]]
    out += [(1000 + k, v, 0) for k, v in enumerate(odd)]
    out += [(2000, rows[0], None), (None, rows[0], 0), (2001, rows[0], 0), (2001, rows[0], 0), (2001, rows[9], 0)]
    return out


def plain(rows, least):
    def usable(v, label):
        return label is not None and v and None not in v and np.isfinite(v).all() and any(v)

    up, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (_, v, l) in enumerate(rows):
        for b in range(a):
            _, w, m = rows[b]
            if l == m and usable(v, l) and usable(w, m) and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    up[root(a)] = root(b)
    heads = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            heads[root(k)] = min(i, heads.get(root(k), i))
    return sorted(((i, links[k], heads.get(root(k)), i == heads.get(root(k))) for k, (i, _, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("blocks", [(1024, 4096), (2, 3)])
def test_against_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(vector_dedup, "MEMBERS", blocks[0])
    monkeypatch.setattr(vector_dedup, "PROBES", blocks[1])
    rows = cloud()
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    got = near_vectors(frame).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, 0.93)


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_table_distances_are_distances_to_coded_vectors():
    rng = np.random.default_rng(9)
    vectors = vector_dedup.unit(rng.normal(size=(300, 10)))
    coarse, books = vector_dedup.train(vectors, 4)
    own = vector_dedup._squares(vectors, coarse).argmin(1)
    codes, error = vector_dedup.encode(vectors - coarse[own], books)
    for c in range(4):
        mine = own == c
        coded = coarse[c] + np.hstack([b[codes[mine][:, m]] for m, b in enumerate(books)])
        assert np.allclose(np.sqrt(((vectors[mine] - coded) ** 2).sum(1)), error[mine], atol=1e-6)
        wanted = np.sqrt(((vectors[:20, None] - coded[None]) ** 2).sum(2))
        assert np.allclose(vector_dedup.table_distances(vectors[:20], coarse[c], codes[mine], books), wanted, atol=1e-3)
