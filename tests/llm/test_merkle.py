"""The manifest against a plain tree over lists, and places in the log against a walk."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tallyline.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
EDGES = [
    (901, None, None), (902, "", "de"), (None, "no id", "de"), (903, "é日本 🙂", ""), (904, "twice", "de"), (904, "twice", "de"),
    (904, "other", "de"), (905, "long " * 60_000, "de"), (906, "alone", "zz"), (907, "a", None),
]


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([hashed(*last[k : k + 2]) for k in range(0, len(last), 2)])
    return found


def siblings(tree, at):
    return [(level[k ^ 1] if k ^ 1 < len(level) else None, k & 1) for n, level in enumerate(tree[:-1]) for k in [at >> n]]


def folded(digest, beside):
    for other, right in beside:
        digest = hashed(digest) if other is None else hashed(other, digest) if right else hashed(digest, other)
    return digest


def plain_manifest(rows):
    def leaf(row, more=0):
        values = [row[0], "s", row[2], len(row[1] or "") + more, row[1]]
        return hashed(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    keys = sorted({r[2] for r in rows}, key=lambda k: (k is not None, (k or "").encode()))
    own = {k: sorted((r for r in rows if r[2] == k), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for k in keys}
    trees = {k: levels([leaf(r) for r in own[k]]) for k in keys}
    top = levels([trees[k][-1][0] for k in keys])
    out = []
    for n, k in enumerate(keys):
        for at, r in enumerate(own[k]):
            beside = siblings(trees[k], at) + siblings(top, n)
            again = folded(leaf(r, r[0] is not None and r[0] % 2), beside)
            proof = hashed(*(x for x, _ in beside if x is not None))
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], proof, again, again == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("span", [1, 2, 10])
def test_equals_plain_trees(make_docs, texts, span):
    rows = [(d, t, ["en", "fr", "de"][d % 3]) for d, t in texts[:75]] + EDGES
    longer = F.when(F.col("doc_id") % 2 == 1, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    got = merkle.manifest(make_docs(rows), FIELDS, tampered={"n_chars": longer}, span=span)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == plain_manifest(rows)


@pytest.mark.parametrize("rows", [[], [(1, "only", "de")], [(1, None, None), (1, None, None)]])
def test_small_tables(make_docs, rows):
    got = merkle.manifest(make_docs(rows), FIELDS).collect()
    assert len(got) == len(rows) and all(r.verified for r in got)


@pytest.mark.parametrize("leaves", [1, 2, 3, 7, 8, 13, 32, 33, 100])
def test_places_are_those_of_a_postorder_walk(leaves):
    walked = []

    def walk(level, number):
        if level:
            walk(level - 1, 2 * number)
            if (2 * number + 1) << (level - 1) < leaves:
                walk(level - 1, 2 * number + 1)
        walked.append((level, number))

    walk(merkle.height(leaves), 0)
    assert [merkle.node_place(level, number, leaves) for level, number in walked] == list(range(len(walked)))


def test_log_is_whole_and_every_builder_is_aligned(spark):
    leaves = [(0, n, sha256(b"%d" % n).digest()) for n in range(37)] + [(1, 0, sha256(b"x").digest())]
    sizes = spark.createDataFrame([(0, 37), (1, 1)], "tree bigint, leaves bigint")
    rows = spark.createDataFrame(leaves, "tree bigint, number bigint, digest binary")
    log = merkle.append_log(rows, sizes, span=2).collect()
    tree = levels([x.hex() for _, _, x in leaves[:37]])
    placed = {r.place + k: r.digests[32 * k : 32 * k + 32].hex() for r in log if r.tree == 0 for k in range(len(r.digests) // 32)}
    assert sorted(placed) == list(range(sum(map(len, tree))))
    assert all(placed[merkle.node_place(n, k, 37)] == x for n, level in enumerate(tree) for k, x in enumerate(level))
    assert len({r.builder for r in log if r.tree == 0 and r.tier == 0}) == 10
    assert [r.digests for r in log if r.tree == 1] == [leaves[-1][2]]
