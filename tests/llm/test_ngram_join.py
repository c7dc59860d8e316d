import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyline.llm import ngram_join, text_arrays
from tallyline.llm.components import connected_components
from tallyline.llm.ngram_join import jaccard_groups, one_of_each_group

ASCII = {c: c + 32 for c in range(65, 91)}


def shingles(text, words):
    own = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(ASCII))
    if len(own) < words:
        return {tuple(own)} if own else set()
    return {tuple(own[k : k + words]) for k in range(len(own) - words + 1)}


def plain_groups(rows, words, num, den):
    """(size, component) by comparing all pairs."""
    sets = [shingles(t, words) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                up[root(a)] = root(b)
    ids = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[root(k)] = min(doc, ids.get(root(k), doc))
    return sorted(((d, len(sets[k]), ids.get(root(k))) for k, (d, _) in enumerate(rows)), key=str)


def edited(text, changes, rng):
    own = text.split()
    for _ in range(changes):
        own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
    return " ".join(own)


EDGES = [
    (900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "one"), (905, "one two"), (906, "one\vtwo"),
    (907, "a b c d e f"), (907, "a b c d e f"), (907, "other words entirely here now and then"), (None, "a b c d e f"),
    (None, "nobody else has this text at all"), (908, "ÄÖÜ x y z"), (909, "äöü x y z"),
]


@pytest.mark.parametrize(("words", "ratio"), [(3, (9, 10)), (5, (4, 5))])
def test_against_all_pairs(make_docs, texts, words, ratio, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIGHT_COLUMN", 3)  # both ways through a column
    rng = random.Random(3)
    base = " ".join(f"b{rng.randrange(10**6)}" for _ in range(120))
    near = [(1000 + k, edited(base, rng.choice([0, 1, 2, 3, 6]), rng)) for k in range(40)]
    rows = texts[:120] + near + EDGES
    got = jaccard_groups(make_docs(rows), words=words, ratio=ratio).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_groups(rows, words, *ratio)


def test_one_of_each_group(make_docs):
    docs = make_docs([*EDGES, (5, "a b c d e f"), (6, "A B C D E F")])
    left = one_of_each_group(docs, words=3, ratio=(9, 10))
    assert left.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    gone = [(907, "a b c d e f"), (None, "a b c d e f"), (6, "A B C D E F"), (904, "one"), (906, "one\vtwo")]
    assert found == sorted(((d, t) for d, t in {*EDGES, (5, "a b c d e f")} if (d, t) not in gone), key=str)


def test_repeated_keeper_stays_once(make_docs):
    left = one_of_each_group(make_docs([(1, "a b c d"), (1, "a b c d"), (2, "a b c d")]), words=3)
    assert [r.doc_id for r in left.collect()] == [1]


def test_empty_table(make_docs):
    assert jaccard_groups(make_docs([])).count() == 0
    assert one_of_each_group(make_docs([])).count() == 0


def test_long_documents_in_pieces():
    rng = random.Random(1)
    text = " ".join(f"x{rng.randrange(500)}" for _ in range(4000)) + "y" * 5000 + " end"
    whole = dict(text_arrays.shingle_sets(pa.array([text, "b c d", None]), 3))
    chunks = list(text_arrays.word_hashes(pa.array([text, "b c d", None]), limit=300))
    assert sum(len(h) for _, h, _ in chunks) == len(text.split()) + 3
    one = next(h for low, h, _ in chunks if low == 0)
    assert len(np.unique(text_arrays._rolled(one, 3))) == len(whole[0]) == len(shingles(text, 3))


def test_components(spark):
    chain = [(k, k + 1) for k in range(60)] + [(200, 100), (100, 150), (7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(chain, "a int, b int"), "a", "b")
    assert {r.node: r.component for r in found.collect()} == {**dict.fromkeys(range(61), 0), 100: 100, 150: 100, 200: 100}
    assert connected_components(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0
