import re

import pytest

from tallyline.llm import decontaminate
from tallyline.llm.decontaminate import benchmark_hits, without_benchmark

ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven."),
    (1, "again: a b c d e f g h i j"),
    (20, "short item"),
    (3, "short item"),
    (None, "nameless thing"),
    (5, None),
    (6, "?!"),
    (7, "éa Éa x"),
]
ROWS = [
    (1, "Before ONE, two-three four five six seven; eight nine ten ELEVEN after"),
    (2, "one two three four five six seven eight nine"),
    (3, "a short  ITEM, and a short item. shorts item"),
    (4, "nameless thing short"),
    (5, None),
    (6, ""),
    (7, "éa Éa X éa éa x"),
    (8, "b c d e f g h i j k"),
    (8, "a b c d e f g h i j short item"),
]


def own_words(text):
    return [(m.group().translate({c: c + 32 for c in range(65, 91)}), m.span()) for m in re.finditer(r"[0-9A-Za-z\x80-\U0010FFFF]+", text or "")]


def plain(rows, items):
    out = []
    for doc, text in rows:
        words = own_words(text)
        hit, found = set(), set()
        for item, body in items:
            own = [w for w, _ in own_words(body)]
            n = min(10, len(own))
            for s in range(len(own) - n + 1) if n else ():
                for k in range(len(words) - n + 1):
                    if [w for w, _ in words[k : k + n]] == own[s : s + n]:
                        hit |= set(range(k, k + n))
                        found |= {str(item)} - {"None"}
        out.append((doc, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard", [64 << 20, 60])
def test_against_all_windows(spark, make_docs, monkeypatch, shard):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    got = benchmark_hits(make_docs(ROWS), bench).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == plain(ROWS, ITEMS)
    for r in got:
        text = next(t for d, t in ROWS if d == r.doc_id and len(own_words(t)) == r.n_words)
        assert sum(len(own_words(text[x.begin : x.end])) for x in r.spans) == r.n_hit
    assert next(r for r in got if r.doc_id == 1).spans[0].begin == 7


def test_filter_keeps_columns(spark, make_docs):
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    docs = make_docs(ROWS)
    left = without_benchmark(docs, bench)
    assert left.schema == docs.schema
    assert sorted((r.doc_id, r.text) for r in left.filter("text is not null").collect()) == [(2, ROWS[1][1]), (6, ""), (8, ROWS[7][1])]
    assert left.count() == 4


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id int, text string")
    assert benchmark_hits(make_docs([]), none).count() == 0
    assert {(r.n_hit, r.contaminated) for r in benchmark_hits(make_docs(ROWS), none).collect()} == {(0, False)}
