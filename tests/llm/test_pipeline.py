"""Each stage of the pipeline against a plain version of itself."""

import re

import numpy as np
import public_tokenizers
import pytest
from test_decontaminate import own_words
from test_ngram_join import shingles
from tokenizers import Tokenizer

import corpus_pipeline
from tallyline.llm.tables import kept


@pytest.fixture(scope="module")
def steps(spark, small):
    """The rows before and after each stage; a few hard rows are added to the documents."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = [(10**6, None, None, "a", 0), (10**6 + 1, "123 !", "en", "a", 5), (10**6 + 2, "", None, "a", 0)]
    first = docs.orderBy("doc_id").first()
    extra += [tuple(first), (10**6 + 3, first.text, None, "b", first.n_chars)]
    docs = kept(docs.unionByName(spark.createDataFrame(extra, docs.schema)))
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(kept(stage(spark, found[-1], small)))
    return found


def rows_of(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)


def test_columns_stay(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "suffix_array", "decontamination", "packing"]
    assert all(x.dtypes == steps[0].dtypes for x in steps[:-1])


def test_language_rejects_texts_without_letters(steps):
    assert rows_of(steps[1]) == [x for x in rows_of(steps[0]) if any(c.isalpha() for c in x[1] or "")]
    assert steps[1].filter("lang is null").count() == 0


def test_one_of_each_near_group(steps):
    rows = rows_of(steps[1])
    sets = [shingles(t, 5) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                up[root(a)] = root(b)
    best = {}
    for k, row in enumerate(rows):
        best[root(k)] = min(best.get(root(k), row), row)
    assert sorted(best.values(), key=str) == rows_of(steps[2])


def test_first_copies_stay(steps):
    seen, want = set(), []
    for doc, text in sorted(rows_of(steps[2])):
        body = text.encode()
        gone = np.zeros(len(body), bool)
        for s in range(len(body) - 199):
            if body[s : s + 200] in seen:
                gone[s : s + 200] = True
            seen.add(body[s : s + 200])
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
        for low, high in zip(edge[::2], edge[1::2], strict=True):  # whole characters only
            while low < high and body[low] & 0xC0 == 0x80:
                gone[low], low = False, low + 1
            while low < high < len(body) and body[high] & 0xC0 == 0x80:
                high -= 1
                gone[high] = False
        left = bytes(np.frombuffer(body, np.uint8)[~gone]).decode()
        if re.search(r"\S", left):
            want.append((doc, left))
    assert rows_of(steps[3]) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())


def test_contaminated_documents_go(spark, small, steps):
    windows = set()
    for r in spark.read.parquet(f"{small}/benchmark.parquet").collect():
        own = [w for w, _ in own_words(r.text)]
        windows |= {tuple(own[k : k + 10]) for k in range(max(1, len(own) - 9)) if own}
    sizes = {len(w) for w in windows}

    def clean(text):
        own = [w for w, _ in own_words(text)]
        return not any(tuple(own[k : k + n]) in windows for n in sizes for k in range(len(own) - n + 1))

    assert rows_of(steps[4]) == [x for x in rows_of(steps[3]) if clean(x[1])]


def test_every_token_is_packed(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows_of(steps[4])}
    got = {}
    for r in steps[5].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want
