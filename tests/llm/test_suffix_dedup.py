import random
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from tallyline.llm import suffix_dedup
from tallyline.llm.suffix_dedup import removal_digest, suffix_ranks, without_repeats

SPAN = 24
EDGES = [(90, None), (91, ""), (92, "short"), (93, "ab" * 40), (94, "z" * SPAN), (95, "é" * 30), (95, "é" * 30), (96, "\0" * 30)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(10, 90)))
    shared = [word() for _ in range(8)]
    made = [(k, word() + rng.choice(shared) + word() + rng.choice(shared) + word()) for k in range(60)]
    return [*made, (100, made[3][1]), (101, made[3][1]), *EDGES]


def windows(rows):
    where = defaultdict(list)
    for k, (_, text) in enumerate(rows):
        body = (text or "").encode()
        for s in range(len(body) - SPAN + 1):
            where[body[s : s + SPAN]].append((k, s))
    return where


def plain_cut(body, starts):
    gone = np.zeros(len(body) + 1, bool)
    for s in starts:
        gone[s : s + SPAN] = True
    spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
    return bytes(np.frombuffer(body, np.uint8)[~gone[:-1]]), spans


@pytest.mark.parametrize("split", [False, True])
def test_digest_against_all_windows(make_docs, rows, monkeypatch, split):
    if split:
        monkeypatch.setattr(suffix_dedup, "HEAVY_ANCHOR", 2)
        monkeypatch.setattr(suffix_dedup, "BUCKET_CONTEXTS", 20)
    hit = defaultdict(list)
    for places in windows(rows).values():
        if len(places) > 1:
            for k, s in places:
                hit[k].append(s)
    want = []
    for k, (doc, text) in enumerate(rows):
        body = (text or "").encode()
        left, spans = plain_cut(body, hit[k])
        want.append((doc, len(body), len(body) - len(left), spans, sha256(left).hexdigest()))
    got = removal_digest(make_docs(rows), min_bytes=SPAN).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


@pytest.mark.parametrize("split", [False, True])
def test_first_copy_stays(make_docs, rows, monkeypatch, split):
    if split:
        monkeypatch.setattr(suffix_dedup, "HEAVY_ANCHOR", 2)
        monkeypatch.setattr(suffix_dedup, "BUCKET_CONTEXTS", 20)
    plain = [x for x in rows if "é" not in (x[1] or "")]  # whole characters are tested below
    first = {}
    for doc, text in sorted((d, t) for d, t in plain if t):
        first.setdefault(text, doc)
    seen, want = set(), []
    for doc, text in sorted(plain, key=lambda x: x[0]):
        body = (text or "").encode()
        if text and first[text] != doc and len(body) >= SPAN:
            want.append((doc, ""))
            continue
        starts = []
        for s in range(len(body) - SPAN + 1):
            if body[s : s + SPAN] in seen:
                starts.append(s)
            seen.add(body[s : s + SPAN])
        want.append((doc, plain_cut(body, starts)[0].decode() if text is not None else None))
    docs = make_docs(plain)
    got = without_repeats(docs, min_bytes=SPAN)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)


def test_cuts_whole_characters(make_docs):
    shared = "ü" * 30
    got = without_repeats(make_docs([(1, "a" + shared), (2, "bö" + shared + "ö")]), min_bytes=SPAN).collect()
    assert {r.doc_id: r.text for r in got}[2] in ("böö", "bö", "b")
    assert all("�" not in r.text for r in got)


def test_empty_table(make_docs):
    assert removal_digest(make_docs([])).count() == 0
    assert without_repeats(make_docs([])).count() == 0


def test_ranks_order_suffixes():
    body = np.frombuffer(b"abracadabra-abracadabra", np.uint8)
    room = len(body) - np.arange(len(body))
    rank = suffix_ranks(body, room, 9)
    whole = [k for k in range(len(body)) if room[k] >= 9]
    assert sorted(whole, key=lambda k: (rank[k], k)) == sorted(whole, key=lambda k: (bytes(body[k : k + 9]), k))
    assert rank[0] == rank[12] and rank[1] == rank[13]


def test_segments_of_a_long_document(monkeypatch):
    rng = np.random.default_rng(5)
    body = rng.integers(97, 101, 3000).astype(np.uint8)
    whole, _ = suffix_dedup._Winnower(SPAN).owners(body)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 256)
    winnower = suffix_dedup._Winnower(SPAN)
    parts = np.concatenate([winnower.owners(p)[0] + low for low, p in winnower.segments(body)])
    assert (parts == whole).all()
