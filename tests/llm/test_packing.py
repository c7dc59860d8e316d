import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyline.llm.packing import balanced_windows, cut_windows, packed_pieces, whole_windows

EDGES = [(900, None), (901, ""), (902, "<|endoftext|> a <|endoftext|>"), (903, " \n\t\x85 é日本 🙂"), (904, "a"), (904, "a"), (None, "none"), (905, "long " * 3000)]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("cut", [True, False])
def test_every_id_in_one_piece(make_docs, texts, tokenizer, cut):
    rows = texts[:60] + EDGES
    got = packed_pieces(make_docs(rows), capacity=256, group_windows=8, cut=cut).collect()
    docs = {}
    for doc, text in rows:
        docs.setdefault(doc, []).append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    ids = 0
    for doc, copies in docs.items():
        pieces = sorted((r.start, r.length) for r in got if r.doc_id == doc)
        covered = sorted(x for a, n in pieces for x in range(a, a + n))
        assert covered == sorted(x for c in copies for x in range(len(c)))
        ids += len(covered)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(docs[r.doc_id][0][r.start : r.start + r.length].tobytes())
        assert r.doc_tokens == len(docs[r.doc_id][0])
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    sizes = []
    for pieces in sequences.values():
        pieces.sort()
        assert [a for a, _ in pieces] == [0, *np.cumsum([n for _, n in pieces])[:-1]]
        sizes.append(sum(n for _, n in pieces))
    assert max(sizes) <= 256 and sum(sizes) == ids
    if cut:
        assert all(n & (n - 1) == 0 for n in sizes)


def test_empty_table(make_docs):
    assert packed_pieces(make_docs([])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=40), st.integers(1, 9))
def test_differencing(lengths, windows):
    found = balanced_windows(lengths, windows)
    assert len(found) == windows or not lengths
    assert sorted(x for w in found for x in w) == list(range(len(lengths)))
    sums = sorted(sum(lengths[k] for k in w) for w in found)
    assert not lengths or sums[-1] - sums[0] <= max(lengths)


def test_differencing_known_case():
    sums = sorted(sum([8, 7, 6, 5, 4][k] for k in w) for w in balanced_windows([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]  # the classic result of the method


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=40))
def test_windows_hold_everything(lengths):
    whole = whole_windows(lengths, 64)
    assert sorted(x for w in whole for x in w) == list(range(len(lengths)))
    assert all(sum(lengths[k] for k in w) <= 64 for w in whole)
    cut = cut_windows(lengths, 64)
    sizes = [sum(n for _, _, n in w) for w in cut]
    assert sum(sizes) == sum(lengths) and all(n & (n - 1) == 0 and n <= 64 for n in sizes)
    covered = sorted((k, x) for w in cut for k, a, n in w for x in range(a, a + n))
    assert covered == [(k, x) for k, n in enumerate(lengths) for x in range(n)]


def test_window_number_rises():
    assert len(whole_windows([40, 40, 40, 8], 64)) == 3 > -(-128 // 64)
