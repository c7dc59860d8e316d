"""Token ids on disk: exact round trips, ids against the tokenizers library."""

import io
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyline.llm import token_files as TF
from tallyline.llm import token_ids as TI
from tallyline.llm.token_ids import TokenIds, token_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")
EDGES = [
    (901, None), (902, ""), (903, "<|endoftext|> a <|endoftext|>"), (904, " \n\t\x85 é日本 🙂"), (905, "same"), (905, "same"),
    (905, "other"), (None, "no id"), (906, "long words. " * 20_000), (907, " " * 3000 + "x"),
]


class Source:
    def __init__(self, body):
        self.body = body

    def read_at(self, count, at):
        return self.body[at : at + count]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70), st.sampled_from([4, 32]), st.integers(1, 20))
def test_planes_and_files_round_trip(ids, planes, block):
    ids = np.array(ids, "<u4")
    assert TF.from_planes(TF.to_planes(ids, planes), len(ids)).tolist() == ids.tolist()
    out = io.BytesIO()
    writer = TF.TokenWriter(out, block, planes)
    writer.append(ids[:30])
    assert writer.append(ids[30:]) == min(30, len(ids))
    writer.finish()
    reader = TF.TokenReader(Source(out.getvalue()), len(out.getvalue()))
    for a, n in ((0, len(ids)), (len(ids) // 3, len(ids) // 2), (len(ids), 0)):
        assert [x for part in reader.read(a, n) for x in part.tolist()] == ids[a : a + n].tolist()


def test_a_damaged_block_raises():
    out = io.BytesIO()
    writer = TF.TokenWriter(out, 8)
    writer.append(np.arange(20))
    writer.finish()
    body = bytearray(out.getvalue())
    index = TF.TokenReader(Source(bytes(body)), len(body)).index.copy()
    index["crc"][1] ^= 1
    body[-TF._TAIL.size - index.nbytes : -TF._TAIL.size] = index.tobytes()
    reader = TF.TokenReader(Source(bytes(body)), len(body))
    assert next(reader.read(0, 8)).tolist() == list(range(8))
    with pytest.raises(ValueError, match="damaged"):
        list(reader.read(0, 20))
    with pytest.raises(ValueError, match="not a file"):
        TF.TokenReader(Source(bytes(50)), 50)


PIECES = st.sampled_from([" ", "  ", "\n", "\t", "\r", "\x1c", "\x85", "　", "a", "don't", "'s", "É", "ß", "日本", "12", ".", "...", "!?", "_", "<|endoftext|>", "🙂"])


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(PIECES, max_size=30).map("".join)))
def test_ids_are_those_of_the_tokenizer(text):
    assert token_ids(PATH).many(["", text, "a b.", text])[1].tolist() == plain_ids(text)


_TOKENIZER = Tokenizer.from_file(PATH)


def plain_ids(text):
    return _TOKENIZER.encode(text, add_special_tokens=False).ids


def test_few_known_parts_change_nothing(texts, monkeypatch):
    monkeypatch.setattr(TI, "CHUNK_BYTES", 2000)
    bodies = [t for _, t in texts[:60]]
    assert [x.tolist() for x in TokenIds(PATH, 50).many(bodies)] == [plain_ids(t) for t in bodies]


def test_equal_hashes_are_told_apart(texts, monkeypatch):
    monkeypatch.setattr(TI, "mixed", lambda x: x & np.uint64(7))
    bodies = [t for _, t in texts[:20]]
    assert [x.tolist() for x in TokenIds(PATH).many(bodies)] == [plain_ids(t) for t in bodies]


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000, "ab " * 400_000, "<a " * 300_000])
def test_hostile_texts_take_seconds(text):
    began = time.time()
    ids = token_ids(PATH).many([text])[0]
    assert len(ids) and time.time() - began < 30


@pytest.mark.parametrize("planes, block", [(32, 64), (4, 1 << 16)])
def test_files_hold_all_documents_in_order(make_docs, texts, planes, block):
    rows = texts[:80] + EDGES
    index = TF.write_token_files(make_docs(rows), planes=planes, block=block)
    got = TF.read_token_files(index, with_ids=True).collect()
    want = sorted((([*plain_ids(t or ""), 0], d) for d, t in rows), key=lambda x: (x[1] is not None, x[1] or 0))
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [d for _, d in want]
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(d), ids) for ids, d in want)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens


def test_empty_table(make_docs):
    assert TF.read_token_files(TF.write_token_files(make_docs([]))).count() == 0
