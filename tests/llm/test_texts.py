"""Token counts, chats, WARC records and toxicity on small cases."""

import gzip

import numpy as np
import pytest

from tallyline.llm import chat, toxicity, warc
from tallyline.llm.token_counts import END, WORD, PieceCounter, token_counts, vocabulary_entries


def greedy(word, entries):
    rest, count = (*word, END), 0
    while rest:
        n = next((n for n in range(len(rest), 0, -1) if rest[:n] in entries), 0)
        if not n:
            return 1
        rest, count = rest[n:], count + 1
    return count


def test_counts_are_greedy(make_docs, texts):
    import public_tokenizers

    entries = vocabulary_entries(public_tokenizers.path("word_bpe_49k.json"))
    known = set(entries)
    rows = [*texts[:15], (900, None), (901, ""), (902, "x" * 3000 + " É日本 🙂 a1b22_c"), (902, "dup"), (902, "dup"), (None, "n")]
    got = {(r.doc_id, r.n_words, r.n_tokens) for r in token_counts(make_docs(rows)).collect()}
    want = set()
    for doc, text in rows:
        own = WORD.findall((text or "").lower())
        want.add((doc, len(own), sum(greedy(w.encode(), known) for w in own)))
    assert got == want
    assert token_counts(make_docs([])).count() == 0


def test_counter_against_greedy_on_random_vocabularies():
    rng = np.random.default_rng(3)
    for _ in range(60):
        entries = {tuple(rng.integers(0, 3, rng.integers(1, 6)).tolist()) for _ in range(12)} | {(0,), (1,)}
        entries |= {(*e, END) for e in list(entries)[::3]}
        counter = PieceCounter(sorted(entries))
        for _ in range(40):
            word = bytes(rng.integers(0, 3, rng.integers(0, 12)).tolist())
            assert counter.count(word) == greedy(word, entries)


TURNS = [
    ("a", 0, "user", "hi"), ("a", 1, "assistant", "hello"),
    ("b", 0, "user", "hi"), ("b", 1, "assistant", "hello"), ("b", 2, "user", "more"),
    ("c", 5, "user", "hi"), ("c", 9, "assistant", "hello"), ("c", 11, "user", "more"),
    ("d", 0, "user", "hi"), ("d", 1, "assistant", "other"),
    ("e", 0, "user", None), ("f", 0, "user", ""), ("g", 0, None, "hi"), ("h", None, "user", "q"), ("h", 0, "user", "r"),
    ("a", 0, "user", "hi"), ("i", 0, "x", "same turn"), ("i", 0, "a", "same turn"), (None, 0, "user", "no id"),
]


@pytest.mark.parametrize("slice_turns", [1000, 2])
def test_only_maximal_conversations_stay(spark, monkeypatch, slice_turns):
    monkeypatch.setattr(chat, "SLICE_TURNS", slice_turns)
    turns = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id string, turn int, role string, text string, place string")
    got = {(r.conv_id, r.page): (r.n_turns, r.chat) for r in chat.rendered_chats(turns, page_turns=2).collect()}
    assert {c for c, _ in got} == {"b", "d", "e", "f", "g", "h", "i", None}
    assert got["b", 0] == (2, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n")
    assert got["b", 1] == (1, "<|im_start|>user\nmore<|im_end|>\n")
    assert got["h", 0][1].startswith("<|im_start|>user\nq") and got["g", 0][1].startswith("<|im_start|>unknown")
    assert chat.rendered_chats(turns.limit(0)).count() == 0


def test_chat_plan_has_no_python(spark, small):
    frame = chat.rendered_chats(spark.read.parquet(f"{small}/conversations.parquet"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


PAGES = [
    (1, "http://a/", "<html><title>A &amp; B</title><body><p>x &lt; y<br>two  words<script>var a='</p>'</script><a href='/l?a&amp;b'>go</a>"),
    (2, None, None), (3, "http://c/", ""), (3, "http://c/", ""), (None, "http://d/", "<!-- never closed <p>hidden"), (5, "http://e/", "plain 1 < 2 &unknown; é"),
]


def test_derived_records(spark, folder):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id int, url string, html string, kind string")
    responses = warc.page_responses(pages)
    rows = warc.derivatives(responses).collect()
    assert len(rows) == 2 * len(PAGES)
    text = {(r.target_uri, r.kind): r for r in rows}
    assert text["http://a/", "conversion"].block == "A & B\nx < y\ntwo words go"
    assert "title: A & B\r\n" in text["http://a/", "metadata"].block and "outlink: /l?a&b\r\n" in text["http://a/", "metadata"].block
    assert "source-header: Content-Type: text/html; charset=utf-8\r\n" in text["http://a/", "metadata"].block
    assert text["http://d/", "conversion"].block == "" and text["http://e/", "conversion"].block == "plain 1 < 2 &unknown; é"
    assert {r.refers_to for r in rows} == {r.record_id for r in responses.collect()}
    for r in rows:
        head, _, rest = r.record.partition("\r\n\r\n")
        assert rest == r.block + "\r\n\r\n" and f"Content-Length: {len(r.block.encode())}" in head
        assert f"WARC-Refers-To: {r.refers_to}" in head
    warc.write_warc(warc.derivatives(responses), f"{folder}/out")
    files = spark.read.format("binaryFile").load(f"{folder}/out").collect()
    assert sorted(b"".join(gzip.decompress(f.content) for f in files).split(b"WARC/1.1\r\n")) == sorted(
        [b""] + [r.record.encode().removeprefix(b"WARC/1.1\r\n") for r in rows]
    )
    assert warc.derivatives(responses.limit(0)).count() == 0


def test_responses_from_warc_bytes(spark):
    block = b"HTTP/1.1 404 Not Found\r\nX: 1\r\n\r\n<p>gone"
    head = lambda kind, n: f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x>\r\nWARC-Target-URI: http://t/\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nContent-Length: {n}\r\n\r\n".encode()
    body = head("warcinfo", 3) + b"abc\r\n\r\n" + head("response", len(block)) + block + b"\r\n\r\n" + head("response", 900) + b"cut"
    files = spark.createDataFrame([(bytearray(body),), (None,), (bytearray(b"junk"),)], "content binary")
    rows = warc.derivatives(warc.parse_responses(files)).collect()
    assert [(r.refers_to, r.source_status, r.source_content_type) for r in rows] == [("<urn:x>", "404", None)] * 2
    assert {r.block for r in rows if r.kind == "conversion"} == {"gone"}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, left = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, left[j] + 1, left[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = np.random.default_rng(6)
    words = ["loser", "clown", "abc", "aabbaab", "babab"]
    lexicon = toxicity.Lexicon(words, ["stemm"])
    for _ in range(3000):
        token = "".join(rng.choice(list("abloserclwn"), rng.integers(1, 8)))
        if rng.random() < 0.5:
            base = list(words[rng.integers(len(words))])
            base[rng.integers(len(base))] = str(rng.choice(list("abx")))
            token = "".join(base)
        exact = token in words
        # the first letter must be right; only longer terms may be misspelled
        fuzzy = any(len(w) >= 5 and token[0] == w[0] and distance(token[1:], w[1:]) <= 1 for w in words)
        want = toxicity.EXACT if exact else toxicity.FUZZY if fuzzy else toxicity.NONE
        assert lexicon.kind(token) == want, token
    assert lexicon.kind("stemmxyz") == toxicity.STEM and lexicon.kind("l0s3r!") == toxicity.EXACT


def test_quotation():
    text = 'he said "you idiot" to me; you idiot'
    assert toxicity.quoted(text, 13, 18) and not toxicity.quoted(text, 31, 36)
    kinds = toxicity._Kinds(toxicity.Lexicon(["idiot"], []))
    assert toxicity.features(text, kinds)[:2] == pytest.approx([np.log(2), np.log(2)])
    assert toxicity.features("", kinds) == [0.0] * toxicity.N_FEATURES


def test_toxic_documents_are_found(spark):
    docs, labels = f"{'/root/testdata/sf0.01'}/documents.parquet", "/root/testdata/sf0.01/labels.parquet"
    docs, labels = spark.read.parquet(docs), spark.read.parquet(labels)
    rows = toxicity.learn_and_score(docs, labels).join(labels, "doc_id").collect()
    hits = [r for r in rows if r.predicted == 1]
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.toxic for r in hits]) > 0.9
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) > 0.7


def test_toxicity_edges(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "words"), (3, "words"), (None, "x")])
    for labels in ([], [(1, 1), (2, 1)], [(3, 0)], [(1, None), (2, 7)], [(1, 1), (2, 0), (3, 0)]):
        frame = spark.createDataFrame(labels, "doc_id long, toxic int")
        rows = toxicity.learn_and_score(docs, frame).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert toxicity.learn_and_score(make_docs([]), frame).count() == 0
