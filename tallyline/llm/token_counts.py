"""Greedy word-piece counts by one pass over a vocabulary trie with failure links.

Longest-match-first tokenisation takes the longest vocabulary entry that a word begins with,
then goes on behind it. The automaton never goes back: where a trie node has no child for the
next byte, its failure link leads to the node for what remains unmatched, and a precomputed
number says how many pieces that closes. Counts are therefore summed without building pieces,
in time linear in the word.

The vocabulary is that of a byte-level tokenizer with marked word ends: entries are strings of
bytes, some with an end mark, and every single byte is an entry with and without it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
WORD_END = "</w>"
END = 256
WORD = re.compile(r"[^\W\d_]+|\d|(?:[^\s\w]|_)+")
CACHE, CACHED_LETTERS = 300_000, 40
LONG_TEXT = 1 << 22


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies: visible
    Latin-1 characters for themselves, the others moved behind them in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(moved)}


def vocabulary_entries(path: str) -> list[tuple[int, ...]]:
    """Entries as tuples of bytes, with `END` for the end mark; special tokens are left out."""
    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    special = {x["content"] for x in parsed.get("added_tokens", [])}
    alphabet = byte_alphabet()
    out = []
    for entry in parsed["model"]["vocab"]:
        body = entry.removesuffix(WORD_END)
        if entry not in special and body and all(c in alphabet for c in body):
            out.append(tuple(alphabet[c] for c in body) + ((END,) if body != entry else ()))
    return out


class PieceCounter:
    """The trie as one table of transitions, failure links and popped counts."""

    def __init__(self, entries: list[tuple[int, ...]]):
        self.next: dict[int, int] = {}
        parents, symbols, ends = [-1], [-1], {0: False}
        for entry in entries:
            node = 0
            for symbol in entry:
                key = node * 257 + symbol
                if key not in self.next:
                    self.next[key] = len(parents)
                    parents.append(node)
                    symbols.append(symbol)
                node = self.next[key]
            ends[node] = True
        depth = [0] * len(parents)
        for node in range(1, len(parents)):
            depth[node] = depth[parents[node]] + 1
        # -1: nothing that begins like this node can be split into entries
        self.fail, self.pops = [-1] * len(parents), [0] * len(parents)
        for node in np.argsort(depth, kind="stable").tolist()[1:]:
            if ends.get(node):
                self.fail[node], self.pops[node] = 0, 1
                continue
            at, popped = self.fail[parents[node]], self.pops[parents[node]]
            while at >= 0 and at * 257 + symbols[node] not in self.next:
                popped += self.pops[at]
                at = self.fail[at]
            if at >= 0:
                self.fail[node], self.pops[node] = self.next[at * 257 + symbols[node]], popped

    def count(self, word: bytes) -> int:
        """Pieces of one word; a word that no entries make up is one unknown piece."""
        node, total = 0, 0
        for symbol in (*word, END):
            while (after := self.next.get(node * 257 + symbol)) is None:
                if self.fail[node] < 0:
                    return 1
                total += self.pops[node]
                node = self.fail[node]
            node = after
        while node:
            if self.fail[node] < 0:
                return 1
            total += self.pops[node]
            node = self.fail[node]
        return total


class _Counts(dict):
    """Piece counts of short words met lately."""

    def __init__(self, counter: PieceCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> int:
        found = self.counter.count(word.encode())
        if len(word) <= CACHED_LETTERS:
            if len(self) >= CACHE:
                self.clear()
            self[word] = found
        return found


_COUNTS: dict[str, _Counts] = {}


def _counts(path: str) -> _Counts:
    if path not in _COUNTS:
        _COUNTS[path] = _Counts(PieceCounter(vocabulary_entries(path)))
    return _COUNTS[path]


def text_counts(text: str, counts: _Counts) -> tuple[int, int]:
    """Words and pieces of a text."""
    lowered = text.lower()
    if len(lowered) <= LONG_TEXT:
        found = WORD.findall(lowered)
        return len(found), sum(map(counts.__getitem__, found))
    words = pieces = 0
    for match in WORD.finditer(lowered):
        words, pieces = words + 1, pieces + counts[match.group()]
    return words, pieces


def token_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens.

    Words of the lower-cased text are runs of letters, single digits, and runs of other
    characters that are not white space. Pieces are the greedy longest matches of
    `vocabulary`, a path that every executor can read.

    A null or empty text has none. Whole texts are counted; repeated rows stay; an empty table
    gives an empty result; other columns are not used.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(path)
        for batch in batches:
            found = [text_counts(x.as_py() or "", counts) for x in batch.column(1)]
            columns = list(zip(*found, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_words", "n_tokens"]
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text))
    return chosen.mapInArrow(count, f"doc_id {kind}, n_words bigint, n_tokens bigint")
