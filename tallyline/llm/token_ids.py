"""Token ids of whole texts by a byte-level vocabulary of the `tokenizers` library.

Such a vocabulary never joins a token over a single space or line end between two other
characters, nor a letter or digit with a mark behind it. Texts are cut there into parts, found
with numpy over the bytes of many texts at once. The library is asked for the ids of each distinct
part, many in one call; a worker keeps those of parts seen lately. Texts with white space side
by side, or white space beyond ASCII, are left to the library whole or in safe pieces.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tallyline.llm.text_arrays import document_chunks, mixed, text_buffers

VOCABULARY = "byte_bpe_50k.json"
KNOWN_PARTS = 300_000
LONG_PART = 64
CHUNK_BYTES = 1 << 19
_SINGLE_SPACE = re.compile(r"(?<=\S)(?= \S)")
_SPACE = re.compile(r"\s")

_random = np.random.default_rng(20250611)
_VALUE = _random.integers(1 << 62, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?"]] = True
_LATIN = np.zeros(256, bool)  # second bytes of accented letters behind 0xC3: all but the signs × and ÷
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


def _odd(body: np.ndarray) -> np.ndarray:
    """Places of white space that follows white space, or lies beyond ASCII."""
    white = _WHITE[body]
    found = [np.flatnonzero(white[1:] & white[:-1])]
    for lead in (0xC2, 0xE1, 0xE2, 0xE3):
        at = np.flatnonzero(body == lead)
        at = at[at + 2 < len(body)] if lead != 0xC2 else at[at + 1 < len(body)]
        second = body[at + 1]
        third = body[at + 2] if lead != 0xC2 else second
        if lead == 0xC2:
            hit = (second == 0x85) | (second == 0xA0)
        elif lead == 0xE1:
            hit = (second == 0x9A) & (third == 0x80)
        elif lead == 0xE2:
            hit = (second == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF))
            hit |= (second == 0x81) & (third == 0x9F)
        else:
            hit = (second == 0x80) & (third == 0x80)
        found.append(at[hit])
    return np.concatenate(found)


def part_starts(body: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where parts begin in texts without odd white space; `edges` are the starts of the texts."""
    cut = body == 32
    line = body == 10
    cut |= line
    cut[1:] |= line[:-1]
    if len(body) > 2:
        before = _WORD[body[1:-1]] | (_LATIN[body[1:-1]] & (body[:-2] == 0xC3))
        cut[2:] |= _MARK[body[2:]] & before
    if len(body) > 1:
        cut[1] |= bool(_MARK[body[1]] & _WORD[body[0]])
    cut[edges[edges < len(body)]] = True
    return np.flatnonzero(cut)


class TokenIds:
    """The ids of `tokenizers` for whole texts, without special tokens added."""

    def __init__(self, path: str, known_parts: int = KNOWN_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        special = {k: len(x.content.encode()) for k, x in self.tokenizer.get_added_tokens_decoder().items()}
        # every character of a byte-level token stands for one byte
        sizes = {k: special.get(k, len(token)) for token, k in self.tokenizer.get_vocab().items()}
        self.sizes = np.zeros(max(sizes) + 1, np.int64)
        self.sizes[list(sizes)] = list(sizes.values())
        self.limit = known_parts
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.powers = np.ones(0, np.uint64)

    def column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Unsigned 32-bit ids of each text of a column; a null or empty text has none."""
        body, at = text_buffers(texts)
        for low, high in document_chunks(at, CHUNK_BYTES):
            yield from self._chunk(body[at[low] : at[high]], at[low : high + 1] - at[low])

    def many(self, texts: list[str]) -> list[np.ndarray]:
        return list(self.column(pa.array(texts, pa.string())))

    def _chunk(self, body: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
        odd = np.unique(np.searchsorted(edges, _odd(body), "right") - 1)
        out: list[np.ndarray | None] = [None] * (len(edges) - 1)
        for d in odd.tolist():
            text = body[edges[d] : edges[d + 1]].tobytes().decode()
            pieces = [x.encode() for x in _SINGLE_SPACE.split(text)]
            out[d] = np.frombuffer(b"".join(self._known(pieces)), "<u4")
        plain = [d for d in range(len(out)) if out[d] is None]
        if len(odd) and plain:
            sizes = np.diff(edges)[plain]
            body = np.concatenate([body[edges[d] : edges[d + 1]] for d in plain])
            edges = np.append(0, np.cumsum(sizes))
        if plain:
            for d, ids in zip(plain, self._plain(body, edges), strict=True):
                out[d] = ids
        return out

    def _plain(self, body: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
        if not len(body):
            return [np.zeros(0, "<u4")] * (len(edges) - 1)
        starts = part_starts(body, edges[:-1])
        number, first = self._distinct(body, starts)
        ends = np.append(starts[1:], len(body))
        held = body.tobytes()
        found = self._known([held[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        begins = np.cumsum(sizes) - sizes
        counts = sizes[number]
        stops = np.cumsum(counts)
        at = np.arange(stops[-1]) + np.repeat(begins[number] - (stops - counts), counts)
        ids = flat[at]
        cuts = np.append(0, stops)[np.searchsorted(starts, edges)]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def _distinct(self, body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each part the number of its bytes among the distinct ones, and a part with these.

        Parts are grouped by a hash and then compared, byte by byte, with the one that stands for
        them; what differs stands for itself.
        """
        lengths = np.diff(np.append(starts, len(body)))
        if len(self.powers) < lengths.max():
            self.powers = np.cumprod(np.full(int(lengths.max()) * 2, _BASE, np.uint64))
        place = np.arange(len(body)) - np.repeat(starts, lengths)
        hashes = np.add.reduceat(_VALUE[body] * self.powers[place], starts)
        hashes = mixed(hashes + lengths.astype(np.uint64))
        _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        same = np.repeat(starts[first[number]], lengths) + place
        differs = np.flatnonzero((body[np.minimum(same, len(body) - 1)] != body) | (np.repeat(lengths[first[number]] != lengths, lengths)))
        if len(differs):
            alone = np.unique(np.searchsorted(starts, differs, "right") - 1)
            number = number.copy()
            number[alone] = len(first) + np.arange(len(alone))
            first = np.append(first, alone)
        return number, first

    def _known(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part, as bytes."""
        if len(self.recent) > self.limit:
            self.older, self.recent = self.recent, {}
        found = list(map(self.recent.get, parts))
        missing = [k for k, ids in enumerate(found) if ids is None]
        fresh = {}
        for k in missing:
            if (ids := self.older.get(parts[k])) is None:
                fresh[parts[k]] = b""
            else:
                found[k] = self.recent[parts[k]] = ids
        if fresh:
            fresh = self._encoded(list(fresh))
            for k in missing:
                if found[k] is None:
                    found[k] = fresh[parts[k]]
            self.recent.update((x, ids) for x, ids in fresh.items() if len(x) <= LONG_PART)
        return found

    def _encoded(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Ids of parts, from one call for those behind a space and one for those without white space."""
        spaced, bare, found = [], [], {}
        for x in parts:
            text = x.decode()
            if not text:
                found[x] = b""
            elif text == " " or _SPACE.search(text, text[0] == " "):
                found[x] = self._ids(text).tobytes()
            else:
                (spaced if text[0] == " " else bare).append(x)
        return found | self._joined(spaced, b"") | self._joined(bare, b"\n")

    def _joined(self, parts: list[bytes], between: bytes) -> dict[bytes, bytes]:
        """The sizes of tokens in bytes tell where parts end."""
        if not parts:
            return {}
        ids = self._ids(between.join(parts).decode())
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(sizes + len(between)) - len(between)
        at = np.append(0, np.cumsum(self.sizes[ids]))
        low, high = np.searchsorted(at, ends - sizes).tolist(), np.searchsorted(at, ends).tolist()
        body = ids.tobytes()
        return {x: body[4 * a : 4 * b] for x, a, b in zip(parts, low, high, strict=True)}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")


_LOADED: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """The encoder of a vocabulary file, loaded once in a worker."""
    if path not in _LOADED:
        _LOADED[path] = TokenIds(path)
    return _LOADED[path]
