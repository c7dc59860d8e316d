"""Whole texts as numpy arrays: words and word shingles as 64-bit hashes.

Texts are taken from Arrow buffers without making Python strings. Long batches are cut into
chunks of whole documents, and a very long document into pieces at white space, so that the
working memory is a small multiple of `CHUNK_BYTES` plus eight bytes per word of one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
_random = np.random.default_rng(20240817)
_BYTE = _random.integers(1 << 62, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x5851F42D4C957F2D)
_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_S1, _S2, _S3 = (np.uint64(x) for x in (30, 27, 31))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = (x ^ (x >> _S1)) * _M1
    x = (x ^ (x >> _S2)) * _M2
    return x ^ (x >> _S3)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; a null is an empty text."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def document_chunks(at: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about `limit` bytes; one document is never split."""
    low, end = 0, len(at) - 1
    while low < end:
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
        yield low, min(high, end)
        low = min(high, end)


def _hash_words(body: np.ndarray, starts_of_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words in a chunk, and the byte at which each word starts."""
    white = WHITE[body]
    first = ~white
    first[1:] &= white[:-1]
    edges = starts_of_docs[starts_of_docs < len(body)]
    first[edges] = ~white[edges]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    lengths = np.diff(np.append(starts, len(body)))
    place = np.arange(starts[0], len(body)) - np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    value = _BYTE[LOWER[body[starts[0] :]]] * powers[place]
    value[white[starts[0] :]] = 0
    return mixed(np.add.reduceat(value, starts - starts[0])), starts


def _pieces(body: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """One long document cut behind white space into pieces of at least `limit` bytes."""
    low = 0
    while low < len(body):
        high = low + limit
        while high < len(body):
            gap = np.flatnonzero(WHITE[body[high : high + limit]])
            if len(gap):
                high += int(gap[0])
                break
            high += limit
        yield body[low : min(high, len(body))]
        low = min(high, len(body))


def word_hashes(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, word hashes, offsets of each document's words) per chunk of documents.

    A word is a run of bytes other than ASCII white space, with A-Z lower-cased.
    """
    body, at = text_buffers(column)
    for low, high in document_chunks(at, limit):
        part = body[at[low] : at[high]]
        if high == low + 1 and len(part) > 2 * limit:
            whole = np.concatenate([_hash_words(x, np.zeros(1, np.int64))[0] for x in _pieces(part, limit)])
            yield low, whole, np.array([0, len(whole)])
        else:
            edges = at[low : high + 1] - at[low]
            hashes, starts = _hash_words(part, edges[:-1])
            yield low, hashes, np.searchsorted(starts, edges)


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text.

    A text of fewer than `words` words has its whole word sequence as one shingle; a text
    without words has none.
    """
    for low, hashes, at in word_hashes(column):
        rolled = _rolled(hashes, words)
        for k in range(len(at) - 1):
            begin, end = at[k], at[k + 1]
            if end - begin >= words:
                yield low + k, np.unique(rolled[begin : end - words + 1])
            elif end > begin:
                yield low + k, _rolled(hashes[begin:end], int(end - begin)) + np.uint64(end - begin)
            else:
                yield low + k, np.zeros(0, np.uint64)


def _rolled(hashes: np.ndarray, words: int) -> np.ndarray:
    n = len(hashes) - words + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, words):
        out = mixed(out * _M3 + hashes[k : k + n])
    return out
