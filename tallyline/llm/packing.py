"""Token packing by Karmarkar-Karp multiway differencing.

Every document becomes token ids and an end id. Whole windows are cut off its front; the rests
are packed in groups of a bounded number of tokens that form while a task reads its
documents, so packing shuffles nothing. In a group, partial partitions with the largest
imbalance are merged first, the largest part of one with the smallest of the other, until one
partition of near-equal windows is left. While a window exceeds the capacity, their number rises.
The emptiest windows are then cut to fill the gaps that the others have; what remains of them, less
than a window, is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tables import small_batches
from tallyline.llm.token_ids import VOCABULARY, token_ids

CAPACITY = 2048
GROUP_WINDOWS = 128
# A task holds the tokens of so many full groups while it fills windows of several kinds.
OPEN_GROUPS = 32
END_ID = 1
Piece = tuple[int, int, int]  # number of a document's rest, first id in it, ids


def balanced_windows(lengths: list[int], windows: int) -> list[list[int]]:
    """Items in `windows` parts of near-equal sums, by largest differencing.

    A partial partition keeps its non-empty parts in falling order. Two of them merge with
    opposing imbalances: the largest part of one meets the smallest of the other.
    """
    heap = [(-n, k, [(n, [k])]) for k, n in enumerate(lengths)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, first, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        shared = max(0, len(a) + len(b) - windows)
        met = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[len(a) - shared :], reversed(b[len(b) - shared :]), strict=True)]
        parts = sorted(a[: len(a) - shared] + met + b[: len(b) - shared], key=lambda x: -x[0])
        spread = parts[0][0] - (parts[-1][0] if len(parts) == windows else 0)
        heapq.heappush(heap, (-spread, first, parts))
    found = [items for _, items in heap[0][2]] if heap else []
    return found + [[] for _ in range(windows - len(found))]


def whole_windows(lengths: list[int], capacity: int) -> list[list[int]]:
    """Windows of uncut items; their number rises until no window exceeds the capacity."""
    windows = max(1, -(-sum(lengths) // capacity))
    while True:
        found = balanced_windows(lengths, windows)
        if all(sum(lengths[k] for k in x) <= capacity for x in found):
            return [x for x in found if x]
        windows += 1


def cut_windows(lengths: list[int], capacity: int) -> list[list[Piece]]:
    """`whole_windows` without gaps: the emptiest are cut to fill the others, and what remains of
    them makes windows of powers of two."""
    filled = [[(k, 0, lengths[k]) for k in x] for x in whole_windows(lengths, capacity)] if lengths else []
    filled.sort(key=lambda x: -sum(p[2] for p in x))
    full = filled[: sum(lengths) // capacity]
    spare = [piece for window in filled[len(full) :] for piece in window]
    for window in full:
        moved, spare = _split(spare, capacity - sum(p[2] for p in window))
        window += moved
    size = capacity
    while spare:
        size //= 2
        if sum(p[2] for p in spare) >= size:
            moved, spare = _split(spare, size)
            full.append(moved)
    return full


def _split(pieces: list[Piece], size: int) -> tuple[list[Piece], list[Piece]]:
    """The first `size` ids of the pieces, and the rest."""
    left: list[Piece] = []
    for at, (k, begin, n) in enumerate(pieces):
        if n > size:
            if size:
                left.append((k, begin, size))
            return left, [(k, begin + size, n - size), *pieces[at + 1 :]]
        left.append((k, begin, n))
        size -= n
    return left, []


class _Group:
    """Rests of documents until they are packed, and the rows that are ready."""

    def __init__(self, capacity: int, group_windows: int, cut: bool, kind, sequences: Iterator[int], rows: list[tuple]):
        self.capacity, self.limit, self.cut = capacity, capacity * group_windows, cut
        self.kind, self.sequences, self.rows = kind, sequences, rows
        self.rests: list[tuple] = []
        self.held = 0

    def add(self, doc, ids: np.ndarray) -> None:
        total = len(ids)
        whole = total - total % self.capacity
        for begin in range(0, whole, self.capacity):
            self._row(doc, begin, ids[begin : begin + self.capacity], total, next(self.sequences), 0)
        if whole < total:
            # a copy, so that the whole windows are not held with it
            self.rests.append((doc, whole, ids[whole:].copy() if whole else ids, total))
            self.held += total - whole
        if self.held >= self.limit:
            self.pack()

    def pack(self) -> None:
        lengths = [len(x[2]) for x in self.rests]
        if self.cut:
            windows = cut_windows(lengths, self.capacity)
        else:
            windows = [[(k, 0, lengths[k]) for k in x] for x in whole_windows(lengths, self.capacity)] if lengths else []
        for window in windows:
            place, sequence = 0, next(self.sequences)
            for k, begin, n in window:
                doc, start, ids, total = self.rests[k]
                self._row(doc, start + begin, ids[begin : begin + n], total, sequence, place)
                place += n
        self.rests, self.held = [], 0

    def _row(self, doc, start: int, ids: np.ndarray, total: int, sequence: int, place: int) -> None:
        self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, place, self.kind))


class _Groups:
    """A group for each kind of document, of which none shares a window with another."""

    def __init__(self, capacity: int, group_windows: int, cut: bool):
        self.rows: list[tuple] = []
        self.of: dict = {}
        self.limit = capacity * group_windows * OPEN_GROUPS
        first = TaskContext.get().partitionId() << 32
        self.settings = capacity, group_windows, cut
        self.sequences = itertools.count(first)
        self.held = 0

    def add(self, kind, doc, ids: np.ndarray) -> None:
        group = self.of.get(kind)
        if group is None:
            group = self.of[kind] = _Group(*self.settings, kind, self.sequences, self.rows)
        before = group.held
        group.add(doc, ids)
        self.held += group.held - before
        if self.held >= self.limit:
            self.pack()

    def pack(self) -> None:
        for group in self.of.values():
            group.pack()
        self.of, self.held = {}, 0

    def ready(self, kinds: list[pa.DataType]) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "kind"]
        types = [kinds[0], *[pa.int64()] * 6, *kinds[1:]]
        columns = [pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), types, strict=False)]
        self.rows.clear()
        return pa.RecordBatch.from_arrays(columns, names[: len(columns)])


def packed_pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    group_windows: int = GROUP_WINDOWS,
    cut: bool = True,
    vocabulary: str | None = None,
    by: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text and `END_ID`; each id is in exactly one piece. A
    sequence holds at most `capacity` (a power of two) ids without gaps. With `cut`, sequences
    are full but for a few of smaller powers of two per group; without it only documents
    longer than a window are cut and windows keep their gaps. Either way the number of windows rises
    until all rests fit.

    A null or empty text has its end id alone. Repeated rows are packed each for itself; an
    empty table gives an empty result; other columns are not used. A task holds the ids of one
    text and of its open groups. Sequence ids are unique, by input partition, not dense.

    With `by`, a sequence holds documents of one value of that column alone, which is added to
    each row; null is a value. Each value has groups of its own, and so a few shorter sequences.
    """
    small_batches(docs.sparkSession)
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, groups = token_ids(path), _Groups(capacity, group_windows, cut)
        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [c.type for k, c in enumerate(batch.columns) if k != 1]
            docs_of = batch.column(0).to_pylist()
            kinds_of = batch.column(2).to_pylist() if by else [None] * len(docs_of)
            for doc, ids, kind in zip(docs_of, encoder.column(batch.column(1)), kinds_of, strict=True):
                groups.add(kind, doc, np.append(ids, np.uint32(END_ID)))
                if len(groups.rows) >= 5000:
                    yield groups.ready(kinds)
        groups.pack()
        if groups.rows:
            yield groups.ready(kinds)

    kind = docs.schema[doc_id].dataType.simpleString()
    longs = ", ".join(f"{x} bigint" for x in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *[F.col(x).alias("kind") for x in [by] if x])
    if by is None:
        return rows.mapInArrow(pack, f"doc_id {kind}, {longs}")
    return rows.mapInArrow(pack, f"doc_id {kind}, {longs}, kind {docs.schema[by].dataType.simpleString()}").withColumnRenamed("kind", by)
