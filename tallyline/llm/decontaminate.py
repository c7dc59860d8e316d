"""Benchmark passages found in documents by one Aho-Corasick automaton.

Words are runs of digits, letters and all characters beyond ASCII; A-Z are lower-cased.
A pattern is a window of consecutive words of a benchmark item, written with one space
between words and one at each end, so that matches fall on whole words. Each document is
normalised the same way and scanned once; matches are mapped back to words and to offsets of
the original text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.tables import kept, small_batches
from tallyline.llm.text_arrays import text_buffers

WINDOW_WORDS = 10
SHARD_BYTES = 64 << 20

_TABLE = bytearray(b" " * 128 + bytes(range(128, 256)))
for _low, _high, _shift in ((48, 57, 0), (65, 90, 32), (97, 122, 0)):
    _TABLE[_low : _high + 1] = bytes(c + _shift for c in range(_low, _high + 1))
_NORMAL = bytes(_TABLE)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def normal_words(text: bytes) -> list[bytes]:
    """The lower-cased words of UTF-8 text."""
    return text.translate(_NORMAL).split()


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str, words: int) -> DataFrame:
    """(pattern, item_id) of all windows of all items; items without words have none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = normal_words((body or "").encode())
                size = min(words, len(own))
                windows = {b" ".join(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
                yield pa.RecordBatch.from_pydict(
                    {"pattern": pa.array(list(windows), pa.binary()), "item_id": pa.array([item] * len(windows), pa.string())}
                )

    items = benchmark.select(F.col(item_id).cast("string"), F.col(text))
    return items.mapInArrow(cut, "pattern binary, item_id string").distinct()


def _automaton(name: str, windows: list[tuple[bytes, list[str]]]) -> ahocorasick.Automaton:
    """Built once in each Python worker."""
    if name not in _AUTOMATA:
        _AUTOMATA.clear()
        made = ahocorasick.Automaton()
        for pattern, items in windows:
            made.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, tuple(items)))
        made.make_automaton()
        _AUTOMATA[name] = made
    return _AUTOMATA[name]


def _scan(windows: list[tuple[bytes, list[str]]], docs: DataFrame, place: int) -> DataFrame:
    """Add the matches of these windows to the columns n_words, hits and items.

    `place` is that of the text among the fields of `row`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    name = uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _automaton(name, shared.value) if shared.value else None
        for batch in batches:
            body, at = text_buffers(batch.column("row").field(place))
            hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            sizes = []
            for d in range(len(batch)):
                own = normal_words(body[at[d] : at[d + 1]].tobytes())
                sizes.append(len(own))
                if not own or made is None:
                    continue
                line = b" " + b" ".join(own) + b" "
                found = list(made.iter(line.decode("latin-1")))
                if found:
                    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                    last = np.searchsorted(gaps, [end for end, _ in found])
                    ranges = [(int(b) - size, int(b)) for b, (_, (size, _)) in zip(last, found, strict=True)]
                    earlier = [(x["begin"], x["end"]) for x in hits[d]]
                    hits[d] = [{"begin": a, "end": b} for a, b in _merged(ranges + earlier)]
                    items[d] = sorted({*items[d], *(i for _, (_, ids) in found for i in ids)})
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(sizes, pa.int64()),
                    pa.array(hits, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                    pa.array(items, pa.list_(pa.string())),
                ],
                ["row", "n_words", "hits", "items"],
            )

    return docs.mapInArrow(scan, docs.schema)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _offsets(place: int):
    """Word ranges as character ranges of the original text."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("row").field(place), []
            for text, hits in zip(texts.to_pylist(), batch.column("hits").to_pylist(), strict=True):
                places = [m.span() for m in _WORD.finditer(text)] if hits else []
                spans.append([{"begin": places[x["begin"]][0], "end": places[x["end"] - 1][1]} for x in hits])
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], [*names, "spans"])

    return locate


def _shards(benchmark: DataFrame, item_id: str, text: str, words: int) -> Iterator[list[tuple[bytes, list[str]]]]:
    """Windows with their items, in lists of about `SHARD_BYTES` bytes at most."""
    pairs = benchmark_windows(benchmark, item_id, text, words)
    windows = kept(pairs.groupBy("pattern").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    size = windows.agg(F.sum(F.length("pattern") + 20 * (1 + F.size("items")))).first()[0] or 0
    shards = -(-int(size) // SHARD_BYTES)
    part = windows.withColumn("shard", F.pmod(F.xxhash64("pattern"), F.lit(max(1, shards))))
    for shard in range(shards):
        yield [(bytes(r.pattern), list(r.items)) for r in part.filter(F.col("shard") == shard).select("pattern", F.col("items")).toLocalIterator()]


def _place(docs: DataFrame, text: str) -> int:
    """The number of a column, by Spark's own rules for names."""
    return docs.columns.index(text) if text in docs.columns else [x.lower() for x in docs.columns].index(text.lower())


def _scanned(
    docs: DataFrame, benchmark: DataFrame, text: str, item_id: str, item_text: str, words: int
) -> DataFrame:
    """row (all columns of the document), n_words, hits, items."""
    # the text is in the row alone, so that it is sent once
    place = _place(docs, text)
    small_batches(docs.sparkSession)
    found = docs.select(
        F.struct("*").alias("row"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("cast(array() as array<struct<begin: bigint, end: bigint>>)").alias("hits"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    passes = 0
    for windows in _shards(benchmark, item_id, item_text, words):
        found = _scan(windows, kept(found) if passes else found, place)
        passes += 1
    if not passes:
        found = _scan([], found, place)
    return found


def without_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    words: int = WINDOW_WORDS,
) -> DataFrame:
    """The documents without an occurring window; see `benchmark_hits`. Null texts stay."""
    return _scanned(docs, benchmark, text, item_id, item_text, words).filter(F.size("hits") == 0).select("row.*")


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    words: int = WINDOW_WORDS,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items, spans, contaminated.

    A window is `words` consecutive words of an item, or the whole of a shorter one. `n_hit`
    counts the document's words inside any occurrence of a window, `items` has the sorted ids,
    as strings, of the items with an occurring window, and `spans` the character ranges of
    `text` that are hit.

    A null or empty text, and one of punctuation only, has no words and no hits; such items
    have no windows. Items without id mark words but are not listed; an id on several rows
    counts once. Repeated documents stay. Without items nothing is hit; an empty table of
    documents gives an empty result. Other columns are not used.

    One automaton holds about `SHARD_BYTES` bytes of windows at most; a larger benchmark is
    scanned in several passes with a stored table between them.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = _scanned(docs, benchmark, "text", item_id, item_text, words)
    spans = T.StructType.fromDDL("spans array<struct<begin: bigint, end: bigint>>")
    located = found.mapInArrow(_offsets(_place(docs, "text")), T.StructType([*found.schema, *spans.fields]))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["begin"])
    return located.select(
        "row.doc_id", "n_words", n_hit.alias("n_hit"), "items", "spans", (F.size("hits") > 0).alias("contaminated")
    )


def hit_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document."""
    return benchmark_hits(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )
