"""Repeated passages found in suffix order, removed everywhere or everywhere but first.

A passage is a string of `min_bytes` UTF-8 bytes. For a start position, the longest previous
factor is the longest match with an earlier position; among its neighbours in suffix order,
the previous and the next smaller position attain it. A later match is found alike.

Sorting all suffixes of a corpus in one place is impossible, so suffixes are first dealt out
such that equal passages meet: in every window of `min_bytes` bytes the least hash of a
`GRAM_BYTES`-byte string is its anchor, the same wherever the window occurs. Only windows whose
anchor occurs elsewhere can repeat; they go, with their text, to the bucket of that
anchor, where a suffix array is built by doubling and read off. An anchor that occurs very often
is dealt over several buckets; what stays single or extreme in its bucket meets the other
buckets' once more, by a hash of the window.

Documents with equal text are one class and take part once.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tables import kept, small_batches, small_side
from tallyline.llm.text_arrays import document_chunks, mixed, text_buffers

GRAM_BYTES = 32
SEGMENT = 1 << 17
BATCH_ANCHORS = 1 << 15
SIGNATURE_BYTES = 16  # of a sha256
BUCKET_CONTEXTS = 1024
HEAVY_ANCHOR = 1024
SALT_PLACES = 14
EARLIER, LATER, OPEN = 0, 1, 2
LAST = (1 << 63) - 1

_random = np.random.default_rng(88172645463325252)
_VALUE = _random.integers(1 << 62, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x2545F4914F6CDD1D
_PLACE = np.uint64((1 << 24) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % (1 << 64), np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


class _Winnower:
    """Anchors of all windows; the tables of powers grow to the longest segment seen."""

    def __init__(self, span: int):
        self.span = span
        self.gram = min(GRAM_BYTES, span)
        self.up = self.down = np.zeros(0, np.uint64)

    def owners(self, body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each start of a window: the place of its anchor; for each place: the gram hash."""
        n, k, w = len(body), self.gram, self.span - self.gram + 1
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[body] * self.up[:n], out=sums[1:])
        grams = mixed((sums[k:] - sums[:-k]) * self.down[: n - k + 1])
        ranked = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        pad = np.full(-len(ranked) % w + w, ~np.uint64(0))
        blocks = np.concatenate([ranked, pad]).reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = n - self.span + 1
        return (np.minimum(behind[:starts], ahead[w - 1 : w - 1 + starts]) & _PLACE).astype(np.int64), grams

    def steady(self, owner: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """Owners of one text where a window keeps its neighbour's anchor as long as it can.

        In a repetitive text the same gram is least again and again; any of its places in the
        window will do, as equal windows still have equal grams.
        """
        kept = grams[owner] & ~_PLACE
        moves = np.flatnonzero((np.diff(owner) != 0) & (np.diff(kept) == 0))
        if not len(moves):
            return owner
        owner, w = owner.copy(), self.span - self.gram + 1
        edges = np.flatnonzero(np.diff(kept)) + 1
        for run in np.unique(np.searchsorted(edges, moves, "right")).tolist():
            low = int(edges[run - 1]) if run else 0
            high = int(edges[run]) if run < len(edges) else len(owner)
            places = np.unique(owner[low:high])
            while low < high:
                place = int(places[np.searchsorted(places, low + w - 1, "right") - 1])
                owner[low : min(high, place + 1)] = place
                low = place + 1
        return owner

    def segments(self, body: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """A document in overlapping segments that together hold each window once."""
        for low in range(0, max(1, len(body) - self.span + 1), SEGMENT):
            part = body[low : low + SEGMENT + self.span - 1]
            if len(part) >= self.span:
                yield low, part


def document_anchors(docs: DataFrame, doc_id: str, text: str, span: int) -> DataFrame:
    """(doc_id, sig, n_bytes, sha256, anchors): anchors are packed pairs of place and hash."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = _Winnower(span)
        for batch in batches:
            body, at = text_buffers(batch.column(1))
            for low, high in document_chunks(at, SEGMENT):
                packed = _packed_anchors(winnower, body, at, low, high)
                digests = [sha256(memoryview(body[at[d] : at[d + 1]])).digest() for d in range(low, high)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(low, high - low),
                        "sig": pa.array([x[:SIGNATURE_BYTES] for x in digests], pa.binary()),
                        "n_bytes": pa.array(np.diff(at[low : high + 1])),
                        "sha256": pa.array([x.hex() for x in digests]),
                        "anchors": pa.array(packed, pa.binary()),
                    }
                )

    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text))
    return chosen.mapInArrow(scan, "doc_id bigint, sig binary, n_bytes bigint, sha256 string, anchors binary")


_ANCHOR = np.dtype([("place", "<i8"), ("hash", "<i8")])


def _packed_anchors(winnower: _Winnower, body: np.ndarray, at: np.ndarray, low: int, high: int) -> list[bytes]:
    """Packed anchors of each text; one that serves windows that may be equal is there twice."""
    if high == low + 1:  # perhaps a long one
        once, twice = [], []
        for begin, part in winnower.segments(body[at[low] : at[high]]):
            owner, grams = winnower.owners(part)
            places, merged = _served(winnower, owner, grams)
            once.append(_pairs(places + begin, grams[places]))
            twice.append(_pairs(merged + begin, grams[merged]))
        parts = [np.unique(np.concatenate(x)) for x in (once, twice) if x]
        return [b"".join(x.tobytes() for x in parts)]
    part, edges = body[at[low] : at[high]], at[low : high + 1] - at[low]
    if len(part) < winnower.span:
        return [b""] * (high - low)
    owner, grams = winnower.owners(part)
    out = []
    for k in range(high - low):
        own = grams[edges[k] :]
        places, merged = _served(winnower, owner[edges[k] : max(edges[k], edges[k + 1] - winnower.span + 1)] - edges[k], own)
        out.append(_pairs(places, own[places]).tobytes() + _pairs(merged, own[merged]).tobytes())
    return out


def _served(winnower: _Winnower, owner: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of a text, and those among them that took the place of several."""
    steady = winnower.steady(owner, grams)
    places = steady[np.flatnonzero(np.diff(steady, prepend=-1))]
    if steady is owner:
        return places, places[:0]
    return places, np.unique(steady[np.flatnonzero((np.diff(owner) != 0) & (np.diff(steady) == 0))])


def _pairs(places: np.ndarray, grams: np.ndarray) -> np.ndarray:
    pairs = np.empty(len(places), _ANCHOR)
    pairs["place"], pairs["hash"] = places, grams.view(np.int64)
    return pairs


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sigs, packed = batch.column(0), [np.frombuffer(x, _ANCHOR) for x in batch.column(1).to_pylist()]
        low = 0
        while low < len(packed):
            high, held = low, 0
            while high < len(packed) and (high == low or held < BATCH_ANCHORS):
                held += len(packed[high])
                high += 1
            flat = np.concatenate(packed[low:high])
            rows = np.repeat(np.arange(low, high), [len(x) for x in packed[low:high]])
            yield pa.RecordBatch.from_pydict(
                {"sig": sigs.take(pa.array(rows)), "place": pa.array(flat["place"].copy()), "hash": pa.array(flat["hash"].copy())}
            )
            low = high


def _contexts(span: int):
    """Text of the windows of each repeated anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = _Winnower(span)
        for batch in batches:
            body, at = text_buffers(batch.column("text"))
            first, sigs, anchors = (batch.column(x).to_pylist() for x in ("first_id", "sig", "repeated"))
            rows: list[tuple] = []
            for d in range(len(batch)):
                known = {x["place"]: (x["hash"], x["salts"]) for x in anchors[d]}
                spots = np.array(sorted(known))
                for begin, part in winnower.segments(body[at[d] : at[d + 1]]):
                    owner = winnower.steady(*winnower.owners(part))
                    good = np.isin(owner + begin, spots)
                    at_start = np.flatnonzero(good)
                    cuts = np.flatnonzero((np.diff(at_start) != 1) | (np.diff(owner[at_start]) != 0)) + 1
                    for run in np.split(at_start, cuts) if len(at_start) else ():
                        lo, hi = int(run[0]), int(run[-1])
                        gram, salts = known[int(owner[lo]) + begin]
                        salt = (int.from_bytes(sigs[d][:4], "little") + (lo + begin >> SALT_PLACES)) % salts
                        rows.append((gram, salt, salts > 1, sigs[d], first[d], lo + begin, part[lo : hi + span].tobytes()))
                    if len(rows) > 5000:
                        yield _context_batch(rows)
                        rows = []
            if rows:
                yield _context_batch(rows)

    return cut


_CONTEXT = "hash bigint, salt int, heavy boolean, sig binary, first_id bigint, place bigint, body binary"
_FOUND = "kind int, sig binary, first_id bigint, lo bigint, hi bigint, window binary"


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
    names = ("hash", "salt", "heavy", "sig", "first_id", "place", "body")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def suffix_ranks(body: np.ndarray, room: np.ndarray, span: int) -> np.ndarray:
    """Ranks, by doubling, of the suffixes with at least `span` bytes up to the end of their text.

    `room` is how many bytes each suffix has. Ranks of other suffixes are meaningless; those
    that are too short for a round take no part in it. Equal ranks mean equal first `span`
    bytes: the longest common prefix is at least `span`.
    """
    width = min(7, span)
    padded = np.concatenate([body.astype(np.int64) + 1, np.zeros(7, np.int64)])
    pair = np.zeros(len(body), np.int64)
    for k in range(width):
        pair = pair * 257 + padded[k : k + len(body)]
    rank = _dense(pair)
    while width < span:
        step = min(width, span - width)  # the last round overlaps: equal up to `width` both times
        width += step
        active = np.flatnonzero(room >= width)
        fresh = np.zeros(len(rank), np.int64)
        fresh[active] = _dense((rank[active] << 32) | rank[active + step])
        rank = fresh
    return rank


def _dense(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(np.concatenate([[1], np.diff(keys[order]) != 0])[: len(keys)])
    return ranks


def factor_limits(rank: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix, the first and the last text position of its run of equal ranks.

    In suffix order a run holds the suffixes that match for `span` bytes; put in text order, the
    previous and next smaller positions of a member lie in the run, and attain the longest
    previous and next factor. A member has an earlier match if it is not the first of the
    run, a later one if it is not the last. `least` and `most` are the text positions of
    the first and last of all copies that a suffix stands for.
    """
    order = np.argsort(rank, kind="stable")
    heads = np.flatnonzero(np.diff(rank[order], prepend=-1))
    run = np.empty(len(rank), np.int64)
    run[order] = np.cumsum(np.diff(rank[order], prepend=-1) != 0) - 1
    return np.minimum.reduceat(least[order], heads)[run], np.maximum.reduceat(most[order], heads)[run]


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for each of the counts, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _match_bucket(span: int):
    """Matches inside a bucket, a few anchors at a time: equal windows have equal anchors."""

    def match_all(group: pa.Table) -> pa.Table:
        hashes, salts = group.column("hash").to_numpy(), group.column("salt").to_numpy()
        order = np.lexsort((salts, hashes))
        fresh = np.flatnonzero((np.diff(hashes[order]) != 0) | (np.diff(salts[order]) != 0)) + 1
        out, low = [], 0
        for high in [*fresh[np.flatnonzero(np.diff(fresh // BUCKET_CONTEXTS, prepend=0))].tolist(), len(order)]:
            if high > low:
                out.append(match(group.take(pa.array(order[low:high]))))
                low = high
        return pa.concat_tables(out)

    def match(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sigs = group.column("sig").combine_chunks()
        first = group.column("first_id").fill_null(LAST).to_numpy()
        places = group.column("place").to_numpy()
        # equal contexts are one text; it stands for the first and the last of them
        distinct: dict[bytes, int] = {}
        text = np.array([distinct.setdefault(x, len(distinct)) for x in group.column("body").to_pylist()])
        _, sig_no = np.unique(np.array(sigs.to_pylist(), "V16"), return_inverse=True)
        order = np.empty(len(text), np.int64)
        order[np.lexsort((places, sig_no, first))] = np.arange(len(text))
        low, high = np.full(len(distinct), len(text)), np.zeros(len(distinct), np.int64)
        np.minimum.at(low, text, order)
        np.maximum.at(high, text, order)
        body = np.frombuffer(b"".join(distinct), np.uint8)
        sizes = np.array([len(x) for x in distinct])
        room = np.repeat(sizes, sizes) - _ranges(sizes)
        starts = np.flatnonzero(room >= span)
        windows = sizes - span + 1
        local, own = _ranges(windows), np.repeat(np.arange(len(sizes)), windows)
        least, most = factor_limits(
            suffix_ranks(body, room, span)[starts], (low[own] << 32) + local, (high[own] << 32) + local
        )
        # back to all contexts
        counts, begins = windows[text], np.cumsum(windows) - windows
        row, at = np.repeat(np.arange(len(text)), counts), _ranges(counts)
        window = np.repeat(begins[text], counts) + at
        position = (order[row] << 32) + at
        earlier, later = position > least[window], position < most[window]
        out = [
            _run_table(sigs, places, row, at, flags, kind) for kind, flags in ((EARLIER, earlier), (LATER, later))
        ]
        heavy = group.column("heavy").to_numpy()
        if heavy.any():
            names = group.column("sig").to_pylist()
            texts = list(distinct)
            extreme = np.flatnonzero(heavy[row] & ~(earlier & later))
            out.append(
                _found_table(
                    [
                        (OPEN, names[k], int(first[k]), int(places[k] + s), int(places[k] + s),
                         blake2b(texts[text[k]][s : s + span], digest_size=16).digest())
                        for k, s in zip(row[extreme].tolist(), at[extreme].tolist(), strict=True)
                    ]
                )
            )
        return pa.concat_tables(out)

    return match_all


def _run_table(sigs, places, row: np.ndarray, at: np.ndarray, flags: np.ndarray, kind: int) -> pa.Table:
    """Runs of flagged starts of each context."""
    edge = np.diff(row, prepend=-1) != 0
    begin = np.flatnonzero(flags & (edge | ~np.concatenate([[False], flags[:-1]])))
    end = np.flatnonzero(flags & (np.append(edge[1:], True) | ~np.append(flags[1:], False)))
    none = pa.nulls(len(begin))
    return pa.table(
        {
            "kind": pa.array(np.full(len(begin), kind, np.int32)),
            "sig": sigs.take(pa.array(row[begin])),
            "first_id": none.cast(pa.int64()),
            "lo": pa.array(places[row[begin]] + at[begin]),
            "hi": pa.array(places[row[end]] + at[end]),
            "window": none.cast(pa.binary()),
        }
    )


def _found_table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = list(zip(*rows, strict=True)) or [()] * 6
    names = ("kind", "sig", "first_id", "lo", "hi", "window")
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _match_open(group: pa.Table) -> pa.Table:
    """Windows left over in the buckets of one anchor, compared by their hashes."""
    sigs, places = group.column("sig").to_pylist(), group.column("lo").to_numpy()
    _, rank = np.unique(np.array(group.column("window").to_pylist(), "V16"), return_inverse=True)
    _, sig_no = np.unique(np.array(sigs, "V16"), return_inverse=True)
    order = np.empty(len(sigs), np.int64)
    order[np.lexsort((places, sig_no, group.column("first_id").to_numpy()))] = np.arange(len(sigs))
    least, most = factor_limits(rank, order, order)
    return _found_table(
        [
            (kind, sigs[k], None, int(places[k]), int(places[k]), None)
            for kind, flags in ((EARLIER, order > least), (LATER, order < most))
            for k in np.flatnonzero(flags)
        ]
    )


def _signature(text: str) -> Column:
    return F.substring(F.unhex(F.sha2(F.col(text), 256)), 1, SIGNATURE_BYTES)


def _class_texts(docs: DataFrame, doc_id: str, text: str, classes: DataFrame) -> DataFrame:
    """(sig, first_id, text) of the given classes, each once; other texts are not shuffled."""
    ids = small_side(classes.select(F.col("first_id").alias("_tallyline_wanted")).distinct())
    texts = docs.select(
        F.col(doc_id).cast("bigint").alias("first_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    texts = texts.join(ids, F.col("first_id").eqNullSafe(F.col("_tallyline_wanted")), "left_semi")
    texts = texts.withColumn("sig", _signature("text"))
    return texts.groupBy("sig").agg(F.first("text").alias("text")).join(classes, "sig")


def repeated_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_bytes: int = 200
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables (documents, classes, matches).

    documents: doc_id, sig, n_bytes, sha256 per row. classes: sig, rows, first_id, n_bytes.
    matches: sig, kind, lo, hi: starts lo..hi of a class's text where a passage begins that
    also begins earlier (kind 0) or later (kind 1) in the corpus, other copies of the same
    class left aside. Text order is the order of (first_id, sig, position).
    """
    small_batches(docs.sparkSession)
    scanned = kept(document_anchors(docs, doc_id, text, min_bytes))
    grouped = scanned.groupBy("sig").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("doc_id").alias("first_id"),
        F.first("n_bytes").alias("n_bytes"),
        F.first("anchors").alias("anchors"),
    )
    grouped = kept(grouped)
    occurrences = (
        grouped.filter(F.length("anchors") > 0)
        .select("sig", "anchors")
        .mapInArrow(_unpacked, "sig binary, place bigint, hash bigint")
    )
    counts = kept(occurrences.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    repeated = kept(occurrences.join(counts, "hash"))
    buckets = max(1, -(-repeated.count() // BUCKET_CONTEXTS))
    classes = grouped.drop("anchors")
    per_class = repeated.groupBy("sig").agg(
        F.collect_list(
            F.struct("place", "hash", F.ceil(F.col("n") / HEAVY_ANCHOR).cast("int").alias("salts"))
        ).alias("repeated")
    )
    chosen = kept(per_class.join(classes, "sig").select("sig", "first_id", "repeated"))
    contexts = _class_texts(docs, doc_id, text, chosen).mapInArrow(_contexts(min_bytes), _CONTEXT)
    dealt = contexts.withColumn("bucket", F.pmod(F.xxhash64("hash", "salt"), F.lit(buckets)))
    found = kept(dealt.groupBy("bucket").applyInArrow(_match_bucket(min_bytes), _FOUND))
    left = found.filter(F.col("kind") == OPEN)
    windows = left.withColumn("bucket", F.pmod(F.xxhash64("window"), F.lit(buckets)))
    joined = windows.groupBy("bucket").applyInArrow(_match_open, _FOUND)
    matches = found.filter(F.col("kind") != OPEN).unionByName(joined).select("sig", "kind", "lo", "hi")
    return scanned.drop("anchors"), classes, kept(matches)


def _spans(runs: list[dict], span: int, keep_first: bool) -> list[tuple[int, int]]:
    """The maximal byte ranges that the chosen starts cover."""
    out: list[list[int]] = []
    for low, high in sorted((x["lo"], x["hi"] + span) for x in runs if not keep_first or x["kind"] == EARLIER):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def _cutter(span: int, keep_first: bool, whole_characters: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sigs, runs = (batch.column(x).to_pylist() for x in ("text", "sig", "runs"))
            for sig, text, run in zip(sigs, texts, runs, strict=True):
                body = text.encode()
                spans = _spans(run, span, keep_first)
                if whole_characters:
                    spans = [x for x in (_whole(body, *s) for s in spans) if x[0] < x[1]]
                edges = [0, *(x for s in spans for x in s), len(body)]
                rest = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                yield pa.RecordBatch.from_pydict(
                    {
                        "sig": pa.array([sig], pa.binary()),
                        "n_spans": pa.array([len(spans)], pa.int64()),
                        "kept": pa.array([rest], pa.binary()),
                    }
                )

    return cut


def _whole(body: bytes, low: int, high: int) -> tuple[int, int]:
    """The part of a span that cuts no character."""
    while low < high and body[low] & 0xC0 == 0x80:
        low += 1
    while low < high < len(body) and body[high] & 0xC0 == 0x80:
        high -= 1
    return low, high


def cut_classes(
    docs: DataFrame, doc_id: str, text: str, classes: DataFrame, matches: DataFrame,
    min_bytes: int, keep_first: bool, whole_characters: bool,
) -> DataFrame:
    """(sig, n_spans, kept) of every class that loses a passage."""
    wanted = matches.filter(F.col("kind") == EARLIER) if keep_first else matches
    runs = wanted.groupBy("sig").agg(F.collect_list(F.struct("kind", "lo", "hi")).alias("runs"))
    chosen = kept(runs.join(classes, "sig").select("sig", "first_id", "runs"))
    texts = _class_texts(docs, doc_id, text, chosen)
    return texts.mapInArrow(_cutter(min_bytes, keep_first, whole_characters), "sig binary, n_spans bigint, kept binary")


def removal_digest(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_bytes: int = 200
) -> DataFrame:
    """What is left of each document when every repeated passage goes, first copies included.

    One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256. doc_id must be an
    integer column. A null text is empty. Texts shorter than `min_bytes` bytes lose nothing;
    repeated rows are copies of each other and lose everything if they are long enough. An
    empty table gives an empty result; other columns of the input are not used.
    """
    rows, classes, matches = repeated_passages(docs, doc_id, text, min_bytes)
    cut = cut_classes(docs, doc_id, text, classes.filter("rows = 1"), matches, min_bytes, False, False)
    alone = cut.select("sig", "n_spans", F.octet_length("kept").cast("bigint").alias("left"), F.sha2("kept", 256).alias("sha"))
    copies = classes.filter(f"rows > 1 and n_bytes >= {min_bytes}").select(
        "sig", F.lit(1).cast("bigint").alias("n_spans"), F.lit(0).cast("bigint").alias("left"),
        F.sha2(F.lit(b""), 256).alias("sha"),
    )
    changed = kept(alone.unionByName(copies))
    return rows.join(changed, "sig", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce(F.col("n_bytes") - F.col("left"), F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("sha", "sha256").alias("kept_sha256"),
    )


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_bytes: int = 200
) -> DataFrame:
    """The documents with every later copy of a passage cut out of `text`; the first one stays.

    All columns and rows stay, but for the changed texts. Of documents with equal text of at
    least `min_bytes` bytes the one with the smallest doc_id keeps its text and the others
    become empty; repeated rows of one doc_id and text count as one document. Spans are cut at
    character borders. Null and short texts stay as they are.
    """
    _, classes, matches = repeated_passages(docs, doc_id, text, min_bytes)
    cut = kept(cut_classes(docs, doc_id, text, classes, matches, min_bytes, True, True))
    copied = classes.filter(f"rows > 1 and n_bytes >= {min_bytes}").select("sig", "first_id")
    changed = (
        cut.select("sig", F.col("kept").cast("string").alias("_tallyline_text"))
        .join(classes.select("sig", F.col("first_id")), "sig")
        .join(copied.select("sig", F.lit(True).alias("_tallyline_copied")), "sig", "left")
        .unionByName(
            copied.join(cut, "sig", "left_anti").select(
                "sig", F.lit(None).cast("string").alias("_tallyline_text"), "first_id", F.lit(True).alias("_tallyline_copied")
            )
        )
    )
    sig = _signature(text)
    marks = kept(changed.withColumnRenamed("sig", "_tallyline_sig").withColumnRenamed("first_id", "_tallyline_first"))
    touched = small_side(marks.select("_tallyline_sig"))
    named = docs.withColumn("_tallyline_key", sig)
    same = named.join(touched, F.col("_tallyline_key") == F.col("_tallyline_sig"), "left_anti")
    other = named.join(touched, F.col("_tallyline_key") == F.col("_tallyline_sig"), "left_semi").join(marks, F.col("_tallyline_key") == F.col("_tallyline_sig"))
    first = F.col(doc_id).cast("bigint").eqNullSafe(F.col("_tallyline_first"))
    body = F.when(F.coalesce("_tallyline_copied", F.lit(False)) & ~first, F.lit("")).otherwise(F.coalesce("_tallyline_text", F.col(text)))
    return same.select(*docs.columns).unionByName(other.withColumn(text, body).select(*docs.columns))
