"""Token ids on disk in bit-plane shuffled blocks.

Documents are put in ascending order by a range shuffle, and each task writes one file. A file
is a run of ids cut into blocks of a fixed number of ids. A block is transposed into planes,
the n-th byte (or bit) of all its ids, and each plane is compressed on its own with zstandard:
the high planes of ids hardly change. A chunk index at the end of the file says where each block
and plane lies, so a reader takes any range of ids from the blocks that hold it.

    file:   MAGIC, planes of block 0, planes of block 1, ..., index, tail
    index:  for each block: offset (u64), ids (u32), crc32 of the ids (u32), bytes of each plane (u32)
    tail:   offset of the index (u64), blocks (u32), planes (u32), MAGIC

A plane of zeros has no bytes. All numbers are little-endian.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.tables import kept, shared_folder, small_batches, small_side
from tallyline.llm.token_ids import VOCABULARY, token_ids
from tallyline.sources.folder import file_system

MAGIC = b"TKPLANE1"
BLOCK_IDS = 1 << 16
BYTE_PLANES, BIT_PLANES = 4, 32
END_ID = 0
LEVEL = 3
_TAIL = struct.Struct("<QII8s")


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """The byte planes (4) or bit planes (32) of ids, lowest first; a plane of zeros is empty."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, BYTE_PLANES).T
    if planes == BIT_PLANES:
        rows = [np.packbits((row >> bit) & 1) for row in rows for bit in range(8)]
    return [row.tobytes() if row.any() else b"" for row in rows]


def from_planes(planes: list[bytes], count: int) -> np.ndarray:
    """The ids of `to_planes`."""
    out = np.zeros((BYTE_PLANES, count), np.uint8)
    if len(planes) == BIT_PLANES:
        for k, plane in enumerate(planes):
            if plane:
                out[k // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=count) << (k % 8)
    else:
        for k, plane in enumerate(planes):
            if plane:
                out[k] = np.frombuffer(plane, np.uint8)
    return np.ascontiguousarray(out.T).view("<u4").ravel()


class TokenWriter:
    """Appends ids to an open file; holds one block."""

    def __init__(self, out, block: int = BLOCK_IDS, planes: int = BIT_PLANES):
        self.out, self.planes = out, planes
        self.block = np.zeros(block, "<u4")
        self.filled = self.written = 0
        self.entries: list[tuple] = []
        self.squeeze = zstandard.ZstdCompressor(level=LEVEL)
        self.at = out.write(MAGIC)

    def append(self, ids: np.ndarray) -> int:
        """Add ids; returns the place of the first one."""
        place = self.written
        self.written += len(ids)
        while len(ids):
            n = min(len(ids), len(self.block) - self.filled)
            self.block[self.filled : self.filled + n] = ids[:n]
            self.filled += n
            ids = ids[n:]
            if self.filled == len(self.block):
                self._flush()
        return place

    def _flush(self) -> None:
        ids = self.block[: self.filled]
        squeezed = [self.squeeze.compress(x) if x else b"" for x in to_planes(ids, self.planes)]
        self.entries.append((self.at, len(ids), zlib.crc32(ids.tobytes()), [len(x) for x in squeezed]))
        self.at += self.out.write(b"".join(squeezed))
        self.filled = 0

    def finish(self) -> None:
        """Write the last block and the chunk index."""
        if self.filled:
            self._flush()
        self.out.write(np.array(self.entries, _index_type(self.planes)).tobytes())
        self.out.write(_TAIL.pack(self.at, len(self.entries), self.planes, MAGIC))


class TokenReader:
    """Ranges of ids from an open file; holds the chunk index and one block."""

    def __init__(self, source, size: int):
        self.source = source
        at, blocks, planes, magic = _TAIL.unpack(source.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        kind = _index_type(planes)
        self.index = np.frombuffer(source.read_at(blocks * kind.itemsize, at), kind)
        self.ends = np.cumsum(self.index["ids"].astype(np.int64))
        self.expand = zstandard.ZstdDecompressor()
        self.held, self.ids = -1, np.zeros(0, "<u4")

    def read(self, place: int, count: int) -> Iterator[np.ndarray]:
        """The ids of a range, block by block."""
        while count > 0:
            k = int(np.searchsorted(self.ends, place, "right"))
            self._load(k)
            begin = place - int(self.ends[k]) + len(self.ids)
            part = self.ids[begin : begin + count]
            yield part
            place, count = place + len(part), count - len(part)

    def _load(self, k: int) -> None:
        if k == self.held:
            return
        entry = self.index[k]
        body = self.source.read_at(int(entry["bytes"].sum()), int(entry["offset"]))
        cuts = np.append(0, np.cumsum(entry["bytes"].astype(np.int64)))
        planes = [body[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        ids = from_planes([self.expand.decompress(x) if x else b"" for x in planes], int(entry["ids"]))
        if zlib.crc32(ids.tobytes()) != entry["crc"]:
            raise ValueError("a block of token ids is damaged")
        self.held, self.ids = k, ids


def _index_type(planes: int) -> np.dtype:
    return np.dtype([("offset", "<u8"), ("ids", "<u4"), ("crc", "<u4"), ("bytes", "<u4", (planes,))])


def write_token_files(
    docs: DataFrame,
    folder: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    block: int = BLOCK_IDS,
    planes: int = BIT_PLANES,
    vocabulary: str | None = None,
) -> DataFrame:
    """Write the ids of all documents and return where they lie: doc_id, start, n_tokens, file, place.

    A document's ids are those of its whole text and `end_id`. Documents are in ascending
    order of `doc_id` (null first, equal ones by a hash of the text); `start` counts the ids of
    all documents before, `place` those before it in its file. A null or empty text has its
    end id alone, repeated rows are written each for itself, an empty table writes nothing and
    other columns are not used.

    Files go to `folder` (a new one under `spark.checkpoint.dir` if not given) under names of
    their own, and the returned index is committed by Spark, so a repeated task leaves at most
    a file that the index does not name. A task holds the ids of one text, and one block.
    """
    small_batches(docs.sparkSession)
    folder = folder or shared_folder(docs.sparkSession)
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    ending = np.array([end_id], "<u4")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, writer = token_ids(path), TaskContext.get().partitionId(), None
        target, root = file_system(folder)
        name = f"{shard:08d}-{uuid.uuid4().hex}.tokens"
        out = None
        try:
            for batch in batches:
                if writer is None:
                    target.create_dir(root, recursive=True)
                    out = target.open_output_stream(f"{root}/{name}")
                    writer = TokenWriter(out, block, planes)
                places, counts = [], []
                for ids in encoder.column(batch.column(1)):
                    places.append(writer.append(ids))
                    writer.append(ending)
                    counts.append(len(ids) + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(places, pa.int64()), pa.array(counts, pa.int64()),
                     pa.array([name] * len(batch)), pa.array([shard] * len(batch), pa.int32())],
                    ["doc_id", "place", "n_tokens", "file", "shard"],
                )
            if writer:
                writer.finish()
        finally:
            if out is not None:
                out.close()

    kind = docs.schema[doc_id].dataType.simpleString()
    order = [F.asc_nulls_first("doc_id"), F.asc("tie")]
    ordered = (
        docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    rows = kept(
        ordered.select("doc_id", "text").mapInArrow(
            write, f"doc_id {kind}, place bigint, n_tokens bigint, file string, shard int"
        )
    )
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    return rows.join(small_side(kept(bases)), "shard").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", F.concat(F.lit(f"{folder}/"), "file").alias("file"), "place"
    )


def read_token_files(index: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the rows of an index, and with `with_ids` their `ids`.

    Only the blocks that hold a row's ids are read. `ids_crc32` is that of the ids as
    little-endian unsigned 32-bit integers, read from the file; a damaged block raises.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, reader, source = None, None, None
        for batch in batches:
            sums, bodies = [], []
            for name, place, count in zip(*(batch.column(x).to_pylist() for x in ("file", "place", "n_tokens")), strict=True):
                if name != opened:
                    if source is not None:
                        source.close()
                    target, file = file_system(name)
                    source = target.open_input_file(file)
                    opened, reader = name, TokenReader(source, source.size())
                crc, body = 0, []
                for part in reader.read(place, count):
                    crc = zlib.crc32(part.tobytes(), crc)
                    if with_ids:
                        body.append(part.astype(np.int64))
                sums.append(crc)
                bodies.append(np.concatenate(body) if body else None)
            columns = [batch.column(x) for x in ("doc_id", "start", "n_tokens")] + [pa.array(sums, pa.int64())]
            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(bodies, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        if source is not None:
            source.close()

    kind = index.schema["doc_id"].dataType.simpleString()
    ids = ", ids array<bigint>" if with_ids else ""
    return index.mapInArrow(read, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint{ids}")
