"""Similarity join of documents by the Jaccard index of their word n-grams.

The document by n-gram incidence matrix is multiplied with its transpose block by block: an
n-gram (a column) brings the documents together that hold it, and sizes bound which columns
and pairs can matter.

* Documents with equal n-gram sets are one class; classes stand for their members.
* Two sets of a and b n-grams with index >= t overlap in at least t / (1 + t) * (a + b), so
  with k = min(3, ceil(t * a)) only the first a - ceil(t * a) + k n-grams of a set, in an order
  that puts rare ones first, need columns, and a pair shares at least k of them. The order
  comes from a count table of fixed size over all documents.
* At places i and j of the first shared column the overlap is at most 1 + min(a - i - 1, b - j - 1);
  a pair that no column allows so much is discarded. The m-th shared one allows m - 1 more.
* Columns of few classes are multiplied out and overlaps added up; pairs that share k of them, or
  fewer where both have columns of many classes, stay. A column of many classes is first met
  with one of its members only, the one with the fewest rarer n-grams. Pairs of that column
  whose classes are connected by then are not needed; the others are taken up in a second
  product. The first shared column of a pair is of one kind or the other, so no link between
  components is lost.
* The remaining pairs get their exact overlap from the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.components import connected_components
from tallyline.llm.tables import kept, small_batches, small_side
from tallyline.llm.text_arrays import shingle_sets

BATCH_GRAMS = 1 << 17
SKETCH_BITS = 23
SKETCH_BLOCK = 1 << 17
LIGHT_COLUMN = 32
SHARED_COLUMNS = 3
COLUMN_SHIFT = 16
SIGNATURE_BYTES = 10


def _id_type(docs: DataFrame, doc_id: str) -> str:
    return docs.schema[doc_id].dataType.simpleString()


def gram_levels(docs: DataFrame, text: str, words: int) -> bytes:
    """How often n-grams occur: one byte per hash bucket, eight steps to a doubling.

    The table has 2 ** SKETCH_BITS bytes whatever the input. Tasks send their counts in blocks,
    which are added up in two rounds.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for _, grams in shingle_sets(batch.column(0), words):
                np.add.at(total, (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        if total.any():
            small = np.minimum(total, 255).astype(np.uint8)  # more in one task is frequent anyway
            yield from _blocks(dict(enumerate(small.reshape(-1, SKETCH_BLOCK))))

    def summed(kind: type, level: bool):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    counts = np.frombuffer(zlib.decompress(packed), kind).astype(np.int64)
                    total[block] = total[block] + counts if block in total else counts
            yield from _blocks({k: _level(x) if level else x for k, x in total.items()})

        return add

    schema = "block int, counts binary"
    parts = docs.select(text).mapInArrow(count, schema)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("counts"), F.lit(4)))
    sums = salted.repartition("block", "salt").select("block", "counts").mapInArrow(summed(np.uint8, False), schema)
    levels = sums.repartition("block").mapInArrow(summed(np.int64, True), schema)
    table = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCK * SKETCH_BLOCK, np.uint8).reshape(-1, SKETCH_BLOCK)
    for row in levels.collect():  # 2 ** SKETCH_BITS bytes whatever the input
        table[row.block] = np.frombuffer(zlib.decompress(row.counts), np.uint8)
    return table.tobytes()


def _level(counts: np.ndarray) -> np.ndarray:
    return np.minimum(255, 8 * np.log2(1 + counts)).astype(np.uint8)


def _blocks(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for block, counts in total.items():
        packed = zlib.compress(counts.tobytes(), 1)
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array([block], pa.int32()), "counts": pa.array([packed], pa.binary())}
        )


def gram_sets(
    docs: DataFrame, doc_id: str, text: str, words: int, ratio: tuple[int, int] | None, levels: bytes = b""
) -> DataFrame:
    """(doc_id, text_key, sig, n, grams): with a ratio the columns the set needs, else the whole set."""
    broadcast = docs.sparkSession.sparkContext.broadcast(levels)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(broadcast.value, np.uint8)
        for batch in batches:
            rows, sigs, sizes, lists, held = [], [], [], [], 0
            for row, grams in shingle_sets(batch.column(2), words):
                size = len(grams)
                sigs.append(blake2b(grams.tobytes(), digest_size=SIGNATURE_BYTES).digest())
                if ratio and size:
                    steps = level[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    grams = grams[np.argsort(steps, kind="stable")]
                    overlap = -(-size * ratio[0] // ratio[1])
                    grams = grams[: size - overlap + min(SHARED_COLUMNS, overlap)] >> np.uint64(COLUMN_SHIFT)
                rows.append(row)
                sizes.append(size)
                lists.append(grams.view(np.int64))
                held += len(grams)
                if held > BATCH_GRAMS:
                    yield _set_batch(batch, rows, sigs, sizes, lists)
                    rows, sigs, sizes, lists, held = [], [], [], [], 0
            if rows:
                yield _set_batch(batch, rows, sigs, sizes, lists)

    kind = _id_type(docs, doc_id)
    schema = f"doc_id {kind}, text_key bigint, sig binary, n bigint, grams array<bigint>"
    key = F.xxhash64(F.col(text)).alias("text_key")
    return docs.select(F.col(doc_id).alias("doc_id"), key, F.col(text)).mapInArrow(sets, schema)


def _set_batch(batch, rows, sigs, sizes, lists) -> pa.RecordBatch:
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": batch.column(0).take(pa.array(rows)),
            "text_key": batch.column(1).take(pa.array(rows)),
            "sig": pa.array(sigs, pa.binary()),
            "n": pa.array(sizes, pa.int64()),
            "grams": pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(lists))),
        }
    )


def _may_link(a: str, b: str, num: int, den: int, shared: int = 1) -> str:
    """SQL: the size bounds of two postings of one column, the pair's `shared`-th or an earlier one."""
    least = f"{num} * ({a}.n + {b}.n)"
    return (
        f"{den} * {a}.n >= {num} * {b}.n and {den} * {b}.n >= {num} * {a}.n and "
        f"{num + den} * ({shared} + least({a}.n - {a}.pos - 1, {b}.n - {b}.pos - 1)) >= {least}"
    )


def _verified(
    docs: DataFrame, doc_id: str, text: str, words: int, pairs: DataFrame, some: DataFrame, num: int, den: int
) -> DataFrame:
    """The pairs (a, b) of signatures whose whole sets reach the ratio."""
    full = _whole_sets(docs, doc_id, text, words, some, pairs)
    left = full.select(F.col("sig").alias("a"), F.col("grams").alias("x"))
    right = full.select(F.col("sig").alias("b"), F.col("grams").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("shared", both)
        .filter(f"{den} * shared >= {num} * (size(x) + size(y) - shared)")
        .select("a", "b")
    )


def jaccard_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    ratio: tuple[int, int] = (4, 5),
) -> DataFrame:
    """One row per document: doc_id, text_key, sig, n_shingles, component_id, component_key.

    Documents are linked when the Jaccard index of their `words`-word shingles is at least
    `ratio` (numerator, denominator). `component_id` is the smallest doc_id reachable by links
    and `component_key` names the component (null without shingles); `text_key` is a hash of
    the text.
    Lower-case ASCII, words between ASCII white space, whole texts.

    Null and empty texts, and texts of white space, have no shingles and link with nothing.
    Texts of fewer words count as one shingle. Repeated rows stay, in one component. A null
    doc_id stays; its component is the smallest doc_id that is not null, or null. An empty
    table gives an empty result. Other columns of the input are not used.
    """
    num, den = ratio
    small_batches(docs.sparkSession)
    levels = gram_levels(docs, text, words)
    sets = kept(gram_sets(docs, doc_id, text, words, ratio, levels))
    some = sets.filter("n > 0")
    classes = some.groupBy("sig").agg(
        F.first("n").alias("n"), F.first("grams").alias("grams"), F.min("doc_id").alias("doc_id")
    )
    postings = classes.select("sig", "n", F.posexplode("grams").alias("pos", "gram"))
    columns = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    live = kept(postings.join(columns, "gram"))
    light = live.filter(F.col("df") <= LIGHT_COLUMN)
    heavy = live.filter(F.col("df") > LIGHT_COLUMN)
    leaders = heavy.groupBy("gram").agg(F.min(F.struct("pos", "n", "sig")).alias("leader"))
    heavy = kept(heavy.join(leaders, "gram"))
    bound = _may_link("l", "r", num, den)
    enough = F.expr(f"least({SHARED_COLUMNS}, cast(ceil({num} * least(a_n, b_n) / {den}) as bigint))")
    among_first = _may_link("l", "r", num, den, SHARED_COLUMNS)
    met = kept(
        light.alias("l")
        .join(light.alias("r"), F.expr(f"l.gram = r.gram and l.sig < r.sig and {among_first}"))
        .groupBy(F.col("l.sig").alias("a"), F.col("r.sig").alias("b"))
        .agg(
            F.count(F.lit(1)).alias("shared"),
            F.bool_or(F.expr(bound)).alias("first"),
            F.first("l.n").alias("a_n"),
            F.first("r.n").alias("b_n"),
        )
        .filter("first")
        .select("a", "b", (F.col("shared") >= enough).alias("enough"))
    )
    # with fewer light columns, a pair shares heavy ones too
    crowded = heavy.select("sig").distinct()
    few = met.filter("not enough")
    few = few.join(crowded.withColumnRenamed("sig", "a"), "a", "left_semi").join(crowded.withColumnRenamed("sig", "b"), "b", "left_semi")
    met = met.filter("enough").drop("enough").unionByName(few.select("a", "b"))
    star = (
        heavy.alias("l")
        .select("l.*", F.expr("leader as r"))
        .filter(F.expr(f"sig <> r.sig and {among_first}".replace("l.", "")))
        .groupBy(F.least("sig", "r.sig").alias("a"), F.greatest("sig", "r.sig").alias("b"))
        .agg(F.count(F.lit(1)).alias("shared"), F.bool_or(F.expr(bound.replace("l.", ""))).alias("first"))
        .filter("first and shared > 1")  # only a head start: the second product misses nothing
        .select("a", "b")
    )
    pairs = kept(met.unionByName(star).distinct())
    links = kept(_verified(docs, doc_id, text, words, pairs, some, num, den))
    parts = connected_components(links, "a", "b")
    apart = kept(_apart(heavy, parts, bound).join(pairs, ["a", "b"], "left_anti").distinct())
    if apart.isEmpty():
        return _members(sets, parts)
    more = kept(_verified(docs, doc_id, text, words, apart, some, num, den))
    if not more.isEmpty():
        parts = connected_components(links.unionByName(more), "a", "b")
    return _members(sets, parts)


def _whole_sets(
    docs: DataFrame, doc_id: str, text: str, words: int, some: DataFrame, pairs: DataFrame
) -> DataFrame:
    """The whole sets of the classes in the pairs, computed again from their texts."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    one = some.join(wanted, "sig", "left_semi").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    one = kept(one)
    ids = small_side(one.select(F.col("doc_id").alias("_wanted")).distinct())
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    texts = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_wanted")), "left_semi")
    full = gram_sets(texts, "doc_id", "text", words, None).join(one.select("sig"), "sig", "left_semi")
    return kept(full.groupBy("sig").agg(F.first("grams").alias("grams")))


def _apart(heavy: DataFrame, parts: DataFrame, bound: str) -> DataFrame:
    """Pairs of heavy columns that no component joins yet."""
    label = parts.select(F.col("node").alias("sig"), F.col("component").alias("part"))
    leaders = label.select(F.col("sig").alias("_leader"), F.col("part").alias("_part"))
    labelled = (
        heavy.join(label, "sig", "left")
        .withColumn("part", F.coalesce("part", "sig"))
        .withColumn("_leader", F.col("leader.sig"))
        .join(leaders, "_leader", "left")
        .withColumn("_part", F.coalesce("_part", "_leader"))
        .select("gram", "sig", "n", "pos", "part", "_part")
    )
    labelled = kept(labelled)
    strays = labelled.filter("part <> _part")
    return (
        strays.alias("l")
        .join(labelled.alias("r"), F.expr(f"l.gram = r.gram and l.part <> r.part and {bound}"))
        .select(F.least("l.sig", "r.sig").alias("a"), F.greatest("l.sig", "r.sig").alias("b"))
    )


def _members(sets: DataFrame, parts: DataFrame) -> DataFrame:
    """Every document with the smallest doc_id of its component."""
    classes = sets.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    placed = classes.join(parts, F.col("sig") == F.col("node"), "left").withColumn(
        "part", F.coalesce("component", "sig")
    )
    heads = placed.groupBy("part").agg(F.min("least").alias("component_id"), F.sum("copies").alias("rows"))
    grouped = placed.select("sig", "part").join(heads.filter("rows > 1"), "part")
    # stored first, so that the join can split the documents of one signature
    named = kept(grouped.select("sig", "part", "component_id"))
    return sets.join(named, "sig", "left").select(
        "doc_id",
        "text_key",
        "sig",
        F.col("n").alias("n_shingles"),
        F.when(F.col("part").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("part", F.when(F.col("n") > 0, F.col("sig"))).alias("component_key"),
    )


def one_of_each_group(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    ratio: tuple[int, int] = (4, 5),
) -> DataFrame:
    """The documents, but of each group of `jaccard_groups` only the one with the smallest doc_id.

    Equal ids are told apart by their texts and repeated rows become one. Documents without
    shingles all stay. All columns stay.
    """
    rows = kept(jaccard_groups(docs, doc_id, text, words, ratio))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    groups = (
        rows.filter(F.col("component_key").isNotNull())
        .groupBy("component_key")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
    )
    members = rows.join(groups, "component_key").select(
        F.col("doc_id").alias("_tallyline_id"),
        F.col("text_key").alias("_tallyline_key"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))).alias("_tallyline_first"),
    )
    members = kept(members.groupBy("_tallyline_id", "_tallyline_key").agg(F.first("_tallyline_first").alias("_tallyline_first"), F.count(F.lit(1)).alias("_tallyline_rows")))
    same = F.col(doc_id).eqNullSafe(F.col("_tallyline_id")) & (F.xxhash64(F.col(text)) == F.col("_tallyline_key"))
    others = small_side(members.filter("not _tallyline_first"))
    repeated = members.filter("_tallyline_first and _tallyline_rows > 1")
    left = docs.join(others, same, "left_anti")
    if repeated.isEmpty():
        return left
    again = small_side(repeated)
    single = left.join(again, same, "left_semi").withColumn("_tallyline_key", F.xxhash64(F.col(text)))
    single = single.dropDuplicates([doc_id, "_tallyline_key"]).drop("_tallyline_key")
    return left.join(again, same, "left_anti").unionByName(single)
