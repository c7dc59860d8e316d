"""Languages of a document as a mixture, by expectation-maximisation.

Each language has a trigram model over the lower-cased letters of words. A word has one
likelihood per language; a document is a mixture of languages with unknown proportions, which
expectation-maximisation estimates from its words. Languages are then dropped from the mixture,
the smallest first, as long as the penalised likelihood (half a logarithm of the number of
words for each proportion) does not fall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.tables import small_batches
from tallyline.llm.text_arrays import LOWER, document_chunks, text_buffers

TRIGRAM_BITS = 18
TRAIN_DOCUMENTS = 4000
MAX_LANGUAGES = 256
SMOOTHING = 2.0
ROUNDS = 12
UNKNOWN = "und"
CHUNK = 1 << 17
_PREDICTED = "lang_pred string, score double, languages array<struct<lang: string, share: double>>"

_LETTER = np.zeros(256, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)
_MIX = np.uint32(2654435761)


def _symbols(body: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets, their last letters, first trigrams of words, and documents of words.

    A word is a run of ASCII letters and characters beyond ASCII, with one mark for its end.
    """
    docs = len(edges) - 1
    lengths = np.diff(edges)
    line = np.zeros(len(body) + docs + 2, np.uint8)
    doc = np.repeat(np.arange(docs), lengths)
    line[np.arange(len(body)) + doc + 2] = _LETTER[body]
    now, last, before = line[2:], line[1:-1], line[:-2]
    used = np.flatnonzero(now | last)
    now, last = now[used], last[used]
    before = np.where(last > 0, before[used], 0)
    context = before.astype(np.uint32) << np.uint32(8) | last
    bucket = ((context << np.uint32(8) | now) * _MIX) >> np.uint32(32 - TRIGRAM_BITS)
    first = np.flatnonzero(last == 0)
    word_doc = np.searchsorted(edges[1:] + np.arange(1, docs + 1), used[first], "right")
    return bucket.astype(np.int64), context.astype(np.int64) << 8 | now, first, word_doc


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram and context counts of each language in a task, as (language, kind, keys, counts)."""
    totals: dict[str, list[np.ndarray]] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for lang in set(langs):
            own = batch.column(1).filter(pa.array(langs == lang))
            body, at = text_buffers(own)
            total = totals.setdefault(lang, [np.zeros(1 << TRIGRAM_BITS, np.int64), np.zeros(1 << 16, np.int64), np.zeros(256, np.int64)])
            for low, high in document_chunks(at, CHUNK):
                bucket, gram, _, _ = _symbols(body[at[low] : at[high]], at[low : high + 1] - at[low])
                total[0] += np.bincount(bucket, minlength=1 << TRIGRAM_BITS)
                total[1] += np.bincount(gram >> 8, minlength=1 << 16)
                total[2] += np.bincount(gram & 255, minlength=256)
    for lang, kinds in totals.items():
        for kind, counts in enumerate(kinds):
            keys = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [lang],
                    "kind": pa.array([kind], pa.int32()),
                    "keys": pa.array([keys.astype(np.int32).tobytes()], pa.binary()),
                    "counts": pa.array([counts[keys].tobytes()], pa.binary()),
                }
            )


def learn(
    docs: DataFrame, lang: str, text: str, sample_key: Column, train_documents: int = TRAIN_DOCUMENTS
) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Trigram, context and letter counts of each language.

    The model is fitted on a sample of about `train_documents` documents of each language (all
    if there are fewer), chosen by a hash of `sample_key`, and at most the `MAX_LANGUAGES` most
    frequent languages. What reaches the driver is bounded by these two numbers.
    """
    small_batches(docs.sparkSession)
    labelled = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), sample_key.alias("key"))
    labelled = labelled.filter("lang is not null and text is not null")
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not sizes:
        return {}
    rate = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, train_documents / r["count"]))])
    share = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / (1 << 20)
    sample = labelled.filter(share < F.coalesce(F.try_element_at(rate, F.col("lang")), F.lit(0.0)))
    counted = sample.repartition(8, "key").select("lang", "text").mapInArrow(
        _count, "lang string, kind int, keys binary, counts binary"
    )
    model: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for row in counted.collect():
        kinds = model.setdefault(
            row.lang, (np.zeros(1 << TRIGRAM_BITS), np.zeros(1 << 16), np.zeros(256))
        )
        kinds[row.kind][np.frombuffer(row["keys"], np.int32)] += np.frombuffer(row.counts, np.int64)
    return {x: model[x] for x in sorted(model)}


def _tables(model: dict) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language names, and trigram, context and letter tables with a column for each language."""
    names = list(model)
    grams = np.stack([model[x][0] for x in names], 1).astype(np.float32)
    contexts = np.stack([model[x][1] for x in names], 1).astype(np.float32)
    letters = np.stack([model[x][2] + 0.5 for x in names], 1)
    return names, grams, contexts, (letters / letters.sum(0)).astype(np.float32)


def word_likelihoods(body: np.ndarray, edges: np.ndarray, tables: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(words x languages) log-likelihoods, and the document of each word."""
    _, grams, contexts, letters = tables
    bucket, gram, first, word_doc = _symbols(body, edges)
    if not len(first):
        return np.zeros((0, letters.shape[1]), np.float32), word_doc
    scores = (grams[bucket] + SMOOTHING * letters[gram & 255]) / (contexts[gram >> 8] + SMOOTHING)
    np.minimum(scores, 1, out=scores)
    return np.add.reduceat(np.log(scores), first, axis=0), word_doc


def _fit(odds: np.ndarray, starts: np.ndarray, doc: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document; `odds` are word likelihoods up to a factor."""
    words = np.diff(np.append(starts, len(odds)))[:, None]
    for _ in range(ROUNDS):
        part = odds * share[doc]
        total = part.sum(1, keepdims=True)
        share = np.add.reduceat(part / total, starts, axis=0) / words
    total = (odds * share[doc]).sum(1)
    return share, np.add.reduceat(np.log(total), starts)


def mixtures(likelihood: np.ndarray, word_doc: np.ndarray, docs: int) -> np.ndarray:
    """(documents x languages) proportions after the selection; zero rows where no words are."""
    shares = np.zeros((docs, likelihood.shape[1]))
    present, starts = np.unique(word_doc, return_index=True)
    if not len(present):
        return shares
    doc = np.searchsorted(present, word_doc)
    odds = np.exp(np.maximum(likelihood - likelihood.max(1, keepdims=True), -60).astype(np.float64))
    words = np.diff(np.append(starts, len(odds)))
    share, value = _fit(odds, starts, doc, np.full((len(present), odds.shape[1]), 1 / odds.shape[1]))
    open_docs = np.arange(len(present))
    while len(open_docs):
        open_docs = open_docs[(share[open_docs] > 0).sum(1) > 1]
        if not len(open_docs):
            break
        mine = np.isin(doc, open_docs)
        sub = np.searchsorted(open_docs, doc[mine])
        begin = np.searchsorted(sub, np.arange(len(open_docs)))
        trial = share[open_docs].copy()
        trial[np.arange(len(trial)), np.where(trial > 0, trial, 2).argmin(1)] = 0
        trial[trial < 1e-9] = 0
        trial /= trial.sum(1, keepdims=True)
        fitted, reached = _fit(odds[mine], begin, sub, trial)
        dropped = (share[open_docs] > 0).sum(1) - (fitted > 0).sum(1)
        better = reached + 0.5 * dropped * np.log(words[open_docs] + 1) >= value[open_docs]
        share[open_docs[better]], value[open_docs[better]] = fitted[better], reached[better]
        open_docs = open_docs[better]
    shares[present] = share
    return shares


def _predictor(shared, text: str):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(shared.value) if shared.value else None
        for batch in batches:
            rows = batch.column("row")
            body, at = text_buffers(rows.field(rows.type.get_field_index(text)))
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            for low, high in document_chunks(at, CHUNK):
                shares = np.zeros((high - low, 1))
                if tables:
                    part = body[at[low] : at[high]]
                    shares = _shares(part, at[low : high + 1] - at[low], tables)
                best = shares.argmax(1)
                known = lettered[low:high] & (shares.max(1) > 0)
                names = [tables[0][b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                score = np.where(known, np.clip(shares.max(1), 0, 1), 0.0)
                mixed = [
                    [{"lang": tables[0][j], "share": float(s[j])} for j in np.argsort(-s, kind="stable") if s[j] > 0] if k else []
                    for s, k in zip(shares, known, strict=True)
                ]
                kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(low, high - low), pa.array(names, pa.string()), pa.array(score), pa.array(mixed, kind)],
                    ["row", "lang_pred", "score", "languages"],
                )

    return predict


def _shares(body: np.ndarray, edges: np.ndarray, tables: tuple) -> np.ndarray:
    if len(edges) > 2 or len(body) <= 4 * CHUNK:
        return mixtures(*word_likelihoods(body, edges, tables), len(edges) - 1)
    parts, low = [], 0
    while low < len(body):  # a very long document, cut between words
        high = low + CHUNK
        while high < len(body) and _LETTER[body[high]]:
            high += 1
        parts.append(word_likelihoods(body[low:high], np.array([0, len(body[low:high])]), tables)[0])
        low = high
    whole = np.concatenate(parts)
    return mixtures(whole, np.zeros(len(whole), np.int64), 1)


def with_languages(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """row (a struct of all columns of the document), lang_pred, score, languages.

    `lang_pred` is the language with the largest proportion, `score` that proportion, and
    `languages` the selected set with proportions, largest first. Where the text is null, empty
    or without a letter, or nothing has been learned, it is `und` with score 0 and an empty
    set. Whole texts are read; ties go to the first language by name. Repeated rows stay; an
    empty table gives an empty result; no other column, labels among them, is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = F.coalesce(F.col(text), F.lit(""))
    small_batches(docs.sparkSession)
    # the text is in the row alone, so that it is sent once
    rows = docs.select(F.struct("*").alias("row"), body.rlike(r"\p{L}").alias("lettered"))
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(_PREDICTED).fields])
    return rows.mapInArrow(_predictor(shared, text), schema)


def fold_model(docs: DataFrame) -> dict:
    """Learn from documents whose crc32 of the decimal doc_id does not leave 2 by 4."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return learn(docs.filter(fold != 2), "lang", "text", F.col("doc_id"))


def learn_and_predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages of `documents`.

    Documents whose crc32 of the decimal doc_id leaves 2 when divided by 4 are held out of
    learning; a null doc_id is not held out and not learned from.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = fold_model(docs)
    found = with_languages(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", "lang_pred", "score", "languages").select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "languages"
    )
