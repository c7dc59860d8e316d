"""Toxicity from a learned lexicon that also catches misspelled terms.

Terms are words, or stems with many endings, that stand out in documents labelled toxic. They
form a trie, which is intersected with the Levenshtein automaton of edit distance one: a state
is the set of trie nodes reachable with the edits spent so far, and its transitions are
worked out once and kept. Every word of a text runs through it; words and stems may have the
edit in any letter, the first one too. A word that clean documents use is not a misspelling,
however near to a term it is. A hit between quotation marks
counts as quoted, others as abuse; a logistic model weighs both.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOXIC_SAMPLE, CLEAN_SAMPLE = 4000, 12_000
MAX_TERMS = 5000
MIN_SUPPORT, MIN_LIFT = 5, 20.0
MIN_LETTERS, MAX_LETTERS = 3, 14
FUZZY_LETTERS = 4
MAX_KNOWN = 200_000
QUOTE_REACH = 80
CACHE = 300_000

NONE, EXACT, STEM, FUZZY = range(4)
# Characters written for letters, and pairs of quotation marks.
DISGUISES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""})
OPENING, CLOSING = "\"“„«‘‹", "\"”“»’›"

_TOKEN = re.compile(r"[\w@$*!]+")


def undisguised(token: str) -> str:
    """The token without marks at its ends, with letters for the characters written for them."""
    token = token.strip("!*")
    return token if token.isalpha() else token.translate(DISGUISES)


class Lexicon:
    """A trie of words and stems, and its states with edits, made when first met.

    Without `any_letter` the first letter of a term must be right. `known` are words that are
    no misspellings.
    """

    def __init__(self, words: list[str], stems: list[str], any_letter: bool = False, known: list[str] = ()):
        self.children: list[dict[str, int]] = [{}]
        self.depth = [0]
        self.word: set[int] = set()
        self.stem: set[int] = set()
        for terms, ends in ((words, self.word), (stems, self.stem)):
            for term in terms:
                node = 0
                for letter in term:
                    if letter not in self.children[node]:
                        self.children[node][letter] = len(self.children)
                        self.children.append({})
                        self.depth.append(self.depth[node] + 1)
                    node = self.children[node][letter]
                ends.add(node)
        self.fuzzy = {x for x in self.word if self.depth[x] >= FUZZY_LETTERS}
        self.fuzzy_stem = {x for x in self.stem if self.depth[x] >= FUZZY_LETTERS}
        self.any_letter, self.known = any_letter, frozenset(known)
        missing = [(x, 1) for x in self.children[0].values()] if any_letter else []
        self.start = frozenset([(0, 0), *missing])
        self.steps: dict[tuple[frozenset, str], frozenset] = {}

    def step(self, state: frozenset, letter: str) -> frozenset:
        """States are sets of (node, edits)."""
        key = (state, letter)
        if key in self.steps:
            return self.steps[key]
        least: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if least.get(node, 2) > edits:
                least[node] = edits
                if edits == 0 and node:
                    for below in self.children[node].values():
                        reach(below, 1)  # a letter of the term is missing

        for node, edits in state:
            after = self.children[node]
            if letter in after:
                reach(after[letter], edits)
            if edits == 0 and (node or self.any_letter):
                reach(node, 1)  # a letter too many
                for below in after.values():
                    reach(below, 1)  # a wrong letter
        found = frozenset(least.items())
        if len(self.steps) < 2_000_000:
            self.steps[key] = found
        return found

    def kind(self, token: str) -> int:
        """EXACT or STEM if the token is a word or begins with a stem, FUZZY if it does so with one edit."""
        token = undisguised(token)
        fuzzy = NONE if token in self.known else FUZZY
        state, near = self.start, NONE
        for letter in token:
            state = self.step(state, letter)
            if not state:
                return near
            if self.stem:
                if any(e == 0 and n in self.stem for n, e in state):
                    return STEM
                if not near and any(n in self.fuzzy_stem for n, _ in state):
                    near = fuzzy
        if any(e == 0 and n in self.word for n, e in state):
            return EXACT
        return fuzzy if any(n in self.fuzzy for n, _ in state) else near


class _Kinds(dict):
    """Kinds of the words met lately."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        found = self[token] = self.lexicon.kind(token)
        return found


def quoted(text: str, begin: int, end: int) -> bool:
    """Whether a quotation mark opens shortly before and closes shortly after the term."""
    before, after = text[max(0, begin - QUOTE_REACH) : begin], text[end : end + QUOTE_REACH]
    for opening, closing in zip(OPENING, CLOSING, strict=True):
        if opening == closing:
            inside = before.count(opening) % 2 == 1 and closing in after
        else:
            inside = before.rfind(opening) > before.rfind(closing) and closing in after
        if inside:
            return True
    return False


def features(text: str, kinds: _Kinds) -> list[float]:
    """Logarithms of the counts of each kind, outside and inside quotations, and their share."""
    lowered = text.lower()
    tokens = _TOKEN.findall(lowered)
    counts = np.zeros((3, 2))
    if any(map(kinds.__getitem__, tokens)):
        for token in _TOKEN.finditer(lowered):
            if found := kinds[token.group()]:
                counts[found - 1, int(quoted(lowered, *token.span()))] += 1
    abuse = counts[:, 0].sum()
    return [*np.log1p(counts.ravel()).tolist(), float(abuse > 0), float(100 * abuse / (len(tokens) + 20))]


N_FEATURES = 8


def _near(text: str, kinds: _Kinds) -> list[str]:
    """The distinct words of a text that are one edit off a term."""
    return sorted({undisguised(x) for x in set(_TOKEN.findall(text.lower())) if kinds[x] == FUZZY})


def _per_document(shared, output: str):
    """`features` of each document, its `score` under the learned weights, or its `near` words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, stems, known, weights = shared.value
        kinds = _Kinds(Lexicon(words, stems, any_letter=True, known=known))
        for batch in batches:
            if output == "near":
                found = [_near(x.as_py() or "", kinds) for x in batch.column(1)]
                column = pa.array(found, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column(0), column], [batch.schema.names[0], output])
                continue
            rows = [features(x.as_py() or "", kinds) for x in batch.column(1)]
            if output == "score":
                values = np.array(rows).reshape(-1, N_FEATURES) @ weights[:-1] + weights[-1]
                column = pa.array(1 / (1 + np.exp(-np.clip(values, -500, 500))))
            else:
                column = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], [batch.schema.names[0], output])

    return scan


def learn_terms(labelled: DataFrame, text: str, toxic: str, n_toxic: int, n_clean: int) -> tuple[list[str], list[str]]:
    """Words and stems that stand out in toxic documents.

    Prefixes of words are counted once for each document and word. A prefix stands out if it is
    `MIN_LIFT` times as frequent in toxic documents; the shortest such prefix of at least
    `MIN_LETTERS` letters is lengthened as long as nearly all its words go on alike. If it then is
    a word itself it is a word, else a stem. At most `MAX_TERMS` prefixes reach the driver.
    """
    words = labelled.select(
        F.col(toxic).alias("toxic"),
        F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"\p{L}+"), F.lit(0)))).alias("word"),
    ).filter(F.length("word") >= MIN_LETTERS)
    counted = words.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    sizes = F.explode(F.sequence(F.lit(MIN_LETTERS), F.least(F.length("word"), F.lit(MAX_LETTERS))))
    prefixes = (
        counted.select("word", "t", "c", sizes.alias("n"))
        .select(F.expr("substring(word, 1, n)").alias("prefix"), "t", "c", F.when(F.length("word") == F.col("n"), F.col("t")).otherwise(0).alias("own"))
        .groupBy("prefix")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.sum("own").alias("own"))
    )
    lift = (F.col("t") / n_toxic) / ((F.col("c") + 0.5) / n_clean)
    rows = prefixes.filter((F.col("t") >= MIN_SUPPORT) & (lift >= MIN_LIFT)).orderBy(F.desc("t"), "prefix").limit(MAX_TERMS).collect()
    return _terms({r.prefix: (r.t, r.own) for r in rows})


def _terms(found: dict[str, tuple[int, int]]) -> tuple[list[str], list[str]]:
    words, stems = [], []
    for prefix in sorted(found):
        if any(prefix[:n] in found for n in range(MIN_LETTERS, len(prefix))):
            continue
        longest, mass = prefix, found[prefix][0]
        for other, (t, _) in found.items():
            if other.startswith(prefix) and t >= 0.9 * mass and len(other) > len(longest):
                longest = other
        (words if found[longest][1] >= 0.9 * mass else stems).append(longest)
    return words, stems


def learn_known(labelled: DataFrame, shared, n_toxic: int, n_clean: int) -> list[str]:
    """Words one edit off a term that clean documents use and that do not stand out themselves.

    At most the `MAX_KNOWN` most frequent ones reach the driver.
    """
    near = labelled.select("toxic", "text").mapInArrow(_per_document(shared, "near"), "toxic int, near array<string>")
    counted = near.select("toxic", F.explode("near").alias("word")).groupBy("word")
    counted = counted.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    lift = (F.col("t") / n_toxic) / ((F.col("c") + 0.5) / n_clean)
    rows = counted.filter((F.col("c") > 0) & (lift < MIN_LIFT)).orderBy(F.desc("c"), "word").limit(MAX_KNOWN).collect()
    return [r.word for r in rows]


def fit(rows: np.ndarray, target: np.ndarray, importance: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Logistic weights, intercept last, by Newton's method with a small penalty."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], 0.05)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (importance * (p - target)) + penalty * weights
        curve = (x * (importance * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        weights -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return weights


def learn(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
    sample_key: Column | None = None,
) -> tuple[list[str], list[str], list[str], np.ndarray]:
    """Words, stems, known words near them and weights, from about `TOXIC_SAMPLE` and `CLEAN_SAMPLE` labelled documents.

    The sample is chosen by a hash of the document's id, so what is broadcast and collected is
    bounded by these two numbers. Labels other than 0 and 1 are left aside. Without documents
    of both kinds there are no terms and every score is the share of toxic labels.
    """
    key = F.col(doc_id) if sample_key is None else sample_key
    known = labels.select(F.col(doc_id).alias("_id"), F.col(toxic).cast("int").alias("toxic"), F.xxhash64(key).alias("_key"))
    known = known.filter("toxic in (0, 1)").groupBy("_id").agg(F.max("toxic").alias("toxic"), F.first("_key").alias("_key"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return [], [], [], np.array([0.0] * N_FEATURES + [-30.0 if not n_toxic else 30.0])
    rate = F.when(F.col("toxic") == 1, min(1.0, TOXIC_SAMPLE / n_toxic)).otherwise(min(1.0, CLEAN_SAMPLE / n_clean))
    sample = F.broadcast(known.filter(F.pmod("_key", F.lit(1 << 20)) / (1 << 20) < rate).select("_id", "toxic"))
    labelled = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(sample, "_id").filter("text is not null")
    in_sample = {0: min(n_clean, CLEAN_SAMPLE), 1: min(n_toxic, TOXIC_SAMPLE)}
    words, stems = learn_terms(labelled, "text", "toxic", in_sample[1], in_sample[0])
    context = docs.sparkSession.sparkContext
    known = learn_known(labelled, context.broadcast((words, stems, [], None)), in_sample[1], in_sample[0])
    shared = context.broadcast((words, stems, known, None))
    rows = labelled.select("toxic", "text").mapInArrow(_per_document(shared, "features"), "toxic int, features array<double>").collect()
    if len({r.toxic for r in rows}) < 2:
        return words, stems, known, np.array([0.0] * N_FEATURES + [float(np.log(n_toxic / n_clean))])
    target = np.array([r.toxic for r in rows], float)
    importance = np.where(target == 1, n_toxic / target.sum(), n_clean / (1 - target).sum())
    importance *= len(rows) / importance.sum()
    return words, stems, known, fit(np.array([r.features for r in rows]), target, importance)


def toxicity_scores(
    docs: DataFrame, model: tuple[list[str], list[str], list[str], np.ndarray], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, score, predicted of every document; whole texts are read.

    Null and empty texts get the score of a text without hits. Repeated rows stay; an empty
    table gives an empty result; other columns are not used.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text))
    found = rows.mapInArrow(_per_document(shared, "score"), f"doc_id {kind}, score double")
    return found.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def learn_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learned where crc32 of the doc_id is no multiple of 5.

    A null doc_id is not held out.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = learn(docs, labels.filter(fold != 0))
    held = F.coalesce(fold == 0, F.lit(False)).alias("held_out")
    return toxicity_scores(docs, model).select("doc_id", held, "score", "predicted")
