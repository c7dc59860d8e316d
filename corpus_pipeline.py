"""From raw documents to packed training windows: five stages over all documents.

Each stage reads what the one before it wrote. The first four return the columns of
`documents`; the last returns the pieces of the windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.decontaminate import without_benchmark
from tallyline.llm.language_id import UNKNOWN, fold_model, with_languages
from tallyline.llm.ngram_join import one_of_each_group
from tallyline.llm.packing import packed_pieces
from tallyline.llm.suffix_dedup import without_repeats
from tallyline.llm.tables import kept

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those whose text is null or has no letter go.

    A null `lang` is filled with the predicted language, and stays null where there is none.
    """
    lettered = docs.filter(F.col("text").rlike(r"\p{L}"))
    found = with_languages(lettered, fold_model(docs))
    lang = F.coalesce("row.lang", F.nullif("lang_pred", F.lit(UNKNOWN))).alias("lang")
    return found.select(*[lang if x == "lang" else F.col("row")[x].alias(x) for x in docs.columns])


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with five-word shingles of index 0.8 or more."""
    return one_of_each_group(docs, words=5, ratio=(4, 5))


def suffix_array(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages of 200 bytes are cut out; documents with nothing left go."""
    cut = without_repeats(docs, min_bytes=200)
    return cut.filter(F.col("text").rlike(r"\S")).withColumn("n_chars", F.length("text").cast("bigint"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item go."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 ids, each window in one language, with that `lang`."""
    return packed_pieces(docs, by="lang")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_array", suffix_array),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The languages and the token ids are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
