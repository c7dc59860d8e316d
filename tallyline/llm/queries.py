"""The registered queries of this subpackage: the operators over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import oracles, warc
from tallyline.llm.chat import rendered_chats
from tallyline.llm.decontaminate import hit_digest
from tallyline.llm.inner_products import hard_negatives
from tallyline.llm.language_id import learn_and_predict
from tallyline.llm.merkle import manifest
from tallyline.llm.ngram_join import jaccard_groups
from tallyline.llm.packing import packed_pieces
from tallyline.llm.suffix_dedup import removal_digest
from tallyline.llm.token_counts import token_counts
from tallyline.llm.token_files import read_token_files, write_token_files
from tallyline.llm.toxicity import learn_and_score
from tallyline.llm.vector_dedup import near_vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of the response of every page."""
    return warc.derivatives(warc.page_responses(_table(spark, sf_dir, "pages")))


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages."""
    return learn_and_predict(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, index 0.9: doc_id, n_shingles, component_id."""
    docs = _table(spark, sf_dir, "documents")
    return jaccard_groups(docs, words=3, ratio=(9, 10)).select("doc_id", "n_shingles", "component_id")


def op4_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of ten words: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return hit_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 2048 ids: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packed_pieces(_table(spark, sf_dir, "documents"))


def op6_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine 0.93 within a label: vec_id, n_links, component_id, kept."""
    return near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op7_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy pieces: doc_id, n_words, n_tokens."""
    return token_counts(_table(spark, sf_dir, "documents"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return removal_digest(_table(spark, sf_dir, "documents"), min_bytes=200)


def op9_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered: conv_id, page, n_turns, chat."""
    return rendered_chats(_table(spark, sf_dir, "conversations"))


def op10_levenshtein_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return learn_and_score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree per lang: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    docs = _table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    longer = F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], tampered={"n_chars": longer})
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read back from the files: doc_id, start, n_tokens, ids_crc32."""
    return read_token_files(write_token_files(_table(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_language_mixture": op2_language_mixture,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_aho_corasick": op4_aho_corasick,
    "op5_karmarkar_karp": op5_karmarkar_karp,
    "op6_product_quantisation": op6_product_quantisation,
    "op7_piece_counts": op7_piece_counts,
    "op8_suffix_array": op8_suffix_array,
    "op9_snapshot_collapse": op9_snapshot_collapse,
    "op10_levenshtein_lexicon": op10_levenshtein_lexicon,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_files": op12_token_files,
    "op13_hard_negatives": op13_hard_negatives,
}
SQL = {
    "op1_warc_derivatives": oracles.WARC_DERIVATIVES,
    "op3_ngram_jaccard": oracles.NGRAM_JACCARD,
    "op4_aho_corasick": oracles.DECONTAMINATION,
    "op6_product_quantisation": oracles.NEAR_VECTORS,
    "op8_suffix_array": oracles.SUFFIX_ARRAY,
    "op9_snapshot_collapse": oracles.CHATS,
    "op11_merkle_manifest": oracles.MERKLE_MANIFEST,
    "op13_hard_negatives": oracles.HARD_NEGATIVES,
}
