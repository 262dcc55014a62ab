"""Named queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercadia.llm.bpe import encoding_digests
from mercadia.llm.chat import ROTATE_SQL, rotate_perspectives
from mercadia.llm.common import table
from mercadia.llm.jaccard_join import jaccard_components
from mercadia.llm.language import identify_languages
from mercadia.llm.merkle import MANIFEST_SQL, merkle_manifest
from mercadia.llm.packing import pack_documents
from mercadia.llm.perplexity import perplexity_quality
from mercadia.llm.pii_crf import personal_data
from mercadia.llm.rendezvous import shard_records
from mercadia.llm.spelling import VARIANTS_SQL, spelling_variants
from mercadia.llm.suffix_dedup import dedup_digests
from mercadia.llm.token_counts import count_tokens
from mercadia.llm.topk import TOP_K_SQL, top_k_inner_product

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k_inner_product(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op2_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: rule spans and those that the random field adds."""
    return personal_data(table(spark, sf_dir, "documents"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a 100-byte string with an earlier place covers."""
    return dedup_digests(table(spark, sf_dir, "documents"), length=100)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of 2048."""
    return pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, capacity=2048)


def op5_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids, and of the text decoded from them."""
    return encoding_digests(table(spark, sf_dir, "documents"), BYTE_BPE)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they are more than 512."""
    return count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, limit=512)


def op7_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as each of its speakers sees it."""
    return rotate_perspectives(table(spark, sf_dir, "conversations"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op9_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 15 of all documents by key, and with one shard more."""
    text = F.col("text").cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"), F.lit("key").alias("law"))
    return shard_records(docs, "doc_id", [1.0] * 16).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_perplexity_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the perplexity verdict of every document."""
    return perplexity_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity")


def op11_hashed_ngram_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from four fifths of them."""
    return identify_languages(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents; a third of the ids is tampered with before the fold."""
    id_crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return merkle_manifest(table(spark, sf_dir, "documents"), tampered=id_crc % 3 == 0)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_skip_chain_pii": op2_skip_chain_pii,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_bpe_encode_decode": op5_bpe_encode_decode,
    "op6_token_counts": op6_token_counts,
    "op7_chat_rotation": op7_chat_rotation,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_rendezvous_sharding": op9_rendezvous_sharding,
    "op10_perplexity_quality": op10_perplexity_quality,
    "op11_hashed_ngram_language": op11_hashed_ngram_language,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {"op1_exact_top_k": TOP_K_SQL, "op7_chat_rotation": ROTATE_SQL, "op12_merkle_manifest": MANIFEST_SQL,
                           "op13_spelling_variants": VARIANTS_SQL}
