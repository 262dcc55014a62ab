"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept, as a table read back from
Parquet, and returns documents with the same columns; the last returns the packed
pieces. A stage's decisions cover all its input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercadia.llm.jaccard_join import jaccard_rows, text_hash
from mercadia.llm.packing import pack_documents
from mercadia.llm.perplexity import perplexity_quality
from mercadia.llm.pii_crf import redact
from mercadia.llm.suffix_dedup import remove_repeats
from mercadia.session import cut_lineage

#: Rows of a decision table that may be broadcast to the documents; a larger one is shuffled with them.
BROADCAST_ROWS = 1_000_000
SEQUENCE_TOKENS = 2048


def _small(decisions: DataFrame) -> DataFrame:
    """A decision table, written once, and marked for broadcast if its checked size allows."""
    decisions = cut_lineage(decisions, "decisions")
    return F.broadcast(decisions) if decisions.count() <= BROADCAST_ROWS else decisions


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. The rules judge text and language, so rows of
    one doc_id with the same text and language share their fate; null texts go."""
    key = ["_id", "_lang", "_crc"]
    rejected = _small(perplexity_quality(docs).where(~F.col("kept"))
                      .select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.col("text_crc32").alias("_crc")).distinct())
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    same = F.col("doc_id").eqNullSafe(F.col(key[0])) & F.col("lang").eqNullSafe(F.col(key[1])) & (crc == F.col(key[2]))
    return docs.join(rejected, same, "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar documents: that with the least doc_id, ids
    before none, and by a hash of its text then. Shingles of five words, similarity 0.8.
    Documents without words link with nothing and stay. Rows are told apart by id and
    text, so that rows which share an id, or have none, go only with their own component."""
    found = cut_lineage(jaccard_rows(docs, words=5, percent=80), "components").where("component IS NOT NULL")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    many = found.groupBy("component").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("component", "first")
    stays = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.hash"))
    decided = _small(found.join(many, "component").groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
                     .agg(F.max(stays).alias("_stays"), F.count(F.lit(1)).alias("_n")).where("NOT _stays OR _n > 1"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_hash() == F.col("_hash"))
    kept = docs.join(decided, same, "left_anti")
    repeated = decided.where("_stays")
    if repeated.isEmpty():
        return kept
    one = (docs.join(repeated, same, "left_semi").groupBy("doc_id", text_hash().alias("_hash"))
           .agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_row")).select("_row.*"))
    return kept.unionByName(one)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 100 bytes or more that an earlier one has."""
    return _with_length(remove_repeats(docs, length=100))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with emails, addresses, card and phone numbers replaced by their kind."""
    return _with_length(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, packed into sequences."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE_TOKENS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("skip_chain_pii", personal_data),
    ("best_fit_packing", packing),
]

# No stage but the similarity join can be put in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents`` of ``sf_dir``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
