"""The queries ``op1_*`` to ``op13_*``: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.decontaminate import contaminated, contaminated_words
from ledgerloom.llm.embeddings import near_duplicate_vectors
from ledgerloom.llm.lines import without_repeated_lines
from ledgerloom.llm.merkle import folded, manifest, proof_digest
from ledgerloom.llm.mixing import mixed
from ledgerloom.llm.near import near_duplicates
from ledgerloom.llm.pages import extracted
from ledgerloom.llm.quality import quality_scores
from ledgerloom.llm.sql import SQL as ORACLE
from ledgerloom.llm.substrings import without_repeats
from ledgerloom.llm.suffixes import text_scores
from ledgerloom.llm.surrogates import with_surrogates
from ledgerloom.llm.tries import prefix_nodes
from ledgerloom.llm.warc import derivatives, page_responses

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A fixed key makes reruns of this query agree; a job brings its own secret.
    return with_surrogates(_table(spark, sf_dir, "documents").select("doc_id", "text"), key="a key for this query only")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", "deepest", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extracted(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = page_responses(_table(spark, sf_dir, "pages"), date="2024-05-17T00:00:00Z")
    return derivatives(responses).select(
        "source_id", "record_type", "record_id", "refers_to", "target_uri", "date", "content_type", "payload_digest", "block_digest",
        "content_length", F.sha2("source_headers", 256).alias("headers_sha256"), F.sha2("block", 256).alias("block_sha256"),
    )


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))[0]


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated_words(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest(_table(spark, sf_dir, "documents"))
    found = found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded(F.col("altered"), F.col("path")).alias("folded_root")
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    borrowed = F.crc32(F.col("c").cast("string").cast("binary")) % 9
    return prefix_nodes(_table(spark, sf_dir, "conversations"), borrowed, F.col("c") - F.col("c") % 5)


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_scores(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_line_dedup": op4_line_dedup,
    "op5_mixing": op5_mixing,
    "op6_html_extraction": op6_html_extraction,
    "op7_warc_derivatives": op7_warc_derivatives,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_quality": op9_quality,
    "op10_decontamination": op10_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_lm_scores": op13_lm_scores,
}
SQL: dict[str, str] = {name: sql for name, sql in ORACLE.items() if name in QUERIES}
