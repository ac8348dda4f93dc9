"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwise.llm import decontaminate, licences, oracle
from deskwise.llm.common import read
from deskwise.llm.genetic import best_fit_pack
from deskwise.llm.merkle import proof_digest, verified_documents
from deskwise.llm.packing import pack
from deskwise.llm.repetition import repetition
from deskwise.llm.sharding import stratified_shards
from deskwise.llm.simhash import near_duplicates
from deskwise.llm.spelling import spelling_variants
from deskwise.llm.substrings import remove_repeats
from deskwise.llm.token_counts import corpus_token_counts
from deskwise.llm.token_files import encode_corpus
from deskwise.llm.warc import archive_pages

SHARDS = 24


def op1_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.document_licences(read(spark, sf_dir, "documents"))


def op4_separator_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_token_counts(read(spark, sf_dir, "documents"))


def op5_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(read(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op6_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_shards(read(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op10_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified"
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(read(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lexical_packing, op2_benchmark_decontamination, op3_licence_digests, op4_separator_token_counts,
        op5_rans_token_files, op6_repetition_coverage, op7_line_dedup, op8_stratified_shards,
        op9_simhash_groups, op10_warc_archives, op11_merkle_manifest, op12_spelling_variants,
        op13_best_fit_packing,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op3_licence_digests": oracle.licences(),
    "op6_repetition_coverage": oracle.repetition(),
    "op10_warc_archives": oracle.archives(),
    "op11_merkle_manifest": oracle.manifest(),
    "op12_spelling_variants": oracle.spelling_variants(),
}
