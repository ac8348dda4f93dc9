"""From raw documents to packed training sequences, one operator after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwise.llm.common import column, fresh_name, held, read, row_key, whole_rows
from deskwise.llm.decontaminate import decontaminate
from deskwise.llm.packing import pack
from deskwise.llm.repetition import repetition
from deskwise.llm.simhash import keep_one_per_group
from deskwise.llm.substrings import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep. Rows equal in doc_id and text fare alike; a null or empty text
    has too few words and goes, a row without an id is judged like any other."""
    judged = docs.select(F.struct(*row_key()).alias("document"), "text")
    kept = repetition(judged, "document").where("kept").select(
        F.col("document.key_id").alias("kept_id"), F.col("document.key_text").alias("kept_text")
    ).distinct()
    rows = whole_rows(docs)
    same = rows["key_id"].eqNullSafe(kept["kept_id"]) & (rows["key_text"] == kept["kept_text"])
    return rows.join(kept, same, "left_semi").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id. Documents without an id
    stay if their group has no other; ties go by a hash of the text, and of rows equal in both one stays.
    Texts without a word, null or not, are alike."""
    return keep_one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one holds; n_chars follows the text. Rows equal in doc_id and
    text are cut alike, rows without an id rank last, a null or empty text is as it was."""
    removed = fresh_name(docs.columns, "removed")
    cut = remove_repeats(docs, removed=removed)
    shorter = F.when(F.size(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", shorter.cast(docs.schema["n_chars"].dataType)).select(*map(column, docs.columns))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Those whose text is null, empty or short of words hold
    none; rows equal in doc_id and text stay or go together."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in their sequences, with their ids. A null text is empty, an empty one
    its end id alone; rows that repeat a doc_id, or have none, are packed like any others."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packed_sequences", packed_sequences),
]

# SimHash needs XXH64 and packing a tokenizer, neither of which SQL has.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each reading what the one before it wrote."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = held(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
