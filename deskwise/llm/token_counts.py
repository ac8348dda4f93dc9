"""Token counts of documents in flat token files that have no index.

A flat file is nothing but ids of fixed width, each document followed by a separator id. It is cut
into blocks that tasks search for separators with numpy, independently of each other. A block does
not know where the document it starts in began, nor how many documents precede it: a prefix scan over
the blocks of a file (a running maximum of the last separator, a running count) carries both across.
"""

from __future__ import annotations

import base64
from contextlib import ExitStack
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskwise.llm.common import arrow_schema, held, ship, text_of, typed
from deskwise.llm.files import publishing, reading, task
from deskwise.session import scratch_dir

# One more than the last id of the vocabulary, so no text can hold it.
SEPARATOR = 50256
WIDTH = 2
# Bytes that a task searches, in so many blocks.
RUN_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
# A file ends with the batch of documents that takes it to so many bytes.
FILE_BYTES = 512 << 20

WRITTEN = "file string, document long, doc_id {id}, bytes long"
BLOCKS = "file string, block long, tokens long, ends array<bigint>"


@lru_cache(maxsize=2)
def _encoding(name: str):
    import os

    import public_tokenizers
    import tiktoken

    path = name if os.path.exists(name) else public_tokenizers.path(name)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _writer(folder: str, tokenizer: str, separator: int, width: int, file_bytes: int, schema: pa.Schema):
    def run(batches):
        encode = _encoding(tokenizer).encode_ordinary
        partition, sequence, out, name, document = task()[0], 0, None, "", 0
        with ExitStack() as stack:
            for batch in batches:
                if out is None:
                    name, document = f"flat-{partition:06d}-{sequence:05d}.bin", 0
                    out = stack.enter_context(publishing(folder, name))
                for text in batch.column(1).to_pylist():
                    out.write(np.array([*encode(text), separator], f"<u{width}").tobytes())
                n, size = len(batch), out.tell()
                full = size >= file_bytes
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(range(document, document + n), pa.int64()),
                     batch.column(0), pa.nulls(n, pa.int64())],
                    schema=schema,
                )
                document += n
                if full:
                    stack.close()
                    out, sequence = None, sequence + 1
                    yield pa.RecordBatch.from_pylist([{"file": name, "bytes": size}], schema=schema)
        if out is not None:
            yield pa.RecordBatch.from_pylist([{"file": name, "bytes": size}], schema=schema)

    return run


def write_flat_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str = "byte_bpe_multi_50k.tiktoken",
    separator: int = SEPARATOR,
    width: int = WIDTH,
    file_bytes: int = FILE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Flat files of the ids of all documents, in the order the partitions hold them.

    Returns (files: file, bytes) and (names: file, document, doc_id), document being the place of a
    document in its file. A null text is empty and leaves a bare separator.
    """
    ship(docs.sparkSession)
    written = typed(WRITTEN.format(id=docs.schema["doc_id"].dataType.simpleString()))
    rows = held(
        docs.select("doc_id", text_of().alias("text")).mapInArrow(
            _writer(folder, tokenizer, separator, width, file_bytes, arrow_schema(written)), written
        ),
        "flat-names",
    )
    files = rows.where(F.col("bytes").isNotNull()).select("file", "bytes")
    names = rows.where(F.col("bytes").isNull()).select("file", "document", "doc_id")
    return files, names


def _search(folder: str, separator: int, width: int, block_bytes: int, schema: pa.Schema):
    """Blocks to the places, in tokens of their file, just behind each separator."""

    def run(batches):
        for batch in batches:
            for unit in batch.to_pylist():
                with reading(folder, unit["file"]) as source:
                    source.seek(unit["block"] * block_bytes)
                    raw = source.read(block_bytes)
                ids = np.frombuffer(raw, f"<u{width}")
                ends = np.flatnonzero(ids == separator) + 1 + unit["block"] * (block_bytes // width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([unit["file"]]), pa.array([unit["block"]]), pa.array([len(ids)]),
                     pa.array([ends], pa.list_(pa.int64()))],
                    schema=schema,
                )

    return run


def count_tokens(
    spark: SparkSession,
    folder: str,
    files: DataFrame,
    separator: int = SEPARATOR,
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents of flat files: file, document (its place, from 0), start, n_tokens, terminated.

    ``files`` lists file and bytes. n_tokens is without the separator, start counts the ids of the
    file before the document. Ids behind the last separator are a document that is not terminated. A
    file whose size is no multiple of the width raises. No files, or empty ones: no rows.
    """
    ship(spark)
    if block_bytes % width:
        raise ValueError("a block must hold whole ids")
    whole = F.assert_true(F.col("bytes") % width == 0, F.concat(F.col("file"), F.lit(" ends within an id")))
    blocks = typed(BLOCKS)
    last = F.floor((F.col("bytes") - 1) / block_bytes)
    some = files.where(F.col("bytes") > 0).where(whole.isNull())
    units = some.select("file", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    # By number: adaptive execution would pack these few bytes, and with them all searching, into one task.
    # A task has a run of blocks.
    runs = max(1, -(-units.count() * block_bytes // RUN_BYTES))
    units = units.repartition(runs, "file", "block")
    found = held(
        units.mapInArrow(_search(folder, separator, width, block_bytes, arrow_schema(blocks)), blocks), "separators"
    )
    # A file has bytes / block_bytes rows here, and its size is bounded by the writer. The places of the
    # separators stay where they are: only how many there are, and the last, goes through the scan.
    file = Window.partitionBy("file")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = found.select(
        "file", "block", "tokens", F.size("ends").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last")
    )
    known = sums.select(
        "file", "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("documents_before"),
        F.coalesce(F.max("last").over(before), F.lit(0)).cast("long").alias("begin"),
        F.sum("tokens").over(file).alias("file_tokens"),
        (F.col("block") == F.max("block").over(file)).alias("is_last"),
    )
    scanned = found.repartition(runs, "file", "block").join(known.hint("merge"), ["file", "block"])
    starts = F.concat(F.array("begin"), F.col("ends"))
    ended = F.transform(
        F.sequence(F.lit(1), F.size("ends")),
        lambda k: F.struct(
            (F.col("documents_before") + k - 1).alias("document"),
            starts[k - 1].alias("start"),
            (starts[k] - starts[k - 1] - 1).alias("n_tokens"),
            F.lit(True).alias("terminated"),
        ),
    )
    tail = F.struct(
        (F.col("documents_before") + F.size("ends")).alias("document"),
        F.element_at(starts, -1).alias("start"),
        (F.col("file_tokens") - F.element_at(starts, -1)).alias("n_tokens"),
        F.lit(False).alias("terminated"),
    )
    rest = F.when(F.col("is_last") & (tail["n_tokens"] > 0), F.array(tail))
    none = F.filter(F.array(tail), lambda _: F.lit(False))
    all_of_block = F.concat(F.when(F.size("ends") > 0, ended).otherwise(none), F.coalesce(rest, none))
    return scanned.select("file", F.inline(all_of_block))


def corpus_token_counts(docs: DataFrame) -> DataFrame:
    """doc_id and n_tokens of all documents, counted in flat files written from them."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "flat-files")
    files, names = write_flat_files(docs, folder)
    counts = count_tokens(spark, folder, files)
    # As many as documents: shuffled, and never sent to every task, however short they are.
    return names.hint("merge").join(counts, ["file", "document"], "left").select("doc_id", "n_tokens")
