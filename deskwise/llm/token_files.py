"""Token ids as compressed files: written in id order, read back in parallel.

A file holds whole documents and is described by nothing but itself:

    magic, frequency table, blocks, documents (Arrow: doc_id, n_tokens), checkpoints, trailer

A block is its lanes' states and its words. A checkpoint tells where a block lies, how many tokens
and words it has, and the CRC-32 of its bytes and of its ids. A reader that wants some documents reads
the trailer, the checkpoints and just the blocks that cover them.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskwise.llm import rans
from deskwise.llm.common import arrow_schema, held, ship, text_of, typed
from deskwise.llm.files import publishing, reading, task
from deskwise.llm.tokens import encoder
from deskwise.session import scratch_dir

MAGIC = b"DWRANS01"
BLOCK_TOKENS = 1 << 16
# A file ends with the document that takes it to so many tokens.
FILE_TOKENS = 1 << 24
# Blocks coded together: bounds a task's memory and keeps numpy's arrays long.
BATCH_BLOCKS = 32
# A reading task takes documents of about so many tokens.
UNIT_TOKENS = 1 << 21
# Units that a task reads, about 32 MB of ids.
RUN_UNITS = 4

HEAD = struct.Struct("<8sIII")
CHECKPOINT = np.dtype(
    [("offset", "<u8"), ("tokens", "<u4"), ("words", "<u4"), ("bytes_crc", "<u4"), ("ids_crc", "<u4")]
)
TRAILER = struct.Struct("<QIQQ8s")

MANIFEST = (
    "partition int, sequence int, file string, file_tokens long, "
    "first_document long, documents long, first_token long"
)
DOCUMENTS = "doc_id {id}, start long, n_tokens long, ids binary"


def write_file(out, ids: np.ndarray, doc_ids: pa.Array, lengths: np.ndarray) -> None:
    table = rans.Table.count(ids) if len(ids) else rans.Table(np.zeros(0), np.zeros(0))
    out.write(HEAD.pack(MAGIC, rans.SCALE, rans.LANES, len(table.symbols)))
    out.write(table.symbols.astype("<u4").tobytes() + table.frequencies.astype("<u4").tobytes())
    checkpoints = []
    step = BLOCK_TOKENS * BATCH_BLOCKS
    for begin in range(0, len(ids), step):
        some = ids[begin : begin + step]
        whole = len(some) // BLOCK_TOKENS * BLOCK_TOKENS
        for part in (some[:whole].reshape(-1, BLOCK_TOKENS), some[whole:].reshape(1, -1)):
            if not part.size:
                continue
            spare = -part.shape[1] % rans.LANES  # the last block of a file fills its lanes
            states, words = rans.encode(table, np.pad(part, ((0, 0), (0, spare)), constant_values=ids[0]))
            for block, state, word in zip(part, states, words, strict=True):
                data = state.astype("<u8").tobytes() + word.astype("<u4").tobytes()
                checkpoints.append(
                    (out.tell(), len(block), len(word), zlib.crc32(data), zlib.crc32(block.astype("<u4").tobytes()))
                )
                out.write(data)
    documents = pa.table({"doc_id": doc_ids, "n_tokens": pa.array(lengths, pa.int64())})
    at = out.tell()
    with pa.ipc.new_stream(out, documents.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as index:
        index.write_table(documents)
    directory = out.tell()
    out.write(np.array(checkpoints, CHECKPOINT).tobytes())
    out.write(TRAILER.pack(directory, len(checkpoints), at, len(ids), MAGIC))


class File:
    """An open file: its documents, and the ids of any of them."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        directory, blocks, at, self.tokens, magic = TRAILER.unpack(self._at(size - TRAILER.size, TRAILER.size))
        first, scale, lanes, symbols = HEAD.unpack(self._at(0, HEAD.size))
        if (first, magic, scale, lanes) != (MAGIC, MAGIC, rans.SCALE, rans.LANES):
            raise ValueError("not a token file, or one of another kind")
        numbers = np.frombuffer(self._at(HEAD.size, 8 * symbols), "<u4")
        self.table = rans.Table(numbers[:symbols], numbers[symbols:])
        self.checkpoints = np.frombuffer(self._at(directory, blocks * CHECKPOINT.itemsize), CHECKPOINT)
        self.ends = np.cumsum(self.checkpoints["tokens"].astype(np.int64))
        self.documents = pa.ipc.open_stream(self._at(at, directory - at)).read_all()

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def _blocks(self, first: int, last: int) -> list[np.ndarray]:
        states, words = [], []
        for c in self.checkpoints[first:last]:
            data = self._at(int(c["offset"]), 8 * rans.LANES + 4 * int(c["words"]))
            if zlib.crc32(data) != c["bytes_crc"]:
                raise ValueError("a block's bytes do not match their checksum")
            states.append(np.frombuffer(data, "<u8", rans.LANES))
            words.append(np.frombuffer(data, "<u4", offset=8 * rans.LANES))
        steps = -(-int(self.checkpoints[first]["tokens"]) // rans.LANES)
        rows = rans.decode(self.table, np.array(states), words, steps)
        out = [row[: int(c["tokens"])] for row, c in zip(rows, self.checkpoints[first:last], strict=True)]
        for ids, c in zip(out, self.checkpoints[first:last], strict=True):
            if zlib.crc32(ids.astype("<u4").tobytes()) != c["ids_crc"]:
                raise ValueError("a block's ids do not match their checksum")
        return out

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids begin to end of the file, decoding only the blocks that hold them."""
        if begin >= end:
            return np.zeros(0, np.uint32)
        first, last = np.searchsorted(self.ends, [begin, end - 1], side="right")
        out, k = [], int(first)
        while k <= last:  # runs of blocks of one length; only a file's last one is shorter
            n = k + 1
            while n <= last and n < k + BATCH_BLOCKS and self.checkpoints[n]["tokens"] == self.checkpoints[k]["tokens"]:
                n += 1
            out += self._blocks(k, n)
            k = n
        skip = begin - (int(self.ends[first]) - int(self.checkpoints[first]["tokens"]))
        return np.concatenate(out)[skip : skip + end - begin]


def _writer(folder: str, tokenizer: str, end_id: int, file_tokens: int, schema: pa.Schema):
    """Sorted documents to files; yields the manifest rows."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        partition, sequence = task()[0], 0
        pieces, doc_ids, size = [], [], 0

        def close():
            lengths = np.array([len(p) // 4 for p in pieces], np.int64)
            name = f"tokens-{partition:06d}-{sequence:05d}.rans"
            with publishing(folder, name) as out:
                write_file(out, np.frombuffer(b"".join(pieces), "<u4"), pa.concat_arrays(doc_ids), lengths)
            first = np.cumsum(lengths) - lengths
            units = np.unique(first // UNIT_TOKENS, return_index=True)[1]
            return pa.RecordBatch.from_arrays(
                [pa.array([partition] * len(units), pa.int32()), pa.array([sequence] * len(units), pa.int32()),
                 pa.array([name] * len(units)), pa.array([size] * len(units), pa.int64()), pa.array(units),
                 pa.array(np.diff([*units, len(lengths)])), pa.array(first[units])],
                schema=schema,
            )

        for batch in batches:
            encoded = [ids + end for ids in encoder(tokenizer).encode(batch.column(1).to_pylist())]
            begin = 0
            for k, ids in enumerate(encoded):
                pieces.append(ids)
                size += len(ids) // 4
                if size >= file_tokens:
                    doc_ids.append(batch.column(0).slice(begin, k + 1 - begin))
                    yield close()
                    pieces, doc_ids, size, sequence, begin = [], [], 0, sequence + 1, k + 1
            if begin < len(encoded):
                doc_ids.append(batch.column(0).slice(begin))
        if pieces:
            yield close()

    return run


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 2,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write the ids of all documents, each with the end id, in ascending order of doc_id.

    Returns the manifest: a row per file and unit of reading. The order is a range partitioning over
    (doc_id, row), so rows that share an id are spread like any others; documents without an id come
    first. A null text is empty, an empty document is its end id. No documents: no files.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("text"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    manifest = typed(MANIFEST)
    return held(
        ordered.select("doc_id", "text").mapInArrow(
            _writer(folder, tokenizer, end_id, file_tokens, arrow_schema(manifest)), manifest
        ),
        "token-manifest",
    )


def _reader(folder: str, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            for unit in batch.to_pylist():
                with reading(folder, unit["file"]) as source:
                    file = File(source)
                    some = file.documents.slice(unit["first_document"], unit["documents"])
                    lengths = some.column("n_tokens").to_numpy()
                    ids = file.ids(unit["first_token"], unit["first_token"] + int(lengths.sum()))
                ends = np.cumsum(lengths)
                raw = [ids[a:b].astype("<u4").tobytes() for a, b in zip(ends - lengths, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(some.column("doc_id").chunks),
                     pa.array(unit["files_before"] + unit["first_token"] + ends - lengths), pa.array(lengths),
                     pa.array(raw, pa.binary())],
                    schema=schema,
                )

    return run


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids."""
    ship(spark)
    files = manifest.select("file", "partition", "sequence", "file_tokens").distinct()
    # One row per file.
    before = Window.orderBy("partition", "sequence").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("files_before"))
    documents = typed(DOCUMENTS.format(id=id_type))
    # Units are a few rows per file; each knows where its file starts before any ids are read.
    units = held(
        manifest.join(starts, "file").select("file", "first_document", "documents", "first_token", "files_before"),
        "token-units",
    )
    # By number: adaptive execution would pack these few bytes, and with them all reading, into one task.
    # A task has a run of units.
    spread = units.repartition(max(1, -(-units.count() // RUN_UNITS)), "file", "first_token")
    return spread.mapInArrow(_reader(folder, arrow_schema(documents)), documents)


def encode_corpus(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2) -> DataFrame:
    """Write the token files of all documents to a fresh shared folder and read them back."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "token-files")
    manifest = write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(spark, folder, manifest, docs.schema["doc_id"].dataType.simpleString())
