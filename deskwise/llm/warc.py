"""Web archives: a deterministic sharded writer and a reader that verifies what it reads.

Pages are range-sorted by id. A task streams its range into gzip files, one member per record, rolls
to the next file by compressed size, makes all headers and digests anew and publishes each file under
its final name when it is complete. The manifest lists the files that count. The same pages give the
same bytes, whichever executor writes them and however often.

A payload of at least ``revisit_bytes`` bytes is stored once: the page with the smallest id holds it,
the others are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from contextlib import ExitStack
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwise.llm.common import arrow_schema, held, rank_struct, ship, typed
from deskwise.llm.files import publishing, reading, task
from deskwise.session import scratch_dir

# A file ends with the record that takes it to so many compressed bytes.
ROLL_BYTES = 512 << 20
CHUNK = 1 << 20
# Records read from an archive are handed on in batches of about so many payload bytes.
BATCH_BYTES = 8 << 20
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "partition int, sequence int, file string, records long, bytes long, sha1 string"
RECORD = (
    "page_id bigint, record_type string, target_uri string, payload_digest string, payload_bytes long, "
    "refers_to bigint, payload binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id, digest: str, url, nth: int) -> str:
    """The same for the same page: its id, payload, address and place among rows equal in all three."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr((page_id, digest, url, nth)))}>"


def _member(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return (
        packer.compress(f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode())
        + packer.compress(block)
        + packer.compress(b"\r\n\r\n")
        + packer.flush()
    )


def _uri(url, page_id) -> str:
    """The page's address, free of spaces and control characters; a page without one is named by id."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"


def _page_record(page: dict, nth: int, first: dict | None) -> bytes:
    """A response, or a revisit of the page ``first`` tells of."""
    payload, revisit = page["payload"], first is not None
    digest = base32_sha1(payload)
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    if not revisit:
        block += payload
    return _member(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", _record_id(page["page_id"], digest, page["url"], nth)),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", _uri(page["url"], page["page_id"])),
            ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
            ("WARC-Profile", PROFILE if revisit else None),
            ("WARC-Refers-To", _record_id(first["first_id"], digest, first["first_url"], 0) if revisit else None),
            ("X-Page-ID", page["page_id"]),
            ("X-Payload-Length", len(payload)),
            ("X-Refers-To-Page-ID", first["first_id"] if revisit else None),
        ],
        block,
    )


def _info_record(name: str) -> bytes:
    block = b"software: deskwise\r\nformat: WARC File Format 1.1\r\n"
    return _member(
        [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'file/{name}')}>"),
            ("WARC-Date", DATE),
            ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields"),
        ],
        block,
    )


def _writer(folder: str, roll_bytes: int, schema: pa.Schema):
    def run(batches):
        partition, sequence, out = task()[0], 0, None
        name, records, digest, size = "", 0, None, 0
        key, nth, first = None, 0, None

        def put(data: bytes) -> int:
            out.write(data)
            digest.update(data)
            return len(data)

        def line() -> pa.RecordBatch:
            values = (partition, sequence, name, records, size, digest.hexdigest())
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, values, strict=True))], schema=schema)

        with ExitStack() as stack:
            for batch in batches:
                for page in batch.to_pylist():
                    own = (page["page_id"], page["sha1"], page["url"])
                    key, nth, first = (key, nth, first) if own == key else (own, 0, None)
                    if not page["is_page"]:
                        first = page
                        continue
                    if out is None:
                        name = f"pages-{partition:06d}-{sequence:05d}.warc.gz"
                        records, digest = 0, hashlib.sha1()
                        out = stack.enter_context(publishing(folder, name))
                        size = put(_info_record(name))
                    holds = not nth and first and (first["first_id"], first["first_url"]) == (own[0], own[2])
                    size += put(_page_record(page, nth, None if holds else first))
                    records, nth = records + 1, nth + 1
                    if size >= roll_bytes:
                        stack.close()
                        yield line()
                        out, sequence = None, sequence + 1
        if out is not None:
            yield line()

    return run


def revisits(rows: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """page_id, sha1 and url of every page whose payload occurs again, with the first of its pages.

    Equal payloads are counted map-side, so one that a third of all pages share is a few rows of that
    shuffle. Those that occur twice are written out and joined to pages without their payloads, where
    adaptive execution splits a skewed one.
    """
    repeated = held(
        rows.where(F.col("bytes") >= revisit_bytes)
        .groupBy("sha1", "bytes")
        .agg(F.min(rank_struct("page_id", F.col("url"))).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha1", "bytes", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url")),
        "repeated-payloads",
    )
    return (
        rows.select("page_id", "url", "sha1", "bytes").join(repeated, ["sha1", "bytes"])
        .select("page_id", "sha1", "url", "first_id", "first_url").distinct()
    )


def write_archives(
    pages: DataFrame, folder: str, revisit_bytes: int = 0, roll_bytes: int = ROLL_BYTES
) -> DataFrame:
    """Write a record per page (page_id, url, html) and return the manifest of files.

    A null html is an empty payload. Pages without a page_id come first, and among equal payloads they
    are chosen to hold it only if no page has an id; ties of id go by url. Rows that repeat a page are
    records of their own, the first of them holding the payload. No pages: no files.

    What a page refers to travels as a row of its own that sorts right before the page, so payloads
    are shuffled once, by the range partitioning.
    """
    ship(pages.sparkSession)
    manifest = typed(MANIFEST)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.unhex(F.sha1(payload)).alias("sha1"),
        F.octet_length(payload).alias("bytes"),
    )
    none = F.lit(None)
    both = rows.select(
        "page_id", "sha1", "url", F.lit(True).alias("is_page"), "payload",
        none.cast(rows.schema["page_id"].dataType).alias("first_id"), none.cast("string").alias("first_url"),
    ).unionByName(
        revisits(rows, revisit_bytes).select(
            "page_id", "sha1", "url", F.lit(False).alias("is_page"), none.cast("binary").alias("payload"),
            "first_id", "first_url",
        )
    )
    key = ["page_id", "sha1", "url"]
    ordered = both.repartitionByRange(*key).sortWithinPartitions(*key, "is_page")
    return held(ordered.mapInArrow(_writer(folder, roll_bytes, arrow_schema(manifest)), manifest), "warc-manifest")


def _members(source):
    """Decompressed gzip members of a file, one after the other."""
    data = source.read(CHUNK)
    while data:
        unpack, parts = zlib.decompressobj(31), []
        while data and not unpack.eof:
            parts.append(unpack.decompress(data))
            data = unpack.unused_data if unpack.eof else source.read(CHUNK)
        if not unpack.eof:
            raise ValueError("an archive ends within a record")
        yield b"".join(parts)
        data = data or source.read(CHUNK)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length does not match its block")
    return fields, rest[:size]


def _page(fields: dict[str, str], block: bytes) -> dict:
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("a block does not match its digest")
    if payload is not None and base32_sha1(payload) != digest:
        raise ValueError("a payload does not match its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "record_type": kind,
        "target_uri": fields["WARC-Target-URI"],
        "payload_digest": digest,
        "payload_bytes": len(payload) if payload is not None else number("X-Payload-Length"),
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload": payload,
    }


def _reader(folder: str, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with reading(folder, name) as source:
                    for data in _members(source):
                        fields, block = parse_record(data)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(_page(fields, block))
                        size += len(block)
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Records of the manifest's files; a revisit's payload is null. Digests are verified."""
    ship(spark)
    record = typed(RECORD)
    files = manifest.select("file")
    # By number: adaptive execution would pack the names, and with them all reading, into one task.
    files = files.repartition(max(1, files.count()), "file")
    return files.mapInArrow(_reader(folder, arrow_schema(record)), record)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages to a fresh shared folder and read the archives back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, folder, write_archives(pages, folder))
