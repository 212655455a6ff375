"""WARC archives of pages: written by Spark, read back record by record.

Writing: every page becomes one WARC record in a gzip member of its own. Of
pages with equal payloads of at least ``REVISIT_BYTES``, the one with the
largest page_id is stored, the others become ``revisit`` records without a
payload. Only digests are grouped (a payload shared by a third of all pages is
one key of short rows, reduced before the shuffle); payloads never meet.

Archives are made by Spark's own text writer, so any file system that Spark
writes works and a lost task is simply redone. That writer ends a value with a
separator; the separator used is the zero byte that ends a gzip member of less
than 16 MiB anyway (the high byte of its length), which is cut from the value.
A longer record is followed by an empty member, which decompresses to nothing.

Reading: a sequential reader inflates an archive in small steps, takes one
member as one record, frames the block by its Content-Length and checks the
SHA-1 of the payload.

Defined results: null html is an empty payload; a null page_id or url is kept
as null; rows that repeat the page_id of the stored page with the same payload
are all responses; an empty table gives no archives and no rows; other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.llm.common import slices
from tillpanel.session import scratch_path

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
STEP = 1 << 16
# fixed values: header names of the WARC 1.1 format
EMPTY_MEMBER = zlib.compress(b"", 6, 31)
RECORD = "archive int, member binary"
READ = ("page_id {id}, target_uri string, record_type string, payload_length long, payload_digest string, "
        "refers_to {id}, payload binary")


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Distinct ``page_id, digest, refers_to`` of the pages whose payload another page stores."""
    long_enough = pages.filter(F.octet_length("payload") >= least).select("page_id", "digest")
    holder = (long_enough.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
              .filter((F.col("n") > 1) & F.col("refers_to").isNotNull()).drop("n"))
    return (long_enough.distinct().join(holder, "digest")
            .filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))))


def _uri(url: str | None) -> str:
    return "" if url is None else "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url, digest: str, payload: bytes, refers_to, is_revisit: bool, date: str) -> bytes:
    """One WARC record as a gzip member."""
    marked = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
             f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: {marked}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if is_revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_urn(refers_to)}"]
    block = http if is_revisit else http + payload
    lines.append(f"Content-Length: {len(block)}")
    return zlib.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, 31)


def _members(date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = size = 0
        for b in slices(batches, "payload"):
            numbers, values = [], []
            for r in b.to_pylist():
                m = record(r["page_id"], r["url"], r["digest"], r["payload"], r["refers_to"], r["revisit"], date)
                if m[-1]:
                    m += EMPTY_MEMBER
                if size and size + len(m) > archive_bytes:
                    archive, size = archive + 1, 0
                size += len(m)
                numbers.append(archive)
                values.append(m[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(values, pa.binary())], ["archive", "member"])
    return run


def write_archives(pages: DataFrame, path: str, least: int = REVISIT_BYTES, date: str = "2000-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Writes ``pages`` (page_id, url, html) as archives of at most about ``archive_bytes`` below ``path``."""
    payload: Column = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    full = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    again = revisits(full, least).select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to")
    tagged = full.join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left")
    rows = tagged.select("page_id", "url", "payload", "digest", "refers_to", F.col("refers_to").isNotNull().alias("revisit"))
    (rows.mapInArrow(_members(date, archive_bytes), RECORD)
     .select("archive", F.col("member").cast("string").alias("member"))
     .write.partitionBy("archive").option("lineSep", "\u0000").text(path))
    return path


def read_members(chunks: Iterable[bytes]) -> Iterator[Iterator[bytes]]:
    """For each gzip member of the stream, its inflated bytes in steps."""
    source = iter(chunks)
    pending = next(source, b"")

    def member() -> Iterator[bytes]:
        nonlocal pending
        z = zlib.decompressobj(31)
        while not z.eof:
            if not pending and not (pending := next(source, b"")):
                raise ValueError("archive ends within a record")
            out = z.decompress(pending, STEP)
            pending = z.unused_data if z.eof else z.unconsumed_tail
            if out:
                yield out

    while pending or (pending := next(source, b"")):
        m = member()
        yield m
        for _ in m:
            pass


def read_record(steps: Iterator[bytes]) -> tuple[dict[str, str], bytes] | None:
    """Headers and block of one record; None for an empty member."""
    head = bytearray()
    while (end := head.find(b"\r\n\r\n")) < 0:
        more = next(steps, None)
        if more is None:
            if head:
                raise ValueError("record ends within its headers")
            return None
        head += more
    lines = bytes(head[:end]).decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]}")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(headers["content-length"])
    block = head[end + 4:]
    for more in steps:
        block += more
    if bytes(block[length:]) != b"\r\n\r\n":
        raise ValueError("Content-Length does not frame the block")
    return headers, bytes(block[:length])


def parse(headers: dict[str, str], block: bytes) -> dict:
    """The page of one record; checks the payload's digest unless it is a revisit."""
    def number(urn: str | None):
        text = "" if urn is None else urn.strip("<>").rpartition(":")[2]
        return int(text) if text else None

    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = base64.b32decode(headers["warc-payload-digest"].partition(":")[2]).hex()
    kind = headers["warc-type"]
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {headers.get('warc-record-id')}")
    return {"page_id": number(headers.get("warc-record-id")), "target_uri": headers.get("warc-target-uri"),
            "record_type": kind, "payload_length": length, "payload_digest": digest,
            "refers_to": number(headers.get("warc-refers-to")), "payload": payload if kind == "response" else None}


def _read(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                data = memoryview(content.as_buffer())
                rows, size = [], 0
                for steps in read_members(bytes(data[i:i + STEP]) for i in range(0, len(data), STEP)):
                    got = read_record(steps)
                    if got is None:
                        continue
                    rows.append(parse(*got))
                    size += len(got[1])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
    return run


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``, in archive order per file."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "part-*").load(path).select("content"))
    schema = pa.schema([("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()),
                        ("payload_length", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary())])
    return files.mapInArrow(_read(schema), READ.format(id="long"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Archives ``pages`` in the shared folder and returns what reading them back gives."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
