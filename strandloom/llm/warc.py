"""WARC archive as a table of chunks.

A record is written as rows (record, chunk, data, digest).  Chunk 0 holds the WARC
header and the HTTP header, further chunks hold the payload in pieces, the last one
the closing line ends; concatenated in order they are the record's bytes.  Each
row's digest is the SHA-256 over the previous row's digest and its own data, so a
broken or missing chunk is noticed at that chunk.  Readers take rows one by one and
keep one running digest and one count per record, never a record's whole payload.

Of records with equal payloads of at least ``SMALLEST`` bytes the one with the
smallest id is a response, the others are revisits that name it; smaller payloads
are always responses.

Defined cases: null html is an empty payload; a null id is larger than any other,
and is written as an empty field; rows that repeat both id and payload are each a
response where the first of them is; line ends and spaces in URLs are percent-
encoded; an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.runtime import Scratch, workers

CHUNK = 1 << 18
SMALLEST = 100
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
ROWS = "record string, chunk int, data binary, digest string"
READ = "record string, page string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def header(page: object, url: object, size: int, digest: str, first: object) -> bytes:
    """WARC and HTTP header of a response (first is None) or of a revisit."""
    kind = "response" if first is None else "revisit"
    target = "".join(f"%{ord(c):02X}" if c <= " " else c for c in str(url or ""))
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}", f"WARC-Page: {'' if page is None else page}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(HTTP) + (size if first is None else 0)}",
    ]
    if first is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To-Page: {first}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + HTTP


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        records, chunks, datas, digests, held = [], [], [], [], 0

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(records, pa.string()), pa.array(chunks, pa.int32()), pa.array(datas, pa.binary()), pa.array(digests, pa.string())],
                ["record", "chunk", "data", "digest"],
            )

        for page, url, html, size, digest, first in zip(*(batch.column(i) for i in range(6)), strict=True):
            body = memoryview(html.as_buffer()) if html.is_valid else memoryview(b"")
            first, running, record = first.as_py(), b"", f"{part:08d}-{n:012d}"
            n += 1
            pieces = range(0, len(body) if first is None else 0, CHUNK)
            for k in range(len(pieces) + 2):
                if k == 0:
                    data = header(page.as_py(), url.as_py(), size.as_py(), digest.as_py(), first)
                else:
                    data = bytes(body[(k - 1) * CHUNK : k * CHUNK]) if k <= len(pieces) else b"\r\n\r\n"
                running = hashlib.sha256(running + data).digest()
                records.append(record)
                chunks.append(k)
                datas.append(data)
                digests.append(running.hex())
                held += len(data)
                if held >= 8 << 20:
                    yield flushed()
                    records, chunks, datas, digests, held = [], [], [], [], 0
        yield flushed()


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The chunk rows of an archive of ``pages``; write them, or read them by ``records``."""
    spark = pages.sparkSession
    workers(spark)
    scratch = Scratch(spark, "warc")
    body = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).alias("page"), F.col(url_col).alias("url"), body.alias("body"), F.octet_length(body).cast("long").alias("size"), F.sha2(body, 256).alias("digest")
    )
    first = (
        rows.where(F.col("size") >= SMALLEST)
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    first = scratch.save(first, "first")
    refers = F.when((F.col("size") >= SMALLEST) & (F.col("page").isNull() | (F.col("page") > F.col("first"))), F.col("first"))
    joined = rows.join(first, "digest", "left").select("page", "url", "body", "size", "digest", refers.alias("refers"))
    return joined.mapInArrow(_written, ROWS)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    record, running, payload, size, fields, due = None, b"", None, 0, {}, 0
    out: list[tuple] = []

    def closed() -> None:
        if record is None:
            return
        digest, length = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["WARC-Payload-Length"])
        if due:
            raise ValueError(f"record {record} ends {due} bytes early")
        if fields["WARC-Type"] == "response" and (payload.hexdigest(), size) != (digest, length):
            raise ValueError(f"record {record}: its payload doesn't have the digest or length of its header")
        out.append((record, fields["WARC-Page"] or None, length, digest, fields["WARC-Type"], fields.get("WARC-Refers-To-Page")))

    for batch in batches:
        for name, chunk, data, digest in zip(*(batch.column(i) for i in range(4)), strict=True):
            name, chunk, data = name.as_py(), chunk.as_py(), data.as_py()
            if name != record:
                closed()
                if chunk:
                    raise ValueError(f"record {name} begins with chunk {chunk}")
                head, rest = data.split(b"\r\n\r\n", 1)
                fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                due = int(fields["Content-Length"]) + 4 - len(rest)
                record, running, payload, size, last = name, b"", hashlib.sha256(), 0, -1
            elif due > 4:
                payload.update(data)
                size += len(data)
            due -= len(data) if chunk else 0
            running = hashlib.sha256(running + data).digest()
            if chunk != last + 1 or running.hex() != digest.as_py():
                raise ValueError(f"record {name}: chunk {chunk} is broken or out of order")
            last = chunk
        if out:
            yield _rows(out)
            out = []
    closed()
    if out:
        yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
    names = ["record", "page", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)


def records(chunks: DataFrame) -> DataFrame:
    """Reads an archive's chunk rows: a row per record, payload verified."""
    workers(chunks.sparkSession)
    return chunks.repartition("record").sortWithinPartitions("record", "chunk").mapInArrow(_read, READ)

