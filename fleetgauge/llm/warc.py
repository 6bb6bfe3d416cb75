"""WARC archives: writing segmented records, and reassembling them.

A page becomes one logical record. Its block is an HTTP response whose body is in chunked transfer framing;
a block longer than a segment goes on in continuation records that name their origin, their
number and, in the last, the total length. A page whose payload equals that of a page with a smaller
id becomes a revisit record without payload.

Records are written by Spark's text writer, whose line separator is the two line ends that close a
record, so files are committed as Spark commits any output, on any file system. Segments and a limit of
records bound every file, and reading takes one file at a time.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.batches import map_batches, text_slices

#: Bytes of a record's block; longer ones are segmented.
SEGMENT_BYTES = 1 << 16
#: Bytes of a chunk in the transfer framing.
CHUNK_BYTES = 1 << 13
RECORDS_PER_FILE = 2_048
DATE = "2026-01-01T00:00:00Z"

_END = "\r\n\r\n"
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_CHUNKED = b"Transfer-Encoding: chunked\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        chunk = payload[at : at + size]
        parts += [f"{len(chunk):x}\r\n".encode(), chunk, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over, a broken frame is refused."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        start, at = line + 2, line + 4 + size
        if at > len(body) or body[at - 2 : at] != b"\r\n":
            raise ValueError("broken chunk in a transfer framing")
        parts.append(body[start : at - 2])


def payload_of(block: bytes) -> bytes:
    """The payload in an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"\r\ntransfer-encoding: chunked" in head.lower() else body


def _record(kind: str, record_id: str, block: bytes, headers: dict[str, object]) -> bytes:
    lines = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE, **headers}
    lines["Content-Length"] = len(block)
    head = "".join(f"{name}: {value}\r\n" for name, value in lines.items() if value is not None)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block


def records_of(row: dict, unique: str, segment: int) -> Iterator[bytes]:
    """The records of a page row: page_id, url, html, and refers_to if it is a revisit."""
    payload = (row["html"] or "").encode()
    page, refers_to = row["page_id"], row["refers_to"]
    record_id = f"urn:page:{'' if page is None else page}:{unique}"
    headers = {
        "WARC-Target-URI": None if row["url"] is None else quote(row["url"], safe="!#$&'()*+,/:;=?@[]%~"),
        "WARC-Page-ID": page,
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        headers["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
        headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record("revisit", record_id, _HEAD + f"Content-Length: {len(payload)}\r\n\r\n".encode(), headers)
        return
    block = _HEAD + _CHUNKED + chunked(payload)
    if len(block) <= segment:
        yield _record("response", record_id, block, headers)
        return
    yield _record("response", record_id, block[:segment], {**headers, "WARC-Segment-Number": 1})
    for number, at in enumerate(range(segment, len(block), segment), 2):
        last = at + segment >= len(block)
        yield _record("continuation", f"{record_id}:{number}", block[at : at + segment], {
            "WARC-Segment-Origin-ID": f"<{record_id}>",
            "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(block) if last else None,
        })


def write_archives(pages: DataFrame, folder: str, least_revisit_bytes: int = 0, segment: int = SEGMENT_BYTES) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) below ``folder``.

    Of rows with equal payloads of at least ``least_revisit_bytes`` that with the smallest page_id is a
    response, and so are rows that repeat this id; the others are revisits of it. A NULL html is an empty
    payload. A NULL page_id is never the smallest unless there is no other; then all are responses.
    Other columns are ignored; an empty table gives files without records.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.withColumns({"digest": F.sha1(payload), "bytes": F.length(payload)})
    # Only what occurs twice goes into the join; a hot payload sends one row per task there.
    same = pages.where(F.col("bytes") >= least_revisit_bytes).groupBy("digest", "bytes")
    first = same.agg(F.min("page_id").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    is_revisit = F.col("page_id").isNull() | (F.col("page_id") != F.col("first"))
    rows = pages.join(first, ["digest", "bytes"], "left").select(
        "page_id", "url", "html", F.when(is_revisit, F.col("first")).alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, number = TaskContext.get().partitionId(), 0
        for batch in text_slices(batches, "html"):
            found = []
            for row in batch.to_pylist():
                found += records_of(row, f"{split}.{number}", segment)
                number += 1
            yield pa.RecordBatch.from_arrays([pa.array(found, "binary")], ["record"])

    records = map_batches(rows, run, "record binary").select(F.col("record").cast("string").alias("value"))
    options = {"lineSep": _END, "compression": "gzip", "maxRecordsPerFile": RECORDS_PER_FILE}
    records.write.options(**options).text(folder)


def parse_records(file: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of an archive."""
    while line := file.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        headers = {}
        while (line := file.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = file.read(length)
        if len(block) != length:
            raise ValueError("an archive ends within a record")
        yield headers, block


_SEGMENT = (
    "origin string, segment int, total long, record_type string, page_id long, refers_to long, digest string, "
    "payload_bytes long, block binary"
)
_SEGMENT_ARROW = pa.schema(
    [("origin", "string"), ("segment", "int32"), ("total", "int64"), ("record_type", "string"), ("page_id", "int64"),
     ("refers_to", "int64"), ("digest", "string"), ("payload_bytes", "int64"), ("block", "binary")]
)
_PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_PAGE_ARROW = pa.schema(
    [("page_id", "int64"), ("payload_bytes", "int64"), ("payload_digest", "string"), ("record_type", "string"),
     ("refers_to", "int64")]
)


def _number(value: str | None) -> int | None:
    return None if value is None else int(value.strip("<>").rpartition(":")[2])


def _checked(block: bytes, digest: str) -> int:
    payload = payload_of(block)
    if payload_digest(payload) != digest:
        raise ValueError("a payload does not have the digest its record states")
    return len(payload)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each record; whole records are decoded here, segments go on with their blocks."""
    for content in (data for batch in batches for data in batch.column("content")):
        rows, held = [], 0
        with gzip.open(io.BytesIO(content.as_py())) as file:
            for headers, block in parse_records(file):
                number = headers.get("warc-segment-number")
                row = {
                    "origin": headers.get("warc-segment-origin-id", headers["warc-record-id"]),
                    "segment": int(number or 1),
                    "total": _number(headers.get("warc-segment-total-length")),
                    "record_type": headers["warc-type"],
                    "page_id": _number(headers.get("warc-page-id")),
                    "refers_to": _number(headers.get("warc-refers-to")),
                    "digest": headers.get("warc-payload-digest", "").removeprefix("sha1:"),
                }
                if number:
                    row["block"] = block
                    held += len(block)
                elif row["record_type"] == "revisit":
                    lines = block.decode().lower().split("\r\n")
                    row["payload_bytes"] = next(int(x.split(":")[1]) for x in lines if x.startswith("content-length:"))
                else:
                    row["payload_bytes"] = _checked(block, row["digest"])
                rows.append(row)
                if held >= 1 << 24 or len(rows) >= 10_000:
                    yield pa.RecordBatch.from_pylist(rows, _SEGMENT_ARROW)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _SEGMENT_ARROW)


def _reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each logical record, from segments in order of (origin, segment)."""

    def page(parts: list[dict]) -> dict:
        head = parts[0]
        size = head["payload_bytes"]
        if head["block"] is not None:
            block = b"".join(part["block"] for part in parts)
            if [part["segment"] for part in parts] != [*range(1, len(parts) + 1)] or parts[-1]["total"] != len(block):
                raise ValueError(f"segments of {head['origin']} are missing or do not have the stated length")
            size = _checked(block, head["digest"])
        return {"page_id": head["page_id"], "payload_bytes": size, "payload_digest": head["digest"],
                "record_type": head["record_type"], "refers_to": head["refers_to"]}

    held: list[dict] = []
    for batch in batches:
        pages = []
        for row in batch.to_pylist():
            if held and row["origin"] != held[0]["origin"]:
                pages.append(page(held))
                held = []
            held.append(row)
        yield pa.RecordBatch.from_pylist(pages, _PAGE_ARROW)
    if held:
        yield pa.RecordBatch.from_pylist([page(held)], _PAGE_ARROW)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Per logical record of the archives below ``folder``: page_id, payload_bytes, payload_digest, record_type,
    refers_to.

    Segments are grouped by their origin, put in order, checked against the stated total length, and decoded;
    every payload is checked against its digest. A broken archive fails the query.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    segments = map_batches(files, _segments, _SEGMENT)
    return map_batches(
        segments.repartition("origin").sortWithinPartitions("origin", "segment"), _reassembled, _PAGE
    )
