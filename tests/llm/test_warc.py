import gzip
import io

import pytest
from hypothesis import given
from hypothesis import strategies as st

from fleetgauge.llm.warc import (
    chunked,
    parse_records,
    payload_digest,
    payload_of,
    read_archives,
    records_of,
    unchunked,
    write_archives,
)

SCHEMA = "page_id long, url string, html string, digest string, first long, record_type string"


@given(st.binary(max_size=300), st.integers(1, 40))
def test_chunks_round_trip(payload, size):
    assert unchunked(chunked(payload, size)) == payload


def test_chunk_extensions_and_broken_frames():
    assert unchunked(b"3;name=value\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for broken in (b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabcde\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            unchunked(broken)


def test_segments_reassemble():
    row = {"page_id": 5, "url": "http://a/\r\nX: y", "html": "é" * 1000 + "\r\n\r\nWARC/1.1\r\n", "refers_to": None}
    records = list(records_of(row, "0.0", 300))
    assert len(records) > 5
    parsed = list(parse_records(io.BufferedReader(io.BytesIO(b"".join(r + b"\r\n\r\n" for r in records)))))
    assert [h.get("warc-segment-number") for h, _ in parsed] == [str(n) for n in range(1, len(records) + 1)]
    block = b"".join(block for _, block in parsed)
    assert payload_of(block) == row["html"].encode()
    assert parsed[-1][0]["warc-segment-total-length"] == str(len(block)) and "x" not in parsed[0][0]


def test_archives_of_odd_pages(spark, tmp_path):
    pages = [
        (4, "http://a", "same", "x", 1, "x"), (2, None, "same", "x", 1, "x"), (9, "u", "same", "x", 1, "x"),
        (2, "again", "same", "x", 1, "x"), (1, "u", None, "x", 1, "x"), (3, "u", "", "x", 1, "x"),
        (None, "u", "same", "x", 1, "x"), (None, "u", "alone", "x", 1, "x"),
        (8, "u", "long é " * 20_000, "x", 1, "x"), (6, "u", "\r\n\r\nWARC/1.1\r\n\r\n", "x", 1, "x"),
    ]
    table = spark.createDataFrame(pages, SCHEMA)
    folder = str(tmp_path / "archives")
    write_archives(table, folder, segment=5_000)
    found = sorted((tuple(r) for r in read_archives(spark, folder).collect()), key=str)
    first = {"same": 2, "": 1, "long é " * 20_000: 8, "alone": None, "\r\n\r\nWARC/1.1\r\n\r\n": 6}
    wanted = []
    for page, _, html, *_ in pages:
        data = (html or "").encode()
        origin = first[html or ""]
        revisit = origin is not None and page != origin
        wanted.append((page, len(data), payload_digest(data), "revisit" if revisit else "response", origin if revisit else None))
    assert found == sorted(wanted, key=str)
    write_archives(table.limit(0), str(tmp_path / "none"))
    assert read_archives(spark, str(tmp_path / "none")).isEmpty()


def test_small_payloads_are_never_revisits(spark, tmp_path):
    table = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    write_archives(table, str(tmp_path / "a"), least_revisit_bytes=4)
    found = {r.page_id: r.refers_to for r in read_archives(spark, str(tmp_path / "a")).collect()}
    assert found == {1: None, 2: None, 3: None, 4: 3}


def test_a_missing_segment_is_an_error(spark, tmp_path):
    row = {"page_id": 5, "url": "u", "html": "x" * 1000, "refers_to": None}
    records = list(records_of(row, "0.0", 300))
    del records[1]
    (tmp_path / "part.txt.gz").write_bytes(gzip.compress(b"".join(r + b"\r\n\r\n" for r in records)))
    with pytest.raises(Exception, match="missing"):
        read_archives(spark, str(tmp_path)).collect()
