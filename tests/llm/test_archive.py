"""The archive gives back every record it was given."""

import hashlib

import pytest
from pyspark.sql import functions as F

from orderstrata.llm import archive
from orderstrata.llm.common import new_folder

LONG, SHORT = "é" * 500, "é" * 499 + "x"
ROWS = [
    (1, "http://a/", LONG), (5, None, LONG), (3, "http://a/\r\nX: y", LONG),
    (2, "u", SHORT), (4, "u", SHORT), (6, "u", None), (7, "u", ""), (None, "n", LONG),
    (8, "only", "z" * 3000), (5, "again", LONG),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(
        [(*r, b"clash") for r in ROWS], "page_id long, url string, html string, digest binary"
    )


def test_rows(pages):
    found = archive.archived_pages(pages).collect()
    wanted = []
    for k, (page_id, url, html) in enumerate(ROWS):
        payload = (html or "").encode()
        again = html == LONG and k != len(ROWS) - 1  # of two rows with the largest id the last
        wanted.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(),
                       "revisit" if again else "response", 5 if again else None,
                       (url or "").replace("\r", "%0D").replace("\n", "%0A")))
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_payloads_are_stored_once_and_records_whole(spark, pages):
    kept = archive.write_archive(pages, new_folder(spark, "archive"))
    payloads = [p for p in {(h or "") for _, _, h in ROWS}]
    assert kept.payloads.count() == len(payloads) == 4
    assert kept.headers.count() == len(ROWS)
    records = archive.restore(kept).collect()
    for r in records:
        record = bytes(r.record)
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
        block = rest[: int(fields[b"Content-Length"])]
        assert record == head + b"\r\n\r\n" + block + b"\r\n\r\n"
        http, _, body = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200")
        assert body == (bytes(r.payload) if fields[b"WARC-Type"] == b"response" else b"")
        said, _, inside = archive.parse_record(record)
        assert said["WARC-Type"].encode() == fields[b"WARC-Type"] and inside == body
    ids = [archive.parse_record(bytes(r.record))[0]["WARC-Record-ID"] for r in records]
    assert len(set(ids)) == len(ROWS)  # rows that repeat an id, or have none, included
    referred = {
        archive.parse_record(bytes(r.record))[0].get("WARC-Refers-To") for r in records
    } - {None}
    assert len(referred) == 1 and referred <= set(ids)


def test_rows_without_ids_and_long_payloads(spark):
    rows = [(None, "a", LONG), (None, "b", LONG), (9, "c", "x" * 5_000_000), (9, "c", "x" * 5_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = archive.archived_pages(pages).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in found)
    assert kinds == [(0, "response", None, 1000)] * 2 + [
        (9, "response", None, 5_000_000),
        (9, "revisit", 9, 5_000_000),
    ]


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda r: r.replace(b"Content-Length: 1\r\n\r\nHTTP", b"Content-Length: 2\r\n\r\nHTTP"), None),
        (lambda r: r[:-1], "wrong length"),
        (lambda r: b"x" + r, "no WARC record"),
    ],
)
def test_records_that_are_none(change, message):
    record = archive.record_bytes(*archive._header(1, 0, "u", 2, "0", None, "now"), b"ab")
    assert archive.parse_record(record)[2] == b"ab"
    if message:
        with pytest.raises(ValueError, match=message):
            archive.parse_record(change(record))


def test_a_damaged_payload_is_noticed(spark, pages):
    kept = archive.write_archive(pages, new_folder(spark, "archive"))
    other = kept.payloads.withColumn("digest", F.when(F.col("size") == 3000, F.lit(b"?" * 32)).otherwise(F.col("digest")))
    moved = new_folder(spark, "archive")
    other.write.parquet(f"{moved}/payloads")
    kept.headers.withColumn("digest", F.when(F.col("page_id") == 8, F.lit(b"?" * 32)).otherwise(F.col("digest"))).write.parquet(f"{moved}/headers")
    with pytest.raises(Exception, match="not what its digest says"):
        archive.restore(archive.Archive(spark, moved)).collect()


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert archive.archived_pages(none).collect() == []
