"""A content-addressed web archive: payloads once by digest, record headers apart."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderstrata.llm.common import new_folder, stored

# Equal payloads of fewer bytes are not worth a revisit record.
LEAST_REVISIT = 1000
PAYLOAD_DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DIGESTS = "row long, page_id long, url string, size long, sha1 string, digest binary"
PAYLOADS = "page_id long, size long, digest binary, payload binary"
HEADERS = (
    "page_id long, record_type string, refers_to long, digest binary, "
    "header binary, http_header binary"
)
RECORDS = "record binary, payload binary"
READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string"
)


@dataclass(frozen=True)
class Archive:
    """Where an archive's two tables are."""

    spark: SparkSession
    path: str

    @property
    def headers(self) -> DataFrame:
        return self.spark.read.schema(HEADERS).parquet(f"{self.path}/headers")

    @property
    def payloads(self) -> DataFrame:
        schema = "digest binary, size long, payload binary"
        return self.spark.read.schema(schema).parquet(f"{self.path}/payloads")


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in DIGESTS.split(", ")]
    for batch in batches:
        payloads = [v.as_py() or b"" for v in batch.column(3).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3],
                pa.array(map(len, payloads), pa.int64()),
                pa.array([hashlib.sha1(p).hexdigest() for p in payloads], pa.string()),
                pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary()),
            ],
            names,
        )


def _payloads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in PAYLOADS.split(", ")]
    pack = zstandard.ZstdCompressor(level=6).compress
    for batch in batches:
        payloads = [v.as_py() or b"" for v in batch.column(1).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(map(len, payloads), pa.int64()),
                pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary()),
                pa.array(map(pack, payloads), pa.binary()),
            ],
            names,
        )


def _record_id(page_id: int | None, row: int) -> str:
    """No two rows have the same, even if they repeat a page id or have none."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {row}')}>"


def _line(value: str | None) -> str:
    """A header value on one line."""
    return (value or "").replace("\r", "%0D").replace("\n", "%0A")


def _header(page_id, row, url, size, sha1, holder, date) -> tuple[bytes, bytes]:
    """WARC and HTTP header of a record; ``holder``, page id and row, is what it revisits."""
    kind = "revisit" if holder else "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    http_header = http.encode()
    length = len(http_header) + (0 if holder else size)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(page_id, row)}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{sha1}",
    ]
    if holder:
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {_record_id(*holder)}",
            f"WARC-Refers-To-Page-ID: {holder[0]}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode(), http_header


def _headers(batches: Iterable[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in HEADERS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    for batch in batches:
        rows = []
        for row, page_id, url, size, sha1, digest, holder in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            revisited = None
            if size >= LEAST_REVISIT and holder and holder["row"] != row:
                revisited = holder["page_id"], holder["row"]
            both = _header(page_id, row, url, size, sha1, revisited, date)
            kind = "revisit" if revisited else "response"
            rows.append((page_id, kind, revisited and revisited[0], digest, *both))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names)


def write_archive(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    date: str = PAYLOAD_DATE,
) -> Archive:
    """Writes a record for each row of ``pages`` to the two tables below ``path``.

    ``payloads`` holds each distinct payload once, compressed, under its SHA-256;
    ``headers`` the exact header bytes of each record, its type, and the digest that
    leads to its payload. Of records with equal payloads of 1000 bytes or more, that
    with the largest page id, one of them if several rows have it, is the response and the
    others revisits of it; all others are responses. A NULL html is an empty payload, a
    NULL url an empty one. Rows without a page id refer to the largest like any other, and
    are never referred to. Rows that repeat an id, or have none, are records each, with record
    ids of their own. Payloads are held one at a time, however long. Other columns play no
    part.

    Digests are taken once and stored. The payload crosses the network once, compressed, to
    meet its equals; of each task's equal payloads one is sent, so a payload that many pages
    share is no hot spot. The join that gives each page its group's largest id holds digests
    only.
    """
    rows = pages.select(
        F.col(id_column).cast("long"), F.col(url_column), F.col(html_column)
    ).toDF("page_id", "url", "html")
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", "html")
    digests = stored(numbered.mapInArrow(_digests, DIGESTS), "digests")
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "row"))
    holders = digests.groupBy("digest").agg(F.max(named).alias("holder"))
    # stored, so that a digest of very many pages can be split where they meet
    holders = stored(holders.where("holder IS NOT NULL"), "holders")
    held = digests.join(holders, "digest", "left").select(
        "row", "page_id", "url", "size", "sha1", "digest", "holder"
    )
    headers = held.mapInArrow(lambda it: _headers(it, date), HEADERS)
    headers.write.parquet(f"{path}/headers")
    payloads = rows.select("page_id", "html").mapInArrow(_payloads, PAYLOADS)
    first = Window.partitionBy("digest").orderBy("page_id")
    once = payloads.withColumn("n", F.row_number().over(first)).where("n = 1")
    once = once.select("digest", "size", "payload")
    once.write.option("compression", "none").parquet(f"{path}/payloads")
    return Archive(pages.sparkSession, path)


def _restored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        records, payloads = [], []
        for digest, header, http_header, size, packed in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            payload = unpack.decompress(packed, max_output_size=size) if size else b""
            if hashlib.sha256(payload).digest() != digest:
                raise ValueError(f"payload {digest.hex()} is not what its digest says")
            records.append(record_bytes(header, http_header, payload))
            payloads.append(payload)
        arrays = [pa.array(records, pa.binary()), pa.array(payloads, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["record", "payload"])


def restore(archive: Archive) -> DataFrame:
    """Every record: its exact bytes as in a WARC file, and the full ``payload``, verified.

    A response's bytes hold the payload, a revisit's only headers; its payload here is that
    of the record it refers to. Headers of one digest can be very many; the skew join
    splits them.
    """
    headers = archive.headers.select("digest", "header", "http_header")
    joined = headers.join(archive.payloads, "digest")
    columns = joined.select("digest", "header", "http_header", "size", "payload")
    return columns.mapInArrow(_restored, RECORDS)


def record_bytes(header: bytes, http_header: bytes, payload: bytes) -> bytes:
    """The record as it stands in a WARC file."""
    fields = _fields(header)
    whole = payload if fields["WARC-Type"] == "response" else b""
    return b"".join([header, http_header, whole, b"\r\n\r\n"])


def parse_record(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """A record's WARC fields, its HTTP fields, and what comes after these; ends are checked."""
    head = record.index(b"\r\n\r\n") + 4
    if not record.startswith(b"WARC/1."):
        raise ValueError("no WARC record")
    fields = _fields(record[:head])
    end = head + int(fields["Content-Length"])
    if record[end:] != b"\r\n\r\n":
        raise ValueError(f"page {fields['WARC-Page-ID']}: wrong length")
    inside = record.index(b"\r\n\r\n", head, end) + 4
    return fields, _fields(record[head:inside]), record[inside:end]


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines if line)


def _number(value: str) -> int | None:
    return int(value) if value else None


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in READ.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    for batch in batches:
        rows = []
        for record, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            fields, http, body = parse_record(record)
            kind, page = fields["WARC-Type"], fields["WARC-Page-ID"]
            if body != (payload if kind == "response" else b""):
                raise ValueError(f"page {page}: wrong payload")
            if int(http["Content-Length"]) != len(payload):
                raise ValueError(f"page {page}: wrong payload length")
            sha1 = hashlib.sha1(payload).hexdigest()
            if f"sha1:{sha1}" != fields["WARC-Payload-Digest"]:
                raise ValueError(f"page {page}: wrong payload digest")
            refers_to = _number(fields.get("WARC-Refers-To-Page-ID", ""))
            uri = fields["WARC-Target-URI"]
            rows.append((_number(page), len(payload), sha1, kind, refers_to, uri))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names)


def read_records(records: DataFrame) -> DataFrame:
    """What the bytes of restored records say, parsed; lengths, payloads and digests checked."""
    return records.mapInArrow(_read, READ)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Writes the pages to a new archive in the shared folder and reads them back."""
    path = new_folder(pages.sparkSession, "archive")
    return read_records(restore(write_archive(pages, path)))
