"""WARC archives: one gzip member per record, equal payloads as revisits, and a sequential reader that verifies."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.shared_files import file_folder, reading, stored, writing
from tidemark.llm.shipping import ship

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
SALTS = 64
CHUNK = 1 << 16
WHOLE_URL = "X-Page-URL"  # base64 of a URL that does not go into a header line as it is


class WarcError(ValueError):
    """An archive that breaks the format, or a record that its digests do not match."""


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _target(url: str) -> list[tuple[str, str]]:
    """Header fields for a URL: white space and control characters percent-encoded, then beside it the URL as given."""
    plain = "".join(c if c.isprintable() and not c.isspace() else quote(c) for c in url)
    whole = [] if plain == url else [(WHOLE_URL, base64.b64encode(url.encode()).decode())]
    return [("WARC-Target-URI", plain), *whole]


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit of page `refers_to`, whose block ends where the payload would begin."""
    name = "" if page_id is None else page_id
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += payload if refers_to is None else b""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:x-page:{name}>"),
        ("WARC-Date", DATE),
        *_target(url or ""),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(hashlib.sha1(block).digest())}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:x-page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Length", str(len(block))))
    head = b"".join(f"{key}: {value}\r\n".encode() for key, value in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Member:
    """The bytes of one gzip member, decompressed as they are asked for; at most about `CHUNK` are held."""

    def __init__(self, stream, ahead: bytes):
        self.stream, self.ahead, self.held = stream, ahead, b""
        self.unpack = zlib.decompressobj(31)

    def _more(self) -> bool:
        while not self.unpack.eof:
            data = self.unpack.unconsumed_tail or self.ahead or self.stream.read(CHUNK)
            if data is self.ahead:
                self.ahead = b""
            if not data:
                raise WarcError("the archive ends inside a record")
            got = self.unpack.decompress(data, CHUNK)
            if got:
                self.held += got
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """What stands before `mark`, of any length; nothing is searched twice."""
        found, self.held = bytearray(self.held), b""
        searched = 0
        while (at := found.find(mark, searched)) < 0:
            searched = max(0, len(found) - len(mark) + 1)
            if not self._more():
                raise WarcError("a header has no end")
            found += self.held
            self.held = b""
        self.held = bytes(found[at + len(mark) :])
        return bytes(found[:at])

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.held and not self._more():
                raise WarcError("a record is shorter than its Content-Length")
            part, self.held = self.held[:size], self.held[size:]
            size -= len(part)
            yield part

    def end(self) -> bytes:
        """What follows the member in the stream; there must be nothing left in it."""
        if self.held or self._more():
            raise WarcError("a record is longer than its Content-Length")
        return self.unpack.unused_data


@dataclass
class Record:
    headers: dict[str, str]
    http: bytes
    payload: bytes | None
    payload_bytes: int
    payload_digest: str


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {key.strip().lower(): value.strip() for key, value in pairs}


def records(stream, with_payload: bool = True) -> Iterator[Record]:
    """All records of an archive in order, from a stream that is only read forward.

    The block is framed by Content-Length. Block digests, and payload digests of records that hold their payload, are
    computed as the bytes pass and must match; a revisit names the size and digest of the payload it stands for.
    """
    ahead = stream.read(CHUNK)
    while ahead:
        source = _Member(stream, ahead)
        head = source.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/1."):
            raise WarcError("a record does not begin with its version")
        headers = _fields(head)
        left = int(headers["content-length"])
        block, payload = hashlib.sha1(), hashlib.sha1()
        http, parts, size, inside = b"", [], 0, False
        for part in source.take(left):
            block.update(part)
            if not inside:
                http += part
                at = http.find(b"\r\n\r\n")
                if at < 0:
                    continue
                http, part, inside = http[: at + 4], http[at + 4 :], True
            payload.update(part)
            size += len(part)
            if with_payload:
                parts.append(part)
        if b"".join(source.take(4)) != b"\r\n\r\n":
            raise WarcError("a record does not end with two line ends")
        ahead = source.end() or source.ahead or stream.read(CHUNK)
        named = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if headers.get("warc-block-digest", "").removeprefix("sha1:") != base32_sha1(block.digest()):
            raise WarcError(f"block digest of {headers.get('warc-record-id')}")
        if headers["warc-type"] == "revisit":
            size = int(_fields(b"\r\n" + http.rstrip(b"\r\n"))["content-length"])
        elif named != base32_sha1(payload.digest()):
            raise WarcError(f"payload digest of {headers.get('warc-record-id')}")
        yield Record(headers, http, b"".join(parts) if with_payload else None, size, named)


def with_originals(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, payload, digest (hex SHA-1) and refers_to of every page.

    refers_to is the largest page_id with the same payload, null for that page itself and for payloads under
    `least_bytes`. Copies of one payload are spread over `SALTS` salts: the largest page_id is found per salt,
    then per payload, and goes back only to the salts that occur, so no task holds a large group.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns(
        {
            "digest": F.sha1("payload"),
            "size": F.octet_length("payload"),
            "salt": F.pmod(F.xxhash64("page_id"), F.lit(SALTS)),
        }
    )
    largest = rows.groupBy("digest", "size", "salt").agg(F.max("page_id").alias("largest"))
    largest = largest.groupBy("digest", "size").agg(F.max("largest").alias("original"), F.collect_list("salt").alias("salts"))
    spread = largest.select("digest", "size", "original", F.explode("salts").alias("salt"))
    again = (F.col("size") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("original"))
    return rows.join(spread, ["digest", "size", "salt"]).select(
        "page_id", "url", "payload", "digest", F.when(again, F.col("original")).alias("refers_to")
    )


def write_warc(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = 1 << 30) -> DataFrame:
    """Write a record per page to archives in the shared folder; returns the manifest (archive, n_records).

    Every task fills archives of about `archive_bytes`. An archive appears under its name only when complete, so
    a task that is lost and runs again leaves the same records. Null pages have an empty payload; a null
    page_id is written as an empty one and revisits its payload's largest page_id, if there is one; rows that
    repeat a page_id and payload are written alike. URLs of any length and content come back as given, a null one as ''.
    Other columns are not archived.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = file_folder(spark, "warc")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        part, row, archives = TaskContext.get().partitionId(), next(rows, None), []
        while row is not None:
            uri, size, count = f"{folder}/part-{part:06d}-{len(archives):04d}.warc.gz", 0, 0
            with writing(uri) as out:
                while row is not None and size < archive_bytes:
                    page_id, url, payload, digest, refers_to = row
                    data = member(record(page_id, url, payload, base32_sha1(bytes.fromhex(digest)), refers_to))
                    out.write(data)
                    size, count, row = size + len(data), count + 1, next(rows, None)
            archives.append((uri, count))
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in archives], pa.string()), pa.array([n for _, n in archives], pa.int64())],
            names=["archive", "n_records"],
        )

    return stored(with_originals(pages, least_bytes).mapInArrow(work, "archive string, n_records long"), "warc-manifest")


def read_warc(manifest: DataFrame, with_payload: bool = True, batch_bytes: int = 16 << 20) -> DataFrame:
    """Read archives back, each front to back by one task: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and, if asked for, payload (null for revisits).
    """
    ship(manifest.sparkSession)
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if with_payload:
        schema, names, kinds = schema + ", payload binary", [*names, "payload"], [*kinds, pa.binary()]

    def address(headers: dict[str, str]) -> str | None:
        whole = headers.get(WHOLE_URL.lower())
        return headers.get("warc-target-uri") if whole is None else base64.b64decode(whole).decode()

    def page(name: str | None) -> int | None:
        number = (name or "").removeprefix("<urn:x-page:").removesuffix(">")
        return int(number) if number else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri in (uri for batch in batches for uri in batch.column(0).to_pylist()):
            rows, size = [], 0
            with reading(uri) as stream:
                for r in records(stream, with_payload):
                    kind = r.headers["warc-type"]
                    row = [
                        page(r.headers.get("warc-record-id")),
                        address(r.headers),
                        r.payload_bytes,
                        r.payload_digest,
                        kind,
                        page(r.headers.get("warc-refers-to")),
                    ]
                    rows.append([*row, None if kind == "revisit" else r.payload] if with_payload else row)
                    size += 200 + len(r.payload or b"")
                    if size > batch_bytes:
                        yield batch_of(rows)
                        rows, size = [], 0
            yield batch_of(rows)

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    archives = manifest.count()
    return manifest.select("archive").repartition(max(1, archives)).mapInArrow(work, schema)


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to archives and read back."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return read_warc(write_warc(pages, least_bytes=0), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS original FROM hashed
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hex, (i // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM grouped
"""
