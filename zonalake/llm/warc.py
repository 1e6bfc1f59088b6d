"""WARC records in ZIP packages, written and read back by ranges.

Each task packs its pages into a package with the stored members `archive/data.warc.gz` (a gzip
member per record) and `indexes/index.cdxj` (a line per record with place and length). A reader finds
both by the package's directories and reads single records by range; nothing is extracted.

Of pages with equal payloads the one with the smallest page_id is a `response`, the others are
`revisit` records without payload that refer to it. Digests and smallest ids meet in an aggregation
that combines in the map tasks; the html joins only the digests that occur more than once.

Cases: null html is an empty payload, and empty payloads are equal to one another; a null page_id
sorts before all others and is null in the result; repeated rows of a response are responses each; an
url that is null stands as the page's own URN, characters that cannot stand in a header are escaped;
an empty table gives no package and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalake.llm.files import new_file, ranges, shared_folder
from zonalake.llm.hashing import utf8
from zonalake.llm.zipfiles import PackageReader, PackageWriter
from zonalake.session import settle

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = -(2**63)
#: Bytes of a range that is read at once when records follow one another.
READ_BYTES = 4 << 20
PACKAGE = "path string, n_records bigint"
RECORD = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, url string"
)


def _urn(page_id: int) -> str:
    return f"<urn:page:{'null' if page_id == NO_ID else page_id}>"


def _page_of(urn: str) -> int | None:
    value = urn.strip("<>").rpartition(":")[2]
    return None if value == "null" else int(value)


def base32_of(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(page_id: int, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record as a gzip member; `first` is the page that a revisit refers to."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if first is not None else http + payload
    target = _urn(page_id).strip("<>") if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if first is not None:
        head += [f"WARC-Refers-To: {_urn(first)}", f"WARC-Profile: {PROFILE}"]
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(whole, compresslevel=6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of the record, headers of the response, payload."""
    whole = zlib.decompress(member, wbits=31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    answers = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return fields, answers, payload


def _index_line(page_id: int, url: str | None, digest: str, at: int, length: int) -> bytes:
    host, _, path = (url or _urn(page_id)).partition("://")[2].partition("/")
    key = ",".join(reversed(host.lower().split("."))) + ")/" + path
    fields = {"offset": at, "length": length, "filename": ARCHIVE, "digest": f"sha1:{digest}"}
    return f"{quote(key, safe=',)/')} {DATE[:10].replace('-', '')} {json.dumps(fields)}\n".encode()


def write_packages(pages: DataFrame) -> DataFrame:
    """Write all pages; returns (path, n_records) for each package."""
    folder = shared_folder(pages.sparkSession, "warc")
    rows = pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    ).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    shared = rows.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = settle(shared.where(F.col("n") > 1).select("sha1", "first"), "warc-shared")
    marked = rows.join(shared, "sha1", "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next(batches, None)
        if batch is None:
            return
        lines: list[bytes] = []
        with new_file(folder, "package") as (path, out):
            package = PackageWriter(out)
            package.begin(ARCHIVE)
            at = 0
            while batch is not None:
                columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "sha1", "first"))
                payloads = utf8(batch.column("html"))
                for page_id, url, sha1, first, payload in zip(*columns, payloads, strict=True):
                    digest = base32_of(sha1)
                    refers = None if first is None or first == page_id else first
                    member = record(page_id, url, payload, digest, refers)
                    lines.append(_index_line(page_id, url, digest, at, len(member)))
                    package.write(member)
                    at += len(member)
                batch = next(batches, None)
            package.end()
            package.begin(INDEX)
            package.write(b"".join(sorted(lines)))
            package.end()
            package.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([path]), pa.array([len(lines)], pa.int64())], names=["path", "n_records"]
        )

    ordered = marked.select("page_id", "url", "html", "sha1", "first")
    return settle(ordered.mapInArrow(write, PACKAGE), "warc-packages")


def records_of(read) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """All records of a package, located by its index and read in order of place."""
    package = PackageReader(read)
    index, archive = package.open(INDEX), package.open(ARCHIVE)
    places = []
    for line in index(0, index.size).splitlines():
        fields = json.loads(line.split(b" ", 2)[2])
        places.append((fields["offset"], fields["length"]))
    places.sort()
    held, held_at = b"", 0
    for at, length in places:
        if at < held_at or at + length > held_at + len(held):
            held, held_at = archive(at, max(length, READ_BYTES)), at
        yield parse(held[at - held_at : at - held_at + length])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
        )

    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows: list[tuple] = []
            with ranges(path) as read:
                for fields, answers, payload in records_of(read):
                    n = int(answers["Content-Length"])
                    kind = fields["WARC-Type"]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response":
                        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if own != digest or len(payload) != n:
                            raise ValueError(f"broken record {fields['WARC-Record-ID']}")
                    refers = fields.get("WARC-Refers-To")
                    rows.append(
                        (_page_of(fields["WARC-Record-ID"]), n, digest, kind,
                         _page_of(refers) if refers else None, fields["WARC-Target-URI"])
                    )
                    if len(rows) >= 5_000:
                        yield batch_of(rows)
                        rows = []
            if rows:
                yield batch_of(rows)


def read_packages(packages: DataFrame) -> DataFrame:
    """Every record of the packages, its payload checked against its digest. There are as many tasks as
    packages; their number is given, as a few paths would else be put into one task."""
    paths = packages.select("path")
    return paths.repartition(max(1, paths.count()), "path").mapInArrow(_read, RECORD)


def warc_report(pages: DataFrame) -> DataFrame:
    """Write `pages` and report on every page from the packages."""
    return read_packages(write_packages(pages)).drop("url")
