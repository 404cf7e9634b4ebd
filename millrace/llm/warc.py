"""WARC archives with revisit records for payloads that another record already holds.

Only headers are shuffled by payload digest: each digest's original is found by an
aggregation that is combined before the shuffle, revisits are joined to it, and
the pages are then written once, as gzip members, with fresh headers.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import committed, opened
from .scratch import Scratch

#: Shortest payload, in bytes, that a revisit record may stand for.
LEAST_BYTES = 1000
#: All records carry one date, so that a rerun writes the same bytes.
DATE = "2026-01-01T00:00:00Z"
#: Fixed by the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_OUT = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
_OUT_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _clean(value: str) -> str:
    """A header value on one line; other characters than printable ASCII are percent-encoded."""
    return re.sub(rb"[^\x21-\x7e]", lambda m: b"%%%02X" % m[0][0], value.encode()).decode()


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page} {digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One record as a gzip member of its own."""
    body = _HTTP + payload if refers_to is None else _HTTP
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": _clean(url or ""),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type": "application/http; msgtype=response",
        "X-Page-ID": "" if page is None else str(page),
        "X-Payload-Length": str(len(payload)),
    }
    if refers_to is None:
        head["WARC-Block-Digest"] = "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    else:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(refers_to, digest), "WARC-Refers-To-Target-URI": _clean(refers_url or ""), "X-Refers-To-Page-ID": str(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return gzip.compress(f"WARC/1.1\r\n{lines}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n", 1, mtime=0)


def records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of an archive's records; holds one record at a time."""
    with opened(uri) as file:
        held, inflate, left = b"", zlib.decompressobj(31), b""
        while True:
            data = left or file.read(1 << 20)
            if not data:
                break
            held, left = held + inflate.decompress(data), b""
            if inflate.eof:
                left, inflate = inflate.unused_data, zlib.decompressobj(31)
                head, _, body = held.partition(b"\r\n\r\n")
                held = b""
                if not head.startswith(b"WARC/1."):
                    raise ValueError(f"{uri}: not a WARC record")
                fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
                yield fields, body[: int(fields["Content-Length"])]
        if held:
            raise ValueError(f"{uri}: a record is cut off")


def resolve_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, digest, refers_to, refers_url) of the pages that repeat another page's payload."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    headers = pages.select("page_id", "url", F.sha1(payload).alias("digest"), F.length(payload).alias("bytes")).where(F.col("bytes") >= least_bytes)
    originals = headers.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.max_by("url", "page_id").alias("refers_url"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n")
    found = headers.join(originals, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return found.select("page_id", "digest", "refers_to", "refers_url").distinct()


def write_warc(pages: DataFrame, folder: str, *, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write a record per row of pages (page_id, url, html) to archives in `folder`; returns the written manifest (uri, records)."""
    scratch = Scratch(pages.sparkSession, "warc")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    revisits = resolve_revisits(pages, least_bytes).select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "refers_to", "refers_url")
    sha = pages.withColumn("digest", F.sha1(F.encode(F.coalesce("html", F.lit("")), "utf-8")))
    joined = sha.join(revisits, F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest")), "left").select("page_id", "url", "html", "digest", "refers_to", "refers_url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, n = f"{folder}/part-{TaskContext.get().partitionId():08d}.warc.gz", 0
        with committed(uri) as out:
            for batch in batches:
                for page, url, html, digest, refers_to, refers_url in zip(*(batch.column(i) for i in range(6)), strict=True):
                    out.write(record(page.as_py(), url.as_py(), (html.as_py() or "").encode(), digest.as_py(), refers_to.as_py(), refers_url.as_py()))
                    n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([n], pa.int64())], names=["uri", "records"])

    return scratch.table(joined.mapInArrow(run, "uri string, records long"), "manifest")


def read_warc(manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of every record in the archives of a manifest.

    A response's length and digest are taken from its payload and must agree with its
    headers; a revisit's are those of the payload that it stands for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: int(x) if x else None
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                rows = []
                for head, block in records(uri):
                    digest, size = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex(), int(head["X-Payload-Length"])
                    if head["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
                            raise ValueError(f"{uri}: a payload does not match its digest")
                    rows.append((number(head["X-Page-ID"]), size, digest, head["WARC-Type"], number(head.get("X-Refers-To-Page-ID")), head["WARC-Target-URI"]))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)

    # a number of partitions that is given stays: one task an archive
    return manifest.select("uri").repartition(max(1, manifest.count())).mapInArrow(run, _OUT_SQL)


def warc_archive(pages: DataFrame, *, folder: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) as deduplicated archives and read them back, a row per record.

    Of records with equal payloads of at least `least_bytes` bytes that with the
    largest page_id is the response and the others are revisits; all others are responses.
    Null html is an empty payload, a null url an empty one. A null page_id is never the original
    while the digest has another page; rows that repeat the original's page_id
    and payload are responses as well. Other columns are ignored. An empty table gives no rows.
    """
    folder = folder or Scratch(pages.sparkSession, "warc-files").root
    return read_warc(write_warc(pages, folder, least_bytes=least_bytes)).drop("url")


OP7_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest, CASE WHEN o.original IS NULL OR o.original = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN o.original <> p.page_id THEN o.original END AS refers_to
FROM p LEFT JOIN o ON p.payload_digest = o.payload_digest AND p.payload_bytes >= 1000
"""
