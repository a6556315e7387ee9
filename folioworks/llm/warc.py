"""WARC archives: one gzip member per record, written and read back record by record.

Pages become ``response`` records; of records with equal payloads of ``REVISIT_BYTES`` or
more only the one with the largest page_id holds the payload, the others are ``revisit``
records that name it. Tasks write archives of about ``ROLL_BYTES`` to the shared folder and
return their names; a name counts once its task has committed, so a task that ran twice
leaves no record twice.

The reader goes through an archive in one pass: bytes are inflated as they arrive, each gzip
member must be exactly one record, the record's block is cut by its Content-Length, and the
digests of block and payload are computed again. A record that doesn't fit raises an error.

Defined results: null html is an empty payload, a null url gives a record without target; rows
without page_id are responses (or revisits, if a row with an id has their payload). Rows that
share page_id and payload are records of one kind. Line breaks in addresses are escaped. An
empty table gives no record; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.session import materialize, scratch_path
from folioworks.sources.source import open_system

REVISIT_BYTES = 1000
ROLL_BYTES = 64 << 20
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Upper half of the record identifiers of pages with and without page_id; the lower half is the id.
WITH_ID, WITHOUT_ID = 0x8F1B3C5D7E9A4B6C, 0x8F1B3C5D7E9A4B6D
DATE = "1970-01-01T00:00:00Z"

RECORD = "page_id bigint, target string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def _name(page_id: int | None) -> str:
    upper, lower = (WITHOUT_ID, uuid.uuid4().int & (1 << 64) - 1) if page_id is None else (WITH_ID, page_id & (1 << 64) - 1)
    return f"<urn:uuid:{uuid.UUID(int=upper << 64 | lower)}>"


def _page_id(name: str) -> int | None:
    value = uuid.UUID(name.strip("<>").removeprefix("urn:uuid:")).int
    low = value & (1 << 64) - 1
    return None if value >> 64 != WITH_ID else low - (1 << 64 if low >> 63 else 0)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member that holds the record of a page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: {_sha1(payload)}",
        f"WARC-Block-Digest: {_sha1(block)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(chr(c) for c in range(0x21, 0x7F))))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of each gzip member of a stream of bytes."""
    unpack, content = zlib.decompressobj(31), bytearray()
    for chunk in chunks:
        while chunk:
            content += unpack.decompress(chunk)
            chunk = b""
            if unpack.eof:
                yield bytes(content)
                chunk = unpack.unused_data
                unpack, content = zlib.decompressobj(31), bytearray()
    if content:
        raise ValueError("the archive ends inside a record")


def parse(content: bytes) -> dict:
    """The record that a member holds, checked against its length and digests."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not gap or not first.startswith("WARC/"):
        raise ValueError("not a record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("the record is not as long as its Content-Length says")
    if _sha1(block) != fields["warc-block-digest"]:
        raise ValueError("the block does not match its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != length or _sha1(payload) != fields["warc-payload-digest"]):
        raise ValueError("the payload does not match its length or digest")
    refers = fields.get("warc-refers-to")
    return {
        "page_id": _page_id(fields["warc-record-id"]),
        "target": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _page_id(refers) if refers else None,
        "payload_bytes": length,
        "payload_digest": base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex(),
        "payload": payload if kind == "response" else None,
    }


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html and refers_to: the page that holds the payload of a revisit."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    large = rows.filter(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
    shared = large.filter("n > 1 AND holder IS NOT NULL").select("digest", "holder")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder"))
    return rows.join(shared, "digest", "left").select("page_id", "url", "html", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write archives of ``pages`` (as ``with_revisits`` gives them) to ``folder``; path and number of records of each."""

    def run(batches):
        system, base = open_system(folder)
        out, path, size, count = None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, size, count = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(path, compression=None)
                made = record(row["page_id"], row["url"], row["html"].encode(), row["refers_to"])
                out.write(made)
                size, count = size + len(made), count + 1
                if size >= ROLL_BYTES:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [path], "records": [count]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [count]})

    system, base = open_system(folder)
    system.create_dir(base, recursive=True)
    return materialize(pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string, records bigint"))


def read(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of ``archives`` (path, records), one task per archive."""
    fields = [f.split()[0] for f in RECORD.split(", ")][: None if payloads else -1]
    schema = ", ".join(RECORD.split(", ")[: len(fields)])

    def run(batches):
        system, _ = open_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                held, size, count = [], 0, 0
                with system.open_input_stream(row["path"], compression=None) as source:
                    for content in members(iter(lambda: source.read(READ_BYTES), b"")):
                        held.append({k: v for k, v in parse(content).items() if k in fields})
                        size, count = size + (len(content) if payloads else 500), count + 1
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=kinds)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=kinds)
                if count != row["records"]:
                    raise ValueError(f"{row['path']} holds {count} records, {row['records']} were written")

    types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = pa.schema([(f.split()[0], types[f.split()[1]]) for f in schema.split(", ")])
    files = max(1, archives.count())
    return archives.repartition(files, "path").mapInArrow(run, schema)


def op3_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = scratch_path(spark, "warc")
    records = read(write(with_revisits(pages), folder), folder, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS holder FROM d WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY payload_digest HAVING count(*) > 1)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN g.holder IS NOT NULL AND d.page_id IS DISTINCT FROM g.holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN d.page_id IS DISTINCT FROM g.holder THEN g.holder END AS refers_to
FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest
"""
