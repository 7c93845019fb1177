"""WARC archives: written in parallel, read back sequentially one gzip member at a time.

Equal payloads are stored once: the record with the smallest page_id is the response, the
others revisit it. Each task writes archives of a bounded size to the shared folder, under
names no other attempt uses, and reports them as rows of a table. Only archives in the
committed table are read, so what a lost or repeated task left behind is never seen.

The reader inflates a member in steps as its bytes arrive, splits header and block by
Content-Length, and verifies digests of blocks and payloads. It holds one record.

Defined cases: a null html is an empty payload. Payloads shorter than 100 bytes are always
responses. Rows are records; rows with the smallest page_id of a group of equal payloads
are all responses. A null page_id is larger than every other; a group without any page_id
has responses only. No pages give no archives and no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE
from riskloom.session import materialize, shared_folder

LEAST_PAYLOAD = 100
ARCHIVE_BYTES = 64 << 20
LEVEL = 1
CHUNK = 1 << 18
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()

VERSION = b"WARC/1.1"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


class WarcError(ValueError):
    """An archive that does not hold what it says."""


def _open(path: str):
    """The file system that the shared folder's URI names, and the path there."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _line(value: str | None) -> bytes:
    """A header value: no line breaks, UTF-8."""
    return " ".join((value or "").split()).encode()


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One WARC record, not compressed. A revisit has the HTTP header as its block only."""
    head = HTTP % len(payload)
    revisit = refers_to is not None
    block = head if revisit else head + payload
    fields = [
        (b"WARC-Type", b"revisit" if revisit else b"response"),
        (b"WARC-Record-ID", b"<urn:page:%s>" % _line("" if page_id is None else str(page_id))),
        (b"WARC-Date", b"1970-01-01T00:00:00Z"),
        (b"WARC-Target-URI", _line(url)),
        (b"WARC-Payload-Digest", b"sha256:" + digest.encode()),
        (b"WARC-Block-Digest", b"sha256:" + hashlib.sha256(block).hexdigest().encode()),
        (b"Content-Type", b"application/http;msgtype=response"),
        (b"Content-Length", b"%d" % len(block)),
    ]
    if revisit:
        profile = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields[4:4] = [
            (b"WARC-Profile", profile),
            (b"WARC-Refers-To", b"<urn:page:%d>" % refers_to),
        ]
    lines = [VERSION, *(name + b": " + value for name, value in fields)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(content: bytes, level: int = LEVEL) -> bytes:
    """A gzip member of its own."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(content) + squeeze.flush()


def members(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    """The content of each gzip member in turn; input is read and inflated in steps."""
    rest = b""
    while True:
        rest = rest or stream.read(chunk)
        if not rest:
            return
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not rest:
                rest = stream.read(chunk)
                if not rest:
                    raise WarcError("the archive ends within a record")
            parts.append(inflate.decompress(rest, chunk))
            rest = inflate.unconsumed_tail or inflate.unused_data
        yield b"".join(parts)


def parse(content: bytes) -> dict:
    """The fields of a record, verified; payload is None for a revisit."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise WarcError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip()
    length = int(fields[b"content-length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise WarcError("the block is not as long as its header says")
    if b"sha256:" + hashlib.sha256(block).hexdigest().encode() != fields[b"warc-block-digest"]:
        raise WarcError("the block has another digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(
        int(v.partition(b":")[2])
        for v in http.split(b"\r\n")
        if v.lower().startswith(b"content-length:")
    )
    kind = fields[b"warc-type"].decode()
    digest = fields[b"warc-payload-digest"].decode().removeprefix("sha256:")
    if kind == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise WarcError("the payload has another digest")
    return {
        "page_id": _page(fields[b"warc-record-id"]),
        "url": fields[b"warc-target-uri"].decode(),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(fields.get(b"warc-refers-to", b"")),
        "payload": payload if kind == "response" else None,
    }


def _page(urn: bytes) -> int | None:
    number = urn.removeprefix(b"<urn:page:").removesuffix(b">")
    return int(number) if number else None


def planned(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """page_id, url, payload, digest, refers_to: which records are stored as revisits."""
    payloads = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    # Copies are counted before the shuffle; only digests that occur twice are joined.
    repeated = (
        payloads.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where((F.col("copies") > 1) & F.col("first").isNotNull())
        .select("digest", "first")
    )
    first = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return payloads.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", "digest", first.alias("refers_to")
    )


def write(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives in the folder; a row per archive: path, n_records, n_bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        out, path, done = None, None, []

        def close():
            out.close()
            done[-1][2] = size

        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                for r in batch.slice(start, SLICE).to_pylist():
                    if out is None:
                        path = f"{uuid.uuid4().hex}.warc.gz"
                        out, size = fs.open_output_stream(f"{base}/{path}", compression=None), 0
                        done.append([f"{folder}/{path}", 0, 0])
                    content = member(
                        record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"])
                    )
                    out.write(content)
                    size += len(content)
                    done[-1][1] += 1
                    if size >= archive_bytes:
                        close()
                        out = None
        if out is not None:
            close()
        if done:
            paths, counts, sizes = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                names=["path", "n_records", "n_bytes"],
            )

    return records.mapInArrow(run, "path string, n_records long, n_bytes long")


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The verified records of the archives listed (path), each archive read by one task."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    names += ["payload"] * payloads
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    arrow = pa.schema(list(zip(names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = _open(path)
                with fs.open_input_stream(at, compression=None) as stream:
                    for content in members(stream):
                        rows.append(parse(content))
                        held += len(content) if payloads else 200
                        if held >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    kinds_sql = ["long", "string", "long", "string", "string", "long", "binary"]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds_sql))
    # With a number, else adaptive execution merges the tiny rows into one reading task.
    listed = archives.select("path").repartition(max(1, archives.count()), "path")
    return listed.mapInArrow(run, schema)


def archive(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages written to archives in the shared folder; the table of the archives."""
    folder = shared_folder(pages.sparkSession, "warc")
    return materialize(write(planned(pages), folder, archive_bytes), "warc-archives")
