"""WARC archives and the chunked record table.

``write_archives`` writes one gzip member per record (WARC/1.1), each task to
files of its own in a shared folder; a file counts only if the task that wrote
it ended well, since readers take the paths from the returned listing.
``read_chunks`` streams the archives back as rows (record, chunk number): a
chunk holds at most ``chunk_bytes`` of a payload, with the number of payload
bytes and the SHA-1 digest up to and including it, so that no record is ever
held as a whole.  The last chunk of a record carries the digest of its payload.

Of records with equal payloads (same SHA-1 and length) of at least
``min_revisit`` bytes, that with the largest page_id is a ``response``; the
others are ``revisit`` records, which hold no payload but its digest and length.

Defined results: a null html is an empty payload; repeated page_ids with equal
payloads are all responses if theirs is the largest; a null page_id is smaller
than any other and refers to none; a null url leaves its field out; an empty
table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.common import written

CHUNK_BYTES = 1 << 20
FILE_BYTES = 1 << 30
LEVEL = 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _store(uri: str):
    """(file system, path) of a URI or path, on driver and executors alike."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


def _field(value: str) -> str:
    """A header value: control characters and spaces are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_head(record_id: str, kind: str, url: str | None, date: str, digest: str,
                length: int, refers_to: str | None) -> tuple[bytes, bytes]:
    """(WARC header, HTTP header) of a record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_field(url)}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {length}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response",
              f"Content-Length: {len(http) + (length if kind == 'response' else 0)}", "", ""]
    return "\r\n".join(lines).encode(), http


def _page_urn(page_id) -> str:
    return f"urn:x-page:{'' if page_id is None else page_id}"


def base32_digest(data) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def mark_revisits(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """``page_id, url, payload, record_type, refers_to`` of every page."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", body.alias("payload"))
    key = (F.unhex(F.sha1("payload")).alias("_sha"), F.length("payload").alias("_len"))
    best = (rows.select("page_id", *key).groupBy("_sha", "_len")
                .agg(F.max("page_id").alias("_best"), F.count(F.lit(1)).alias("_n"))
                .where((F.col("_n") > 1) & (F.col("_len") >= min_revisit)).drop("_n"))
    both = rows.select("*", *key).join(best, ["_sha", "_len"], "left")
    revisit = F.col("_best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_best"))
    return both.select("page_id", "url",
                       F.when(~revisit, F.col("payload")).alias("payload"), "_sha",
                       F.col("_len").cast("long").alias("_len"),
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("_best")).alias("refers_to"))


def write_archives(marked: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z",
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records of ``mark_revisits`` below ``folder``; the listing
    ``path, n_records`` names the files that count."""
    def run(batches):
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        out, path, n, done = None, "", 0, []
        for b in batches:
            cols = [b.column(c) for c in ("page_id", "url", "payload", "_sha", "_len",
                                          "record_type", "refers_to")]
            for i in range(b.num_rows):
                page, url, sha, length, kind, ref = (cols[k][i].as_py() for k in (0, 1, 3, 4, 5, 6))
                if out is not None and out.tell() >= file_bytes:
                    out.close()
                    done.append((path, n))
                    out, n = None, 0
                if out is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(path)
                digest = base64.b32encode(sha).decode()
                head, http = record_head(_page_urn(page), kind, url, date, digest, length,
                                         _page_urn(ref))
                member = gzip.GzipFile(fileobj=out, mode="wb", compresslevel=LEVEL, mtime=0)
                member.write(head + http)
                if kind == "response":
                    body = memoryview(cols[2][i].as_buffer())
                    for a in range(0, length, CHUNK_BYTES):
                        member.write(body[a:a + CHUNK_BYTES])
                member.write(b"\r\n\r\n")
                member.close()
                n += 1
        if out is not None:
            out.close()
            done.append((path, n))
        yield pa.RecordBatch.from_pydict(
            {"path": pa.array([p for p, _ in done], pa.string()),
             "n_records": pa.array([k for _, k in done], pa.int64())})

    return written(marked.mapInArrow(run, "path string, n_records long"), "warc-listing")


def _headers(stream) -> dict[str, str]:
    out = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _skip(stream, n: int) -> None:
    while n > 0 and (got := stream.read(min(n, 1 << 16))):
        n -= len(got)


def stream_records(stream, chunk_bytes: int):
    """(headers, chunk number, last, chunk, bytes so far, digest so far) of
    every record of an opened archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue  # the empty lines after a record
        head = _headers(stream)
        left = int(head.get("content-length", 0))
        if head.get("content-type", "").startswith("application/http"):
            while left > 0:  # the HTTP header is no payload
                line = stream.readline(left)
                left -= len(line)
                if line in (b"\r\n", b"\n", b""):
                    break
        if head.get("warc-type") == "revisit":
            _skip(stream, left)
            digest = base64.b32decode(head["warc-payload-digest"].partition(":")[2])
            yield head, 0, True, b"", int(head["warc-payload-length"]), digest
            continue
        sha, n, k = hashlib.sha1(), 0, 0
        while True:
            chunk = stream.read(min(left, chunk_bytes))
            if left and not chunk:
                raise EOFError("the archive ends within a record")
            left -= len(chunk)
            sha.update(chunk)
            n += len(chunk)
            yield head, k, left == 0, chunk, n, sha.digest()
            k += 1
            if not left:
                break


CHUNK_SCHEMA = ("record_id string, record_type string, refers_to string, target_uri string, "
                "declared_digest string, chunk_no int, last boolean, chunk binary, "
                "bytes_so_far long, digest_so_far string")


def read_chunks(listing: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES,
                payload: bool = True) -> DataFrame:
    """The chunked record table of the listed archives; ``payload=False``
    leaves the chunks out (the digests are computed all the same)."""
    def rows(stream):
        for head, k, last, chunk, n, digest in stream_records(stream, chunk_bytes):
            yield (head["warc-record-id"].strip("<>"), head.get("warc-type"),
                   head.get("warc-refers-to", "").strip("<>") or None, head.get("warc-target-uri"),
                   head.get("warc-payload-digest", "").partition(":")[2] or None, k, last,
                   chunk if payload else None, n, base64.b32encode(digest).decode())

    def run(batches):
        types = [pa.string()] * 5 + [pa.int32(), pa.bool_(), pa.binary(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]
        store, _ = _store(folder)

        def batch(held):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

        for b in batches:
            for path in b.column("path").to_pylist():
                held, size = [], 0
                with store.open_input_stream(path) as raw:
                    for row in rows(io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 16)):
                        held.append(row)
                        size += len(row[7] or b"") + 200
                        if size >= 4 << 20:
                            yield batch(held)
                            held, size = [], 0
                if held:
                    yield batch(held)

    files = listing.count()
    return listing.select("path").repartition(max(1, files)).mapInArrow(run, CHUNK_SCHEMA)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record, from its last chunk."""
    def page(urn: Column) -> Column:
        return F.regexp_extract(urn, r"^urn:x-page:(.+)$", 1)
    number = F.when(page(F.col("record_id")) != "", page(F.col("record_id")).cast("long"))
    ref = F.when(page(F.col("refers_to")) != "", page(F.col("refers_to")).cast("long"))
    return chunks.where("last").select(
        number.alias("page_id"), F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"), "record_type", ref.alias("refers_to"),
        (F.col("digest_so_far") == F.col("declared_digest")).alias("digest_ok"),
        (F.col("chunk_no") + 1).alias("n_chunks"))


def round_trip(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    listing = write_archives(mark_revisits(pages), folder)
    return records(read_chunks(listing, folder, payload=False))
