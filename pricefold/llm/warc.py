"""Operator 2: WARC archives, written and assembled into captures.

``write_warc`` stores each page as a capture of three gzipped records: a
response, or a revisit of an equal payload, and the request and metadata
records that name it by WARC-Concurrent-To.  ``read_warc`` gives back one row
per record, reading files record by record.  ``captures`` joins the records
through their concurrent-to identifiers to one nested row per capture.

Files are written by tasks into the shared folder under names of their own;
only those of committed tasks are in the returned list.  Equal payloads are
found by digest, so page bodies are shuffled once at most, by page.
"""

from __future__ import annotations

import base64
import hashlib
import io
import mmap
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricefold.llm.shared import mapped_path, scratch, stage, tidy, write_atomic

SALTS = 16
FILE_BYTES = 16 << 20  # compressed size at which a file is closed
LEVEL = 5

# Names of the WARC 1.1 format
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype="
FIELDS = "application/warc-fields"

RECORD = ("record_id string, warc_type string, concurrent_to string, target_uri string, date string, "
          "payload_digest string, payload_bytes long, digest_ok boolean, block binary")
_NAMES = [f.split()[0] for f in RECORD.split(", ")]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, rid: str, date: str, block: bytes, content_type: str, uri: str | None, extra: list[tuple[str, str]]) -> bytes:
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", f"WARC-Date: {date}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {uri}")
    head += [f"{k}: {v}" for k, v in extra]
    head += [f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def capture_records(page_id, url: str | None, payload: bytes, refers_to, revisit: bool, date: str) -> Iterator[bytes]:
    """The three records of a page; ids are new ones."""
    rid, other = f"urn:uuid:{uuid.uuid4()}", [f"urn:uuid:{uuid.uuid4()}" for _ in range(2)]
    uri = None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    extra = [("WARC-Payload-Digest", "sha1:" + digest(payload))]
    if revisit:
        yield _record("revisit", rid, date, http, HTTP + "response", uri, [("WARC-Profile", REVISIT), *extra])
    else:
        yield _record("response", rid, date, http + payload, HTTP + "response", uri, extra)
    part = urlsplit(uri or "/")
    get = f"GET {part.path or '/'}{'?' + part.query if part.query else ''} HTTP/1.1\r\nHost: {part.netloc}\r\n\r\n".encode()
    near = [("WARC-Concurrent-To", f"<{rid}>")]
    yield _record("request", other[0], date, get, HTTP + "request", uri, near)
    fields = [f"{k}: {v}" for k, v in (("page-id", page_id), ("refers-to-page", refers_to)) if v is not None]
    yield _record("metadata", other[1], date, "".join(f + "\r\n" for f in fields).encode(), FIELDS, uri, near)


def _write(folder: str, date: str, file_bytes: int):
    def run(batches):
        out, n = io.BytesIO(), 0

        def close():
            path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
            write_atomic(path, lambda f: f.write(out.getbuffer()))
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "captures"])

        for batch in batches:
            page_id, url, html, refers_to, revisit = (batch.column(i) for i in range(5))
            for i in range(batch.num_rows):
                for raw in capture_records(page_id[i].as_py(), url[i].as_py(), html[i].as_py() or b"", refers_to[i].as_py(),
                                           revisit[i].as_py(), date):
                    out.write(raw)
                n += 1
                if out.tell() >= file_bytes:
                    yield close()
                    out, n = io.BytesIO(), 0
        if n:
            yield close()

    return tidy(run)


def write_warc(pages: DataFrame, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html",
               date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a capture per row; returns the files as ``(path, captures)``.

    Of equal payloads of at least ``min_bytes`` that of the largest page_id is
    a response and the others revisit it; smaller ones are all responses.  A
    null html is an empty payload and a null url has no target; rows of null
    page_id revisit like others, and are responses if no equal payload has an
    id; rows that repeat the largest page_id are all responses.
    """
    folder = scratch(pages.sparkSession, "warc")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("html")
                        ).withColumn("sha", F.sha1("html"))
    light = rows.where(F.octet_length("html") >= min_bytes).select("page_id", "sha")
    first = (light.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 and refers_to is not null").drop("n"))
    # one payload, such as the empty one, may be that of a third of all pages: its pages are dealt over salts
    light = light.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    again = stage(light.join(first, ["sha", "salt"]).drop("salt").where("not (page_id <=> refers_to)").distinct(), folder, "revisits").alias("a")
    marked = rows.alias("r").join(again, F.col("r.page_id").eqNullSafe(F.col("a.page_id")) & (F.col("r.sha") == F.col("a.sha")), "left")
    marked = marked.select("r.page_id", "r.url", "r.html", "a.refers_to", F.col("a.sha").isNotNull().alias("revisit"))
    return stage(marked.mapInArrow(_write(mapped_path(folder) + "/archive", date, file_bytes), "path string, captures long"),
                 folder, "files")


def _headers(f) -> dict[str, str] | None:
    """Lower-cased header names and values up to the empty line; None at the end."""
    first = f.readline()
    while first in (b"\r\n", b"\n"):
        first = f.readline()
    if not first:
        return None
    found = {}
    for line in iter(f.readline, b""):
        line = line.rstrip(b"\r\n")
        if not line:
            break
        k, _, v = line.decode("utf-8", "replace").partition(":")
        found[k.strip().lower()] = v.strip()
    return found


_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)")


def _parsed(h: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind = h.get("warc-type")
    named = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    size = ok = None
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        if kind == "response":
            size, found = len(payload), digest(payload)
            ok = named is None or named == found
            named = found
            if not payloads:
                block = None
        elif m := _LENGTH.search(head):
            size = int(m[1])
    strip = lambda x: x and x.strip("<>")
    return (strip(h.get("warc-record-id")), kind, strip(h.get("warc-concurrent-to")), h.get("warc-target-uri"), h.get("warc-date"),
            named, size, ok, block)


REJECTED = "rejected"  # warc_type of what is no whole record


def _members(raw) -> Iterator[tuple[int, bytes | None]]:
    """Members of a gzip file: where each begins, and its content, or None for
    what is no member or not a whole one.  After such the search goes on at the
    next bytes that open a member."""
    at = 0
    while at < len(raw):
        out, upto, d = [], at, zlib.decompressobj(31)
        try:
            while upto < len(raw) and not d.eof:
                part = raw[upto : upto + (1 << 16)]
                out.append(d.decompress(part))
                upto += len(part) - len(d.unused_data)
        except zlib.error:
            pass
        if d.eof:
            yield at, b"".join(out)
            at = upto
        else:
            yield at, None
            at = raw.find(b"\x1f\x8b\x08", at + 1)
            if at < 0:
                return


def _records(content: bytes, payloads: bool) -> Iterator[tuple | str]:
    """Records of a member, parsed; a reason in place of what cannot be one."""
    f = io.BytesIO(content)
    while (h := _headers(f)) is not None:
        size = h.get("content-length", "")
        if not size.isascii() or not size.isdigit():
            yield "content length"  # where the next record begins is not known
            return
        block = f.read(int(size))
        if len(block) < int(size):
            yield "truncated record"
            return
        yield _parsed(h, block, payloads)


def _read(payloads: bool):
    schema = pa.schema([pa.field(n, t) for n, t in zip(_NAMES, [pa.string()] * 6 + [pa.int64(), pa.bool_(), pa.binary()])])

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                if not os.path.getsize(path):
                    continue
                rows, held = [], 0
                with open(path, "rb") as f, mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) as raw:
                    for at, content in _members(raw):
                        for record in ("gzip member",) if content is None else _records(content, payloads):
                            if isinstance(record, str):
                                record = (None, REJECTED, None, path, None, None, at, None, record.encode())
                            rows.append(record)
                            held += len(record[-1] or b"")
                        if held > 4 << 20 or len(rows) >= 4096:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return tidy(run)


def read_warc(files: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the files (column ``path``, gzipped, one member
    per record).  payload_bytes and payload_digest (base32 SHA-1) are those of
    the whole payload: counted for a response, as stated for a revisit.
    ``digest_ok`` is whether a response's payload has its stated digest.
    Without ``payloads`` the blocks of responses are left out.

    What is no whole record (a broken or cut-off member, a record without a
    numeric content length or shorter than it says) is a row of type
    ``rejected``, see ``rejects``; reading goes on with the next member.  A file
    listed twice is read twice; an empty file has no records; a member is held
    whole in a task."""
    n = max(1, min(files.count(), 4 * files.sparkSession.sparkContext.defaultParallelism))
    return files.select("path").repartition(n).mapInArrow(_read(payloads), RECORD)


def rejects(records: DataFrame) -> DataFrame:
    """``(path, position, reason)`` of what ``read_warc`` could not read as a
    record; position: the byte at which its member begins."""
    return records.where(F.col("warc_type") == REJECTED).select(
        F.col("target_uri").alias("path"), F.col("payload_bytes").alias("position"), F.decode("block", "UTF-8").alias("reason"))


def captures(records: DataFrame) -> DataFrame:
    """``(record_id, response, request, metadata)``, one nested row for each
    response or revisit, joined through concurrent-to: one grouping of the
    records, by what they are concurrent to or their own id.  Missing records
    are null; of several requests or metadata the one of the greatest record id
    counts; main records that repeat an id are captures of their own; records
    without a capture are not captures."""
    fields = [c for c in records.columns if c != "concurrent_to"]
    whole, kind = F.struct(*fields), F.col("warc_type")
    main = kind.isin("response", "revisit")
    keyed = records.where(main | kind.isin("request", "metadata")).select(
        F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("id"), kind.alias("kind"), main.alias("main"), whole.alias("r"))
    grouped = keyed.where(F.col("id").isNotNull() | F.col("main")).groupBy("id").agg(
        F.collect_list(F.when(F.col("main"), F.col("r"))).alias("mains"),
        F.max(F.when(F.col("kind") == "request", F.col("r"))).alias("request"),
        F.max(F.when(F.col("kind") == "metadata", F.col("r"))).alias("metadata"))
    return grouped.select(F.col("id").alias("record_id"), F.explode("mains").alias("response"), "request", "metadata").select(
        "record_id", "response", "request", "metadata")


def metadata_field(name: str) -> Column:
    """A field of the metadata record as a number; null if it isn't there."""
    text = F.decode("metadata.block", "UTF-8")
    return F.nullif(F.regexp_extract(text, rf"(?m)^{name}: (-?\d+)\r?$", 1), F.lit("")).cast("long")
