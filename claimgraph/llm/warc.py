"""WARC archives: write, normalise to one gzip member a record with an index, read back.

``write_archives`` packs pages into archives the way careless crawlers do: one gzip stream over the whole file. The
normaliser inflates such a stream once, piece by piece, rewrites each record as a gzip member of its own and lists the
members' offsets in a sidecar index, so that a reader can fetch any record alone. An archive is a row (archive, content)
and is bounded by ``ARCHIVE_BYTES`` of payload and one record; rows of binary content can be stored wherever Spark writes.

Of equal payloads of at least ``LEAST`` bytes the smallest id's is kept as a response and the others become revisit
records that refer to it. The smallest id of each payload that occurs twice is joined by digest; Spark broadcasts that
table where it is small, and otherwise moves each page once.

Defined cases: null html is an empty payload; payloads under ``LEAST`` bytes are always responses; rows that repeat an id
are records each, and those that hold the payload's smallest id are all responses; a null id has a record and is always a
response; a null url is written as an empty target; an empty table gives no archives and no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

ARCHIVE_BYTES = 8 << 20
LEAST = 100
_PIECE = 1 << 18


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, with the length of the payload that it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record) of a stream of inflated bytes; memory holds one record."""
    held = bytearray()
    more = True
    while True:
        while (at := held.find(b"\r\n\r\n")) < 0 and more:
            piece = next(pieces, None)
            more = piece is not None
            held += piece or b""
        if at < 0:
            if held.strip():
                raise ValueError("a WARC stream ends inside a record's header")
            return
        named = fields(bytes(held[:at]))
        size = at + 4 + int(named["content-length"]) + 4
        parts, have = [held], len(held)
        while have < size and more:
            piece = next(pieces, None)
            more = piece is not None
            parts.append(piece or b"")
            have += len(parts[-1])
        held = bytearray().join(parts) if len(parts) > 1 else held
        if have < size:
            raise ValueError("a WARC stream ends inside a record")
        yield named, bytes(held[:size])
        del held[:size]


def inflate(content: bytes) -> Iterator[bytes]:
    """A gzip file's bytes in pieces, whether it is one member or many."""
    view, at = memoryview(content), 0
    while at < len(view):
        unzip = zlib.decompressobj(31)
        while not unzip.eof:
            chunk = unzip.unconsumed_tail or view[at : at + _PIECE]
            at += 0 if unzip.unconsumed_tail else len(chunk)
            piece = unzip.decompress(chunk, _PIECE * 4)
            if piece:
                yield piece
            elif not len(chunk):
                raise ValueError("a gzip stream is cut short")
        at -= len(unzip.unused_data)


def normalise(content: bytes, level: int = 6) -> tuple[bytes, list[tuple[int, int, dict[str, str]]]]:
    """The archive with one gzip member a record, and (offset, length, header fields) of each member."""
    out, index = bytearray(), []
    for named, raw in records(inflate(content)):
        zip_ = zlib.compressobj(level, zlib.DEFLATED, 31)
        member = zip_.compress(raw) + zip_.flush()
        index.append((len(out), len(member), named))
        out += member
    return bytes(out), index


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", level: int = 2) -> DataFrame:
    """(archive, content): gzip files of one member over all their records."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    pages = pages.withColumn("digest", F.sha2(payload, 256)).withColumn("long", F.octet_length(payload) >= LEAST)
    narrow = cut(pages.filter("long and page_id is not null").select("page_id", "digest").distinct(), "digests")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").select("digest", "refers_to")
    # only ids and digests meet by digest; pages meet their references by id, so that a common payload is no key of theirs
    refers = cut(narrow.join(first, "digest").filter("refers_to <> page_id"), "refers")
    known = pages.join(refers, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, size, out = TaskContext.get().partitionId(), 0, 0, bytearray()
        zip_ = zlib.compressobj(level, zlib.DEFLATED, 31)

        def close() -> pa.RecordBatch:
            nonlocal zip_, n, size, out
            content = bytes(out) + zip_.flush()
            done = pa.RecordBatch.from_arrays([pa.array([f"pages-{part:06d}-{n:06d}.warc.gz"]), pa.array([content], pa.binary())], names=["archive", "content"])
            zip_, n, size, out = zlib.compressobj(level, zlib.DEFLATED, 31), n + 1, 0, bytearray()
            return done

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode()
                out += zip_.compress(record(page_id, url or "", payload, digest, refers_to))
                size += len(payload) + 400
                if size >= ARCHIVE_BYTES:
                    yield close()
        if size:
            yield close()

    return known.mapInArrow(run, "archive string, content binary")


def normalise_archives(archives: DataFrame) -> DataFrame:
    """(archive, content, index) with one gzip member a record; ``index`` is the sidecar: offset, length, record_id, type, url."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string())])
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                fresh, index = normalise(content.as_py(), 4)
                rows = [{"offset": o, "length": n, "record_id": h["warc-record-id"], "record_type": h["warc-type"], "url": h["warc-target-uri"]} for o, n, h in index]
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()]), pa.array([fresh], pa.binary()), pa.array([rows], pa.list_(entry))], names=["archive", "content", "index"])

    return archives.select("archive", "content").mapInArrow(run, "archive string, content binary, index array<struct<offset:long,length:long,record_id:string,record_type:string,url:string>>")


def read_archives(archives: DataFrame) -> DataFrame:
    """Records of normalised archives, each fetched through the index: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: int(x[10:-1]) if len(x) > 11 else None  # noqa: E731  <urn:page:7>
        for batch in batches:
            for content, index in zip(batch.column(0), batch.column(1), strict=True):
                view, rows = memoryview(content.as_buffer()), []
                for e in index.as_py():
                    raw = zlib.decompress(view[e["offset"] : e["offset"] + e["length"]], 31)
                    at = raw.index(b"\r\n\r\n")
                    named = fields(raw[:at])
                    body = raw[at + 4 : at + 4 + int(named["content-length"])]
                    http, _, payload = body.partition(b"\r\n\r\n")
                    size = int(fields(http)["content-length"])
                    digest = named["warc-payload-digest"].partition(":")[2]
                    if named["warc-type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"the payload of {named['warc-record-id']} differs from its digest")
                    whole = payload if named["warc-type"] == "response" else None
                    rows.append((number(named["warc-record-id"]), named["warc-target-uri"], size, digest, named["warc-type"], number(named["warc-refers-to"]) if "warc-refers-to" in named else None, whole))
                for i in range(0, len(rows), 500):
                    columns = list(zip(*rows[i : i + 500], strict=True))
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    return archives.select("content", "index").mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
