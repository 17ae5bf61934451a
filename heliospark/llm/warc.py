"""WARC archives with a two-level capture index.

Tasks write archives of single gzip members and return where each record lies. Captures are range-sorted by their key, the
URL with its host reversed; each task writes its keys as compressed blocks of sorted lines, and one directory entry for
each block. The directory stays sparse: blocks grow with the table, so that it has at most ``DIRECTORY`` entries and may be
broadcast. A lookup bisects the directory, reads the blocks concerned by byte range, bisects these, and then reads
records by byte range. File names are unique to a task's attempt and known only from its result, so what a lost or repeated
attempt has written is never read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import math
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliospark.llm.files import RangeReader, writer
from heliospark.llm.shared import fresh_path, keep

REVISIT_BYTES = 1000
LINES = 1000
DIRECTORY = 100_000
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URL = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?([^#]*)")


def url_key(url: str | None) -> str:
    """The URL with its host reversed and in lower case, without scheme, user and fragment; other strings stay as they are."""
    found = _URL.match(url or "")
    if not found or not found[1]:
        return url or ""
    return ",".join(reversed(found[1].lower().split("."))) + (found[2] or "") + ")" + (found[3] or "/")


def _header(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _member(lines: list[str], body: bytes) -> bytes:
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(body)}", "", ""]).encode()
    return gzip.compress(head + body + b"\r\n\r\n", 3, mtime=0)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or with ``refers_to`` a revisit record that keeps the HTTP headers only."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    lines = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {_header(url or '')}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _member(lines, http + (payload if refers_to is None else b""))


def _fields(block: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in block.decode().split("\r\n")[1:])
    return {k.lower(): v.strip() for k, v in pairs}


def parse(member: bytes) -> dict:
    """Page, type, digest (hex), size and reference of a record, and its payload (None for a revisit)."""
    head, rest = gzip.decompress(member).split(b"\r\n\r\n", 1)
    fields = _fields(head)
    http, body = rest[:int(fields["content-length"])].split(b"\r\n\r\n", 1)
    name = lambda field: int(t) if (t := fields.get(field, "<urn:page:>")[10:-1]) else None
    revisit = fields["warc-type"] == "revisit"
    digest = base64.b32decode(fields["warc-payload-digest"][5:]).hex() if revisit else hashlib.sha1(body).hexdigest()
    return {"page_id": name("warc-record-id"), "url": fields["warc-target-uri"], "record_type": fields["warc-type"], "payload_digest": digest,
            "payload_bytes": int(_fields(http)["content-length"]), "refers_to": name("warc-refers-to"), "payload": None if revisit else body}


_CAPTURE = "key string, page_id long, url string, file string, offset long, length long"


def _write_archives(folder: str):
    def run(batches):
        out, uri, at = None, f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
        try:
            for batch in batches:
                rows = []
                for page, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                    if out is None:
                        out = writer(uri)
                        info = _member(["WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {DATE}", "Content-Type: application/warc-fields"], b"format: WARC File Format 1.1\r\n")
                        out.write(info)
                        at = len(info)
                    member = record(page, url, (html or "").encode(), refers)
                    out.write(member)
                    rows.append((url_key(url), page, url, uri, at, len(member)))
                    at += len(member)
                columns = list(zip(*rows)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                                 names=["key", "page_id", "url", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()
    return run


def with_references(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Add ``refers_to``: of pages with equal payloads of at least ``least`` bytes the one with the largest page_id, for the others."""
    pages = pages.withColumn("html", F.coalesce("html", F.lit(""))).withColumn("__digest", F.sha1(F.col("html").cast("binary")))
    kept = pages.where(F.octet_length("html") >= least).groupBy("__digest").agg(F.max("page_id").alias("__kept"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    return pages.join(kept, "__digest", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("__kept")), F.col("__kept"))).drop("__digest", "__kept")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page as a WARC record and return the captures: ``key``, ``page_id``, ``url``, ``file``, ``offset``, ``length``."""
    rows = with_references(pages.select(F.col("page_id").cast("long"), "url", "html"))
    return keep(rows.select("page_id", "url", "html", "refers_to").mapInArrow(_write_archives(folder), _CAPTURE), "captures")


_ENTRY = "first_key string, index_file string, block_offset long, block_length long"


def _write_blocks(folder: str, lines: int):
    def run(batches):
        uri, at, held, out = f"{folder}/{uuid.uuid4().hex}.idx", 0, [], None

        def flush(rows):
            nonlocal at, out
            out = out or writer(uri)
            block = zlib.compress("\n".join(json.dumps(r, ensure_ascii=False) for r in rows).encode(), 6)
            out.write(block)
            at += len(block)
            return rows[0][0], uri, at - len(block), len(block)

        def entries(rows):
            columns = list(zip(*rows)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                              names=["first_key", "index_file", "block_offset", "block_length"])
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "url", "file", "offset", "length")))
            done = []
            while len(held) >= lines:
                done.append(flush(held[:lines]))
                held = held[lines:]
            yield entries(done)
        if held:
            yield entries([flush(held)])
        if out is not None:
            out.close()
    return run


def build_index(captures: DataFrame, folder: str, lines: int = LINES) -> DataFrame:
    """Write the captures as sorted, compressed blocks and return their directory (at most about DIRECTORY entries)."""
    lines = max(lines, math.ceil(captures.count() / DIRECTORY))
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "page_id", "file", "offset"]
    return keep(captures.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_write_blocks(folder, lines), _ENTRY), "directory")


def _find_blocks(shared):
    def run(batches):
        entries = shared.value
        firsts = [e[0].encode() for e in entries]
        for batch in batches:
            out = []
            for key in batch.column("key").to_pylist():
                raw = key.encode()
                low, high = max(bisect.bisect_left(firsts, raw) - 1, 0), bisect.bisect_right(firsts, raw)
                out += [(key, *entries[i][1:]) for i in range(low, high)]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                             names=["key", "index_file", "block_offset", "block_length"])
    return run


def _search_blocks(batches):
    read, place, lines, keys = RangeReader(), None, [], []
    for batch in batches:
        out = []
        for key, uri, offset, length in zip(*(batch.column(c).to_pylist() for c in ("key", "index_file", "block_offset", "block_length"))):
            if place != (uri, offset):
                place = uri, offset
                lines = [json.loads(x) for x in zlib.decompress(read(uri, offset, length)).decode().split("\n")]
                keys = [x[0].encode() for x in lines]
            raw = key.encode()
            out += lines[bisect.bisect_left(keys, raw):bisect.bisect_right(keys, raw)]
        columns = list(zip(*out)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                         names=["key", "page_id", "url", "file", "offset", "length"])
    read.close()


def lookup(keys: DataFrame, directory: DataFrame) -> DataFrame:
    """All captures of the URL keys in ``keys`` (column ``key``; repeats count once, nulls find nothing), through the index."""
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = sorted((tuple(r) for r in directory.collect()), key=lambda e: e[0].encode())
    shared = spark.sparkContext.broadcast(entries)
    blocks = keys.where("key IS NOT NULL").select("key").distinct().mapInArrow(_find_blocks(shared), "key string, index_file string, block_offset long, block_length long")
    order = ["index_file", "block_offset", "key"]
    return blocks.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_search_blocks, _CAPTURE)


_RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def _read_records(with_payload: bool):
    def run(batches):
        read = RangeReader()
        names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"]
        types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            found = [parse(read(*place)) for place in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")))]
            if not with_payload:
                for f in found:
                    f["payload"] = None
            yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], t) for n, t in zip(names, types)], names=names)
        read.close()
    return run


def read_records(captures: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records at the captures' places, each file read in order: page, type, digest, size and reference, and the payload (null for revisits)."""
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (captures.select("file", "offset", "length").repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
            .mapInArrow(_read_records(with_payload), _RECORD))


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` (``page_id``, ``url``, ``html``), find every URL through the index and read the records back.

    Returns ``page_id``, ``payload_bytes``, ``payload_digest`` (SHA-1, hex), ``record_type`` and ``refers_to``. A null html
    is an empty payload; a null or odd url is its own key. Of equal payloads of at least 1000 bytes the largest page_id is
    the response (all its rows, if it repeats) and others revisit it; among rows without page_id only, all are responses. Repeated rows are each archived
    and returned; an empty table gives an empty result.
    """
    folder = fresh_path(pages.sparkSession, "warc")
    captures = write_archives(pages, folder)
    directory = build_index(captures, folder)
    found = lookup(captures.select("key"), directory)
    return read_records(found, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
