"""WARC archives: a writer for pages, and a salvage reader that goes on after damage.

Every record is a gzip member of its own. Spark's text sink writes the members, so files are committed
by Spark's own protocol to whatever storage the path names; its line separator is an empty gzip member,
which holds no data. The reader takes compressed and plain archives. After a failed check it searches
for the next member that opens with a version line, or the next version line, reads on from there, and
logs the bytes between as a gap. A member may hold several records: after a failed one the reader goes on
at the next version line of its content, and of a broken member it keeps the records that pass their own checks (a digest covers the payload, not the
header), unless it holds one record only, which must be the broken one.

Payloads with equal SHA-1 and at least ``least_bytes`` bytes are stored once: the record of the largest
id is the response, the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from .common import scratch, spread, text_slices

VERSION = b"WARC/1.1"
LEVEL = 3
#: An empty gzip member.
EMPTY = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + b"\x00" * 8
_MAGIC = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/\d\.\d\r?\n")
#: Bytes of an archive that are unpacked at a time.
CHUNK = 1 << 15
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(value: str) -> bytes:
    """A header value on one line; what a line cannot hold is percent-encoded."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in value).encode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str | None = None) -> bytes:
    """One record, uncompressed. A revisit names its response and carries the payload's size, not the payload."""
    digest = digest or sha1_base32(payload)
    body = b"" if refers_to is not None else payload
    lines = [
        VERSION,
        b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: <urn:page:%s>" % str(page_id).encode(),
        b"WARC-Target-URI: " + _field(url or ""),
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"X-Payload-Length: %d" % len(payload),
        b"Content-Type: text/html; charset=utf-8",
    ]
    if refers_to is not None:
        lines += [b"WARC-Profile: " + REVISIT.encode(), b"WARC-Refers-To: <urn:page:%d>" % refers_to]
    lines.append(b"Content-Length: %d" % len(body))
    return b"\r\n".join(lines) + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    payload: bytes


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


def _parse(data: bytes, at: int) -> tuple[Record, int]:
    """The record at a position and the position after it; ``ValueError`` says what is wrong."""
    first = _VERSION_LINE.match(data, at)
    if not first:
        raise ValueError("no version line")
    end, skip = data.find(b"\r\n\r\n", at), 4
    if end < 0:
        raise ValueError("unfinished header")
    headers = {}
    for line in data[first.end() : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("bad header line")
        headers[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise ValueError("no content length")
    start = end + skip
    stop = start + int(length)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("wrong content length")
    payload = data[start:stop]
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") != "revisit" and digest.startswith("sha1:") and digest[5:] != sha1_base32(payload):
        raise ValueError("wrong payload digest")
    return Record(at, headers, payload), stop + 4


def _unpack(data: bytes, at: int) -> tuple[bytes, int, str]:
    """A gzip member's content, the position after it, and what is wrong with it: then the content is as much as could be unpacked."""
    reader, parts, fed = zlib.decompressobj(31), [], at
    while not reader.eof and fed < len(data):
        before = reader.copy()
        try:
            parts.append(reader.decompress(data[fed : fed + CHUNK]))
        except zlib.error as error:
            return b"".join([*parts, _rest(before, data[fed : fed + CHUNK])]), fed, str(error)
        fed = min(len(data), fed + CHUNK)
    return b"".join(parts), fed - len(reader.unused_data), "" if reader.eof else "unfinished member"


def _rest(reader, chunk: bytes) -> bytes:
    """What a chunk that fails gives before it does."""
    parts, size = [], len(chunk)
    while size:
        before = reader.copy()
        try:
            parts.append(reader.decompress(chunk[:size]))
            chunk = chunk[size:]
            size = min(size, len(chunk))
        except zlib.error:
            reader, size = before, size // 2
    return b"".join(parts)


def _parse_all(content: bytes) -> Iterator[tuple[Record | None, str]]:
    """The records of a member's content; in place of what is in none of them, the reason."""
    at = 0
    while at < len(content):
        try:
            rec, at = _parse(content, at)
            yield rec, ""
        except ValueError as error:
            at = _next_start(content, at + 1, False)
            yield None, str(error)


def _opens_record(data: bytes, at: int) -> bool:
    """Whether a member begins here that opens with a version line; only its first bytes are unpacked."""
    try:
        head = zlib.decompressobj(31).decompress(data[at : at + 512], 16)
    except zlib.error:
        return False
    return bool(_VERSION_LINE.match(head))


def _next_start(data: bytes, at: int, packed: bool) -> int:
    """Where the next record may begin after damage; the end of the data if nowhere."""
    if packed:
        while (at := data.find(_MAGIC, at)) >= 0:
            if _opens_record(data, at):
                return at
            at += 1
        return len(data)
    found = _VERSION_LINE.search(data, at)
    return found.start() if found else len(data)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """All records that pass their checks, and a gap for each stretch of bytes in none of them.

    A member that is broken, or holds bytes in no record, is a gap as a whole; its records come before it.
    """
    at, gap, reason = 0, -1, ""
    packed = data.startswith(_MAGIC) or not _VERSION_LINE.match(data) and _MAGIC in data
    while at < len(data):
        found: list[Record] = []
        wrong = ""
        if packed:
            content, after, broken = _unpack(data, at)
            parsed = list(_parse_all(content))
            wrong = next((failed for _, failed in [(None, broken), *parsed] if failed), "")
            if not broken or len(parsed) > 1:  # the only record of a broken member is the broken one
                found = [rec for rec, _ in parsed if rec]
            for rec in found:
                rec.offset = at
        else:
            try:
                rec, after = _parse(data, at)
                found.append(rec)
            except ValueError as error:
                wrong = str(error)
        if gap >= 0 and (found or not wrong):
            yield Gap(gap, at - gap, reason)
            gap = -1
        yield from found
        if not wrong:
            at = after
            continue
        if gap < 0:
            gap, reason = at, wrong
        at = _next_start(data, at + 1, packed)
    if gap >= 0:
        yield Gap(gap, len(data) - gap, reason)


def mark_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int = 0) -> DataFrame:
    """``(page_id, url, payload, digest, refers_to)``: ``refers_to`` is null for responses.

    Only (digest, id) is grouped; the pages themselves meet the digests' largest ids in a join whose hot
    digests Spark can split. Pages without an id are responses. Rows with equal ids and payloads refer
    to the same response and are responses themselves if that id is theirs.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = spread(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")))
    rows = rows.withColumn("digest", F.sha1("payload"))
    own = pages.select(F.col(id_col).alias("page_id"), payload.alias("payload")).where(F.octet_length("payload") >= least_bytes)
    last = cut_lineage(own.groupBy(F.sha1("payload").alias("digest")).agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null").select("digest", "last"))
    joined = rows.join(last, "digest", "left")
    return joined.select("page_id", "url", "payload", "digest", F.when(F.col("last") != F.col("page_id"), F.col("last")).alias("refers_to"))


def write(marked: DataFrame, path: str, level: int = LEVEL) -> None:
    """Archives of all rows of ``marked`` below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "payload"):
            rows = zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")))
            packed = [member(record(p, u, body, refers, base64.b32encode(bytes.fromhex(d)).decode()), level) for p, u, body, d, refers in rows]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["member"])

    members = marked.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value"))
    members.write.option("lineSep", EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(file, offset, length, kind, reason, headers, payload)``: a row of kind ``record`` or ``gap`` for each stretch.

    A file is read as a whole by one task, so archives should have the usual size of a gigabyte or less.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for name, data in zip(part.column("path"), part.column("content")):
                name, some, size = name.as_py(), [], 0
                for x in salvage(data.as_py()):
                    gap = isinstance(x, Gap)
                    some.append((name, x.offset, x.length if gap else None, "gap" if gap else "record", x.reason if gap else None, None if gap else list(x.headers.items()), None if gap else x.payload))
                    size += 0 if gap else len(x.payload)
                    if size > 4 << 20:
                        yield rows(some)
                        some, size = [], 0
                if some:
                    yield rows(some)

    kinds = {"file": pa.string(), "offset": pa.int64(), "length": pa.int64(), "kind": pa.string(), "reason": pa.string(), "headers": pa.map_(pa.string(), pa.string()), "payload": pa.binary()}

    def rows(some: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), kinds.values())], list(kinds))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(run, "file string, offset long, length long, kind string, reason string, headers map<string,string>, payload binary")


def records(found: DataFrame) -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to)`` of the records of ``read``.

    Size and digest of a response are of the payload that was read; a revisit states those of the payload it stands for.
    """
    at = lambda name: F.col("headers")[name]
    id_in = lambda name: F.regexp_extract(at(name), r"<urn:page:(-?\d+)>", 1).try_cast("long")
    kind = at("warc-type")
    return found.where("kind = 'record'").select(
        id_in("warc-record-id").alias("page_id"),
        at("warc-target-uri").alias("url"),
        F.when(kind == "response", F.octet_length("payload").cast("long")).otherwise(at("x-payload-length").try_cast("long")).alias("payload_bytes"),
        F.substring_index(at("warc-payload-digest"), ":", -1).alias("payload_digest"),
        kind.alias("record_type"),
        id_in("warc-refers-to").alias("refers_to"),
    )


def gaps(found: DataFrame) -> DataFrame:
    """The quarantine log: ``(file, offset, length, reason)``."""
    return found.where("kind = 'gap'").select("file", "offset", "length", "reason")


def round_trip(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int = 0) -> DataFrame:
    """Archives of the pages in the shared folder, read back."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write(mark_revisits(pages, id_col, url_col, payload_col, least_bytes), path)
    return records(read(spark, path))
