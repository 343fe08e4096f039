"""WARC archives packaged as ZIP files: writer and range reader (operator 2).

Writer.  Each task streams one archive: a ZIP file whose members are stored,
``archive/data.warc.gz`` with the records, each a gzip stream of its own, and
``indexes/index.cdx`` with the place of each record.  Sizes and offsets are given in ZIP64 fields, so an
archive may pass 4 GB, and sizes follow the data (data descriptors), so
nothing is held back but the index lines.  Spark's text sink writes the bytes
(the stream is cut where it has a line feed, which the sink adds again; the
last one is the archive's one-byte comment), so archives go to any file system that Spark
writes to, through its commit protocol: a lost task leaves nothing behind.

Reader.  One task per archive reads the end of the file, the ZIP64 records
and the central directory, and locates the stored members; the index member
gives the records' places, which are dealt out in blocks; tasks then read the
records by byte range.  Nothing is extracted, and no archive is read whole.

Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the
largest page_id is a response and the others revisit it.

Defined results: a null html is an empty payload; a null url has no
target URI; a null page_id is written without an id and never referred to;
rows repeating the response's page_id are responses too; an empty table gives
no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_parts, small_batches, worker_path

REVISIT_BYTES = 1000
BLOCK_BYTES = 1 << 20  # records of one block are read by one task
CHUNK_BYTES = 1 << 16
DATE = "2024-01-01T00:00:00Z"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
INDEX_HEAD = b"!cdx offset length page_id\n"

# Fixed values of the ZIP format: signatures, and markers of values kept in ZIP64 fields
LOCAL, DESCRIPTOR, CENTRAL = 0x04034B50, 0x08074B50, 0x02014B50
END, END64, LOCATOR64 = 0x06054B50, 0x06064B50, 0x07064B50
ZIP64_EXTRA = 1
NONE32, NONE16 = 0xFFFFFFFF, 0xFFFF
STORED, DEFLATED = 0, 8
VERSION = 45  # first with ZIP64
FLAGS = 0x0008 | 0x0800  # sizes follow the data; names are UTF-8
DOS_DATE = 0x5821  # 2024-01-01

# Fixed value of the WARC format
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- writing -------------------------------------------------------------------------------------


def _uri(url: str) -> str:
    """Control characters and spaces would end a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Date", DATE), *headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The record of one page; a revisit has the HTTP headers only."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    headers = [("WARC-Record-ID", f"<urn:page:{page_id}>" if page_id is not None else "<urn:page:none>")]
    if url is not None:
        headers.append(("WARC-Target-URI", _uri(url)))
    headers.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return warc_record("response", [*headers, ("Content-Type", "application/http; msgtype=response")], http + payload)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
                ("Content-Type", "application/http; msgtype=response")]
    return warc_record("revisit", headers, http)


@dataclass
class Member:
    name: str
    method: int
    crc: int
    size: int
    offset: int  # of the local header


def _local_header(name: str) -> bytes:
    raw = name.encode()
    extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, 0, 0)
    return struct.pack("<IHHHHHIIIHH", LOCAL, VERSION, FLAGS, STORED, 0, DOS_DATE, 0, NONE32, NONE32, len(raw), len(extra)) + raw + extra


def _descriptor(m: Member) -> bytes:
    return struct.pack("<IIQQ", DESCRIPTOR, m.crc, m.size, m.size)


def _directory(members: list[Member], at: int) -> bytes:
    """Central directory, ZIP64 end record, its locator and the end record with a one-byte comment."""
    out = b""
    for m in members:
        raw = m.name.encode()
        extra = struct.pack("<HHQQQ", ZIP64_EXTRA, 24, m.size, m.size, m.offset)
        out += struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, VERSION, VERSION, FLAGS, m.method, 0, DOS_DATE, m.crc, NONE32, NONE32,
                           len(raw), len(extra), 0, 0, 0, 0, NONE32) + raw + extra
    end64 = struct.pack("<IQHHIIQQQQ", END64, 44, VERSION, VERSION, 0, 0, len(members), len(members), len(out), at)
    locator = struct.pack("<IIQI", LOCATOR64, 0, at + len(out), 1)
    end = struct.pack("<IHHHHIIH", END, 0, 0, NONE16, NONE16, NONE32, NONE32, 1)
    return out + end64 + locator + end + b"\n"


def text_lines(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """A byte stream that ends with a line feed, as lines for a sink that ends
    each with a line feed: cut after the last line feed of every CHUNK_BYTES or more."""
    held = bytearray()
    for chunk in chunks:
        held += chunk
        if len(held) >= CHUNK_BYTES and (at := held.rfind(b"\n")) >= 0:
            yield bytes(held[:at])
            del held[: at + 1]
    if held:  # else the last cut took all
        if held[-1:] != b"\n":
            raise ValueError("the stream does not end with a line feed")
        yield bytes(held[:-1])


def archive_chunks(pages: Iterator[tuple]) -> Iterator[bytes]:
    """Bytes of one archive; the last is a line feed.  pages: (page_id, url, payload, refers_to)."""
    data = Member(DATA, STORED, 0, 0, 0)
    info = warc_record("warcinfo", [("WARC-Record-ID", "<urn:page:info>"), ("Content-Type", "application/warc-fields")],
                       b"format: WARC File Format 1.1\r\n")
    info = gzip.compress(info, mtime=0)
    head = _local_header(DATA)
    data.crc, data.size = zlib.crc32(info), len(info)
    yield head + info
    lines = [INDEX_HEAD]
    for page_id, url, payload, refers_to in pages:
        record = gzip.compress(page_record(page_id, url, payload, refers_to), 6, mtime=0)
        lines.append(b"%d %d %s\n" % (data.size, len(record), b"-" if page_id is None else str(page_id).encode()))
        data.crc = zlib.crc32(record, data.crc)
        data.size += len(record)
        yield record
    at = len(head) + data.size
    body = b"".join(lines)
    between = _descriptor(data)
    index = Member(INDEX, STORED, zlib.crc32(body), len(body), at + len(between))
    head = _local_header(INDEX)
    yield between + head + body
    at = index.offset + len(head) + len(body)
    tail = _descriptor(index)
    yield tail + _directory([data, index], at + len(tail))


def write_archives(pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES) -> str:
    """Write a record per row of ``pages`` (page_id, url, html) into archives below ``folder``."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    keyed = rows.withColumn("same", F.when(F.length("payload") >= revisit_bytes, F.sha2("payload", 256)))
    owners = keyed.where("same is not null").groupBy("same").agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n"))
    owners = owners.where("n > 1 and owner is not null").select("same", "owner")
    placed = keyed.join(owners, "same", "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("owner")), None).otherwise(F.col("owner"))
    placed = placed.select("page_id", "url", "payload", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for b in batches:
                yield from zip(*(b.column(i).to_pylist() for i in range(4)))

        for line in text_lines(archive_chunks(each())):
            yield pa.RecordBatch.from_arrays([pa.array([line], pa.binary())], names=["value"])

    chunks = placed.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    chunks.write.option("compression", "none").option("maxRecordsPerFile", 0).text(folder)  # one file per task
    return folder


# --- reading -------------------------------------------------------------------------------------


class RangeFile:
    """Random access to one file of the shared store by (offset, length)."""

    def __init__(self, path: str):
        from pyarrow import fs

        uri = re.sub(r"^file:/+", "file:///", path)
        store, name = fs.FileSystem.from_uri(uri)
        self.file = store.open_input_file(name)
        self.size = self.file.size()

    def read(self, offset: int, length: int) -> bytes:
        raw = self.file.read_at(length, offset)
        if len(raw) != length:
            raise ValueError(f"{length} bytes at {offset} wanted, {len(raw)} read")
        return raw

    def close(self) -> None:
        self.file.close()


def central_directory(f: RangeFile) -> list[Member]:
    """Members of an archive, by the end record, the ZIP64 records and the central directory."""
    tail_size = min(f.size, 22 + NONE16 + 20)
    tail = f.read(f.size - tail_size, tail_size)
    at = len(tail) - 22
    while at >= 0:
        at = tail.rfind(struct.pack("<I", END), 0, at + 4)
        if at < 0:
            raise ValueError("no end of central directory")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at -= 1
    count, size, offset = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and struct.unpack_from("<I", tail, at - 20)[0] == LOCATOR64:
        end64 = f.read(struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if struct.unpack_from("<I", end64)[0] != END64:
            raise ValueError("no ZIP64 end record where its locator points")
        count, size, offset = struct.unpack_from("<QQQ", end64, 32)
    raw, at, members = f.read(offset, size), 0, []
    for _ in range(count):
        (sig, _, _, _, method, _, _, crc, stored, full, n_name, n_extra, n_comment, _, _, _, where) = struct.unpack_from(
            "<IHHHHHHIIIHHHHHII", raw, at)
        if sig != CENTRAL:
            raise ValueError("broken central directory")
        name = raw[at + 46: at + 46 + n_name].decode("utf-8")
        extra = raw[at + 46 + n_name: at + 46 + n_name + n_extra]
        full, stored, where = _zip64(extra, full, stored, where)
        members.append(Member(name, method, crc, stored, where))
        at += 46 + n_name + n_extra + n_comment
    return members


def _zip64(extra: bytes, *values: int) -> list[int]:
    """Values that the 32-bit fields leave to the ZIP64 field, in order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_EXTRA:
            longs = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(longs) if v == NONE32 else v for v in values]
        at += 4 + size
    return list(values)


def data_start(f: RangeFile, m: Member) -> int:
    """Offset of a stored member's first byte (the local header has its own name and extra lengths)."""
    if m.method != STORED:
        raise ValueError(f"{m.name} is compressed: its records cannot be read by range")
    head = f.read(m.offset, 30)
    if struct.unpack_from("<I", head)[0] != LOCAL:
        raise ValueError("no local header where the directory points")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return m.offset + 30 + n_name + n_extra


def index_lines(f: RangeFile, start: int, size: int, step: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records in the data member, read in steps."""
    rest = b""
    for at in range(start, start + size, step):
        *lines, rest = (rest + f.read(at, min(step, start + size - at))).split(b"\n")
        for line in lines:
            if not line.startswith(b"!"):
                offset, length, _ = line.split(b" ")
                yield int(offset), int(length)
    if rest:
        raise ValueError("the index ends within a line")


def parse_record(raw: bytes) -> tuple:
    """(page_id, payload bytes, payload SHA-1 in hex, type, refers_to); the payload is checked against its digest."""
    head, _, block = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    page_id = fields["WARC-Record-ID"][len("<urn:page:"):-1]
    refers_to = None
    if fields["WARC-Type"] == "response":
        if len(payload) != said or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"page {page_id}: the payload does not match its digest")
    else:
        refers_to = int(fields["WARC-Refers-To"][len("<urn:page:"):-1])
    return (None if page_id == "none" else int(page_id), said, digest, fields["WARC-Type"], refers_to)


_PLACE = "path string, start long, length long"
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page record of the archives in ``folder``."""
    small_batches(spark)
    worker_path(spark)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                f = RangeFile(path)
                members = {m.name: m for m in central_directory(f)}
                start = data_start(f, members[DATA])
                out: list[tuple[int, int]] = []
                for offset, length in index_lines(f, data_start(f, members[INDEX]), members[INDEX].size):
                    if offset + length > members[DATA].size:
                        raise ValueError("a record lies outside its member")
                    out.append((start + offset, length))
                    if len(out) == 4096:
                        yield _places(path, out)
                        out = []
                yield _places(path, out)
                f.close()

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, f = None, None
        for b in batches:
            rows = []
            for at, start, length in zip(*(b.column(i).to_pylist() for i in range(3))):
                if at != path:
                    if f is not None:
                        f.close()
                    path, f = at, RangeFile(at)
                rows.append(parse_record(gzip.decompress(f.read(start, length))))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = spark.read.format("binaryFile").load(folder).select("path").repartition(shuffle_parts(spark))
    dealt = files.mapInArrow(places, _PLACE).repartition(
        shuffle_parts(spark), F.col("path"), F.floor(F.col("start") / BLOCK_BYTES)).sortWithinPartitions("path", "start")
    return dealt.mapInArrow(records, _RECORD)


def _places(path: str, rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int64()),
         pa.array([r[1] for r in rows], pa.int64())], names=["path", "start", "length"])
