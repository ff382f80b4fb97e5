"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Every record is a gzip member of its own, or plain text. The reader checks each
record: the member's checksum, the version line, the lengths, the end of the
record and the digest of its payload. After a failed check it searches for the
next member or version line at which a valid record starts, goes on from there,
and logs the bytes between as quarantined.

Files are written and read inside Spark's tasks, in a folder that all executors
share, by whatever file system its address names. A task's files have names of
their own, and only those of tasks that succeeded are listed, so that a repeated
task leaves no record twice.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.session import scratch_path, written

#: Payloads below this size are never written as revisits.
REVISIT_BYTES = 100
#: Bytes of an archive file, about, before the next one is begun.
FILE_BYTES = 1 << 27
DATE = "2000-01-01T00:00:00Z"

_READ = 1 << 16
_LONGEST_HEADER = 1 << 16
_VERSION = re.compile(rb"WARC/(?:0\.1[78]|1\.[01])\r?\n")
_MAGIC = b"\x1f\x8b\x08"
# Fields of our own: the page's id, and that of the page whose payload is the same.
_PAGE, _REFERS = "Page-ID", "Refers-To-Page-ID"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class Record:
    """One record as it was read, and the bytes of the file that it takes."""

    offset: int
    length: int
    headers: dict[str, str]
    block: bytes = field(repr=False)

    def http(self) -> tuple[dict[str, str], bytes]:
        """The headers of the HTTP response in the block, and its payload."""
        head, _, payload = self.block.partition(b"\r\n\r\n")
        return _fields(head.split(b"\r\n")[1:]), payload


@dataclass
class Gap:
    """Bytes of a file that hold no valid record."""

    offset: int
    length: int
    reason: str


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines if b":" in line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def info_record(name: str, date: str = DATE) -> bytes:
    """The record that opens an archive and tells about it."""
    headers = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
        ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
    ]
    return record_bytes(headers, b"software: tallymill\r\nformat: WARC File Format 1.1\r\n")


def page_record(page_id, url: str, payload: bytes, digest: str, refers_to, refers_url: str | None = None, date: str = DATE) -> bytes:
    """A response, or a revisit of the response of ``refers_to`` if that is not None.

    Records have ids of their own. The page's id, which may be missing or repeat, is a field beside it.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _header(url)),
        (_PAGE, "" if page_id is None else str(page_id)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers_to is None:
        return record_bytes(headers, http + payload)
    refers = [("WARC-Profile", _PROFILE), (_REFERS, str(refers_to)), ("WARC-Refers-To-Date", date)]
    if refers_url is not None:
        refers.append(("WARC-Refers-To-Target-URI", _header(refers_url)))
    return record_bytes([*headers, *refers], http)


def _header(value: str) -> str:
    """Line breaks and other controls cannot stand in a header."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


class _Broken(Exception):
    pass


class SalvageReader:
    """Reads the records and gaps of one archive, holding no more than a record at a time."""

    def __init__(self, file: BinaryIO, size: int, longest: int = 1 << 30):
        self._file, self._size, self._longest = file, size, longest

    def __iter__(self) -> Iterator[Record | Gap]:
        at = 0
        while at < self._size:
            try:
                record = self._record(at)
            except _Broken as broken:
                found = self._next(at + 1)
                yield Gap(at, found - at, str(broken))
                at = found
            else:
                yield record
                at += record.length

    def _read(self, at: int, n: int) -> bytes:
        self._file.seek(at)
        return self._file.read(min(n, self._size - at))

    def _next(self, at: int) -> int:
        """The next place at which a record may start: a member that unpacks to a version line, or such a line."""
        overlap = 16
        while at < self._size:
            chunk = self._read(at, _READ * 16)
            for match in re.finditer(rb"\x1f\x8b\x08|WARC/[01]\.", chunk):
                place = at + match.start()
                if match[0] != _MAGIC:
                    if _VERSION.match(self._read(place, 16)):
                        return place
                elif self._opens_record(place):
                    return place
            if at + len(chunk) >= self._size:
                break
            at += len(chunk) - overlap
        return self._size

    def _opens_record(self, at: int) -> bool:
        try:
            return bool(_VERSION.match(zlib.decompressobj(31).decompress(self._read(at, 4096), 64)))
        except zlib.error:
            return False

    def _record(self, at: int) -> Record:
        if self._read(at, 3) == _MAGIC:
            data, length = self._member(at)
            headers, start, size = self._head(data)
            if len(data) != start + size + 4 or data[-4:] != b"\r\n\r\n":
                raise _Broken("the record's length does not fit its member")
            return self._checked(Record(at, length, headers, data[start : start + size]))
        headers, start, size = self._head(self._read(at, _LONGEST_HEADER))
        data = self._read(at + start, size + 4)
        if len(data) != size + 4 or data[-4:] != b"\r\n\r\n":
            raise _Broken("the record's length does not lead to its end")
        return self._checked(Record(at, start + size + 4, headers, data[:size]))

    def _member(self, at: int) -> tuple[bytes, int]:
        unpacker, parts, held, place = zlib.decompressobj(31), [], 0, at
        try:
            while not unpacker.eof:
                chunk = self._read(place, _READ)
                if not chunk:
                    raise _Broken("the member is cut off")
                place += len(chunk)
                parts.append(unpacker.decompress(chunk))
                held += len(parts[-1])
                if held > self._longest:
                    raise _Broken("the member is too long")
        except zlib.error as error:
            raise _Broken(f"the member cannot be unpacked: {error}") from None
        return b"".join(parts), place - len(unpacker.unused_data) - at

    def _head(self, data: bytes) -> tuple[dict[str, str], int, int]:
        version = _VERSION.match(data)
        if not version:
            raise _Broken("no version line")
        end = data.find(b"\r\n\r\n", version.end() - 2)
        if end < 0:
            raise _Broken("the header has no end")
        lines = data[version.end() : end].split(b"\r\n")
        headers = _fields(lines)
        names = [line.partition(b":")[0].strip().lower() for line in lines]
        if any(names.count(name) > 1 for name in (b"warc-type", b"warc-record-id", b"content-length")):
            raise _Broken("the header runs into that of another record")
        size = headers.get("content-length", "")
        if not size.isdigit() or int(size) > self._longest:
            raise _Broken("no length")
        return headers, end + 4, int(size)

    @staticmethod
    def _checked(record: Record) -> Record:
        kind, _, digest = record.headers.get("warc-payload-digest", "").partition(":")
        if record.headers.get("warc-type") == "response" and kind == "sha256":
            if hashlib.sha256(record.http()[1]).hexdigest() != digest:
                raise _Broken("the payload's digest is another")
        return record


def shared_address(spark: SparkSession, folder: str) -> str:
    """The folder's full address, as Spark's own file-system settings read it, and as tasks can open it.

    A path without a scheme lies in Spark's default file system, wherever that is.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    address = re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "file:///", whole))
    try:
        _place(address)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as error:
        raise ValueError(f"archives cannot be written to {whole}: {error}") from error
    return address


def _place(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(address)


def write_archives(
    pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
    packed: bool = True, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record for each row and return the list of archives: ``path``, ``records``, ``bytes``.

    Of rows with equal payloads of at least 100 bytes, those of the smallest id are
    responses and the others revisit it; all other rows are responses. A row
    with a null id revisits the smallest id, but is never revisited. Null payloads
    and urls are written as empty, and an empty table gives no archive. The
    payloads are not shuffled unless very many of them repeat.
    """
    payload = F.coalesce(F.col(payload_column), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(url_column), F.lit("")).alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    # Written first, so that its size is known when the rows are joined with it.
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "url")))
    repeated = written(
        rows.filter(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(first.alias("found"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND found IS NOT NULL")
        .select(F.col("digest").alias("d"), F.col("found.id").alias("first"), F.col("found.url").alias("refers_url")),
        "repeated-payloads",
    )
    small = F.octet_length("payload") < REVISIT_BYTES
    refers = F.when(~small & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.join(repeated, F.col("digest") == F.col("d"), "left").select(
        "id", "url", "payload", "digest", refers.alias("refers_to"), "refers_url"
    )
    folder = shared_address(pages.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _place(folder)
        filesystem.create_dir(base, recursive=True)
        stream, name, records, size = None, "", 0, 0

        def listed() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"]
            )

        for batch in batches:
            columns = [batch.column(c) for c in ("id", "url", "payload", "digest", "refers_to", "refers_url")]
            for row in zip(*columns):
                if stream is None:
                    name = f"{base}/{uuid.uuid4().hex}.warc" + (".gz" if packed else "")
                    stream, records = filesystem.open_output_stream(name, compression=None), 0
                    info = info_record(name.rpartition("/")[2])
                    size = stream.write(member(info) if packed else info)
                record = page_record(*(value.as_py() for value in row))
                data = member(record) if packed else record
                stream.write(data)
                records, size = records + 1, size + len(data)
                if size >= file_bytes:
                    yield listed()
                    stream = None
        if stream is not None:
            yield listed()

    return written(rows.mapInArrow(write, "path string, records long, bytes long"), "archives")


def read_archives(spark: SparkSession, paths: DataFrame, folder: str) -> DataFrame:
    """What the archives in column ``path`` hold, one row per record or gap.

    ``path``, ``offset``, ``length``; for records ``record_type``, ``page_id``,
    ``refers_to``, ``url``, ``payload_bytes``, ``payload_digest``; for gaps the
    ``reason`` why the bytes are quarantined. ``folder`` names the file system.
    Records of other types than response and revisit have null payload columns.
    """
    names = ["path", "offset", "length", "record_type", "page_id", "refers_to", "url", "payload_bytes", "payload_digest", "reason"]
    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.string()]

    folder = shared_address(spark, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _place(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                size = filesystem.get_file_info(path).size
                with filesystem.open_input_file(path) as file:
                    rows = []
                    for item in SalvageReader(file, size):
                        rows.append(_described(path, item))
                        if len(rows) == 4096:
                            yield batch_of(rows)
                            rows = []
                    if rows:
                        yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    schema = (
        "path string, offset long, length long, record_type string, page_id string, refers_to string, url string, "
        "payload_bytes long, payload_digest string, reason string"
    )
    # One archive is one unit of work, whatever their number.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return paths.select("path").repartition(tasks, "path").mapInArrow(read, schema)


def _described(path: str, item: Record | Gap) -> tuple:
    if isinstance(item, Gap):
        return (path, item.offset, item.length, *[None] * 6, item.reason)
    headers = item.headers
    kind = headers.get("warc-type")
    size = digest = None
    if kind in ("response", "revisit"):
        http, payload = item.http()
        digest = headers.get("warc-payload-digest", "").partition(":")[2]
        length = http.get("content-length", "")
        size = len(payload) if kind == "response" else int(length) if length.isdigit() else None
    return (
        path, item.offset, item.length, kind, headers.get(_PAGE.lower()) or None, headers.get(_REFERS.lower()),
        headers.get("warc-target-uri"), size, digest, None,
    )


def missing(archives: DataFrame, rows: DataFrame) -> tuple[int, int]:
    """How many records of ``archives`` were not read back, and how many gaps there are instead."""
    wrote = archives.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    is_page = F.col("record_type").isin("response", "revisit")
    found, gaps = rows.agg(F.count_if(is_page), F.count_if(F.col("reason").isNotNull())).first()
    return wrote - found, gaps


def round_trip(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", folder: str | None = None
) -> DataFrame:
    """Write ``pages`` to archives and read them back: a row per page, taken from its record.

    Pages whose records are not read back raise, with the number of quarantined gaps:
    none is missing silently. The archives go with the driver unless ``folder`` names a
    place for them.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc") if folder is None else folder
    archives = write_archives(pages, folder, id_column, url_column, payload_column)
    rows = written(read_archives(spark, archives, folder), "warc-records")
    lost, gaps = missing(archives, rows)
    if lost or gaps:
        raise RuntimeError(f"{lost} records were not read back from {folder}; {gaps} gaps are quarantined")
    id_type = pages.schema[id_column].dataType
    return rows.filter(F.col("record_type").isin("response", "revisit")).select(
        F.col("page_id").cast(id_type).alias(id_column), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )
