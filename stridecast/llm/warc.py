"""WARC archives in Zstandard form: written, then read back record by record.

An archive begins with a skippable frame that holds a dictionary; each record is one
Zstandard frame, compressed with it. The reader loads the dictionary from that frame,
decodes a frame at a time, and checks what it finds: version, named fields, block length,
block and payload digests, and the length that the HTTP headers give. Memory holds one
record, however long the archive.

Each writing task trains a dictionary on its own first records (``SAMPLE_BYTES`` of
them), so nothing passes through the driver. Files are named by the task attempt, and
only those in the manifest, written when the job is done, are read: a task that is lost
and run again leaves no record twice. Files are opened with ``pyarrow.fs``, which reaches
local, HDFS and object stores.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import zstandard
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridecast.llm.tables import stage
from stridecast.operators.lookup import attach
from stridecast.sources.shared import shared_folder

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FRAMES = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC, DICTIONARY_MAGIC = 0xFD2FB528, 0xEC30A437
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
MANDATORY = ("warc-record-id", "content-length", "warc-date", "warc-type")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An archive is closed, and the next one begun, beyond so many bytes.
ARCHIVE_BYTES = 1 << 30
#: A dictionary's size, the bytes of payload it is trained on, and the records needed for it.
DICTIONARY_BYTES, SAMPLE_BYTES, LEAST_SAMPLES = 1 << 15, 1 << 21, 16
LEVEL = 6
#: Bytes that are read at a time, and bytes of archives per reading task.
READ_BYTES, TASK_BYTES = 1 << 16, 1 << 27
#: Equal payloads of at least so many bytes are stored once.
LEAST_REVISIT = 0
#: The pages carry no date.
DATE = "2020-01-01T00:00:00Z"


def sha1_base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


# Writing


def _field(value: str) -> str:
    """A header value: control characters and spaces would break the line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(kind: str, record_id: str, fields: Iterable[tuple[str, str]], block: bytes, date: str = DATE) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        *(f"{name}: {value}" for name, value in fields),
        f"WARC-Block-Digest: sha1:{sha1_base32(hashlib.sha1(block).digest())}",
        f"Content-Length: {len(block)}",
    ]
    return b"".join(("\r\n".join(lines).encode(), b"\r\n\r\n", block, b"\r\n\r\n"))


class ArchiveWriter:
    """Frames on a sink; the dictionary goes before the first one."""

    def __init__(self, sink: BinaryIO, dictionary: bytes | None, level: int = LEVEL):
        self.sink, self.records, self.bytes = sink, 0, 0
        known = None
        if dictionary:
            known = zstandard.ZstdCompressionDict(dictionary)
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.bytes += len(data)

    def write(self, record: bytes) -> None:
        self._put(self.compressor.compress(record))
        self.records += 1


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes | None:
    """A dictionary from samples; None if they are too few or too short for one."""
    samples = [s for s in samples if len(s) >= 8]
    if len(samples) < LEAST_SAMPLES:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return None


class Page(NamedTuple):
    row: int
    page_id: int | None
    url: str | None
    payload: bytes | None  # null: the record is a revisit
    payload_bytes: int
    sha1: bytes
    first_row: int | None
    first_id: int | None
    first_url: str | None


def record_id(page_id: int | None, row: int) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{row}"


def page_record(page: Page) -> bytes:
    """The response record of a page, or a revisit of the page that has its payload."""
    own = record_id(page.page_id, page.row)
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page.payload_bytes}\r\n\r\n"
    ).encode()
    fields = [
        ("WARC-Target-URI", _field(page.url or own)),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(page.sha1)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page.payload is not None:
        return record_bytes("response", own, fields, http + page.payload)
    first = record_id(page.first_id, page.first_row)
    fields += [
        ("WARC-Profile", REVISIT_PROFILE),
        ("WARC-Refers-To", f"<{first}>"),
        ("WARC-Refers-To-Target-URI", _field(page.first_url or first)),
        ("WARC-Refers-To-Date", DATE),
    ]
    return record_bytes("revisit", own, fields, http)


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for values in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True):
                yield page_record(Page(*values))


def _write(folder: str, archive_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        store, root = FileSystem.from_uri(folder)
        records = _records(batches)
        samples, size = [], 0
        for record in records:
            samples.append(record)
            size += len(record)
            if size >= SAMPLE_BYTES:
                break
        # Long samples would outweigh the others.
        dictionary = train_dictionary([s[: SAMPLE_BYTES // LEAST_SAMPLES] for s in samples])
        waiting = iter(samples)
        number, record = 0, next(waiting, None)
        while record is not None:
            path = f"{name}-{number:04d}.warc.zst"
            with store.open_output_stream(f"{root}/{path}", compression=None) as sink:
                archive = ArchiveWriter(sink, dictionary)
                info = "software: stridecast\r\nformat: WARC File Format 1.1\r\n".encode()
                archive.write(
                    record_bytes("warcinfo", f"urn:archive:{path}", [("Content-Type", "application/warc-fields")], info)
                )
                # An archive has one page at least, however large its dictionary.
                while record is not None and (archive.records == 1 or archive.bytes < archive_bytes):
                    archive.write(record)
                    record = next(waiting, None)
                    if record is None and samples:
                        samples, waiting = [], records
                        record = next(waiting, None)
            yield pa.RecordBatch.from_pydict(
                {"path": [f"{folder}/{path}"], "records": [archive.records], "bytes": [archive.bytes]}
            )
            number += 1

    return run


def write_archives(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_revisit: int = LEAST_REVISIT,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Archives of all pages in the shared folder: a table of ``path, records, bytes``.

    Each row gives one record; its payload is the html in UTF-8 (null: empty). Of rows
    with equal payloads of at least ``least_revisit`` bytes the one with the smallest id
    (null last; of repeated ids the first row) is a response, and the others revisit it. A
    page without a url gets its record's own URN as target; control characters and spaces
    of a url are escaped. Records of an archive are in the order of the rows. An empty
    table gives no archive. Other columns are not looked at.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = stage(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(page_id).cast("long").alias("page_id"),
            F.col(url).alias("url"),
            payload.alias("payload"),
            F.octet_length(payload).cast("long").alias("payload_bytes"),
            F.unhex(F.sha1(payload)).alias("sha1"),
        ),
        "pages",
    )
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row", "url")).alias("first")
    groups = stage(
        rows.where(F.col("payload_bytes") >= least_revisit)
        .groupBy("sha1")
        .agg(first, F.count(F.lit(1)).alias("weight"))
        .where("weight > 1")
        .select(
            "sha1",
            F.col("first.row").alias("first_row"),
            F.col("first.page_id").alias("first_id"),
            F.col("first.url").alias("first_url"),
            "weight",
        ),
        "payloads",
    )
    known = attach(rows, groups, ["sha1"], "weight", how="left")
    revisit = F.coalesce(F.col("first_row") != F.col("row"), F.lit(False))
    revisit &= F.col("payload_bytes") >= least_revisit
    records = known.withColumn("payload", F.when(~revisit, F.col("payload"))).select(*Page._fields)
    folder = shared_folder(spark, "warc")
    store, root = FileSystem.from_uri(folder)
    store.create_dir(root)
    return stage(records.mapInArrow(_write(folder, archive_bytes), "path string, records long, bytes long"), "manifest")


# Reading


class Record(NamedTuple):
    offset: int
    record_type: str
    record_id: str
    date: str
    target_uri: str | None
    payload_digest: str | None
    payload_bytes: int
    refers_to: str | None
    payload: bytes


class _Source:
    """A stream with a look ahead."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.ahead, self.offset = stream, b"", 0

    def more(self) -> bytes:
        """What is ahead, or the next part of the stream."""
        data = self.ahead or self.stream.read(READ_BYTES)
        self.ahead = b""
        self.offset += len(data)
        return data

    def back(self, data: bytes) -> None:
        self.ahead = data + self.ahead
        self.offset -= len(data)

    def exactly(self, n: int) -> bytes:
        parts, have = [], 0
        while have < n:
            part = self.more()
            if not part:
                raise ValueError(f"archive ends at {self.offset}, within a frame")
            parts.append(part)
            have += len(part)
        data = b"".join(parts)
        if have > n:
            self.back(data[n:])
        return data[:n]

    def at_end(self) -> bool:
        data = self.more()
        self.back(data)
        return not data


def frames(stream: BinaryIO) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each frame; the dictionary comes from the leading one."""
    source = _Source(stream)
    decompressor = zstandard.ZstdDecompressor()
    while not source.at_end():
        offset = source.offset
        head = source.exactly(4)
        magic = struct.unpack("<I", head)[0]
        if magic in SKIPPABLE_FRAMES:
            content = source.exactly(struct.unpack("<I", source.exactly(4))[0])
            if offset == 0 and magic == DICTIONARY_FRAME:
                if content[:4] == struct.pack("<I", FRAME_MAGIC):
                    content = decompressor.decompressobj().decompress(content)
                if content[:4] != struct.pack("<I", DICTIONARY_MAGIC):
                    raise ValueError("the leading frame holds no dictionary")
                known = zstandard.ZstdCompressionDict(content)
                decompressor = zstandard.ZstdDecompressor(dict_data=known)
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no frame at {offset}")
        frame, parts, data = decompressor.decompressobj(), [], head
        while True:
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as e:
                raise ValueError(f"frame at {offset}: {e}") from e
            if frame.eof:
                break
            data = source.more()
            if not data:
                raise ValueError(f"archive ends within the frame at {offset}")
        source.back(frame.unused_data)
        yield offset, b"".join(parts)


def _fields(lines: list[bytes], what: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"{what}: malformed field {line[:80]!r}")
        if found.setdefault(name.lower(), value.strip()) != value.strip() and name.lower() != "warc-concurrent-to":
            raise ValueError(f"{what}: field {name} occurs twice")
    return found


def _length(fields: dict[str, str], what: str) -> int:
    value = fields["content-length"]
    if not (value.isascii() and value.isdigit()):
        raise ValueError(f"{what}: length {value!r}")
    return int(value)


def _verify(digest: str | None, data: memoryview, what: str) -> None:
    kind, _, value = (digest or "").partition(":")
    if kind.lower() == "sha1" and value != sha1_base32(hashlib.sha1(data).digest()):
        raise ValueError(f"{what}: digest {digest} does not match")


def parse_record(offset: int, content: bytes) -> Record:
    """The record that a frame holds; ValueError where it breaks the format."""
    what = f"record at {offset}"
    stop = content.find(b"\r\n\r\n")
    if stop < 0:
        raise ValueError(f"{what}: headers do not end")
    version, *lines = content[:stop].split(b"\r\n")
    if version not in VERSIONS:
        raise ValueError(f"{what}: version {version[:20]!r}")
    fields = _fields(lines, what)
    if missing := [name for name in MANDATORY if not fields.get(name)]:
        raise ValueError(f"{what}: lacks {', '.join(missing)}")
    begin, length = stop + 4, _length(fields, what)
    if len(content) != begin + length + 4 or content[begin + length :] != b"\r\n\r\n":
        raise ValueError(f"{what}: {len(content) - begin - 4} bytes of block, not {length}")
    block = memoryview(content)[begin : begin + length]
    _verify(fields.get("warc-block-digest"), block, what)
    kind, size, body = fields["warc-type"], length, block
    if fields.get("content-type", "").startswith("application/http"):
        end = content.find(b"\r\n\r\n", begin, begin + length)
        if end < 0 or not content.startswith(b"HTTP/", begin):
            raise ValueError(f"{what}: HTTP headers do not end")
        http = _fields(content[begin:end].split(b"\r\n")[1:], what)
        body = memoryview(content)[end + 4 : begin + length]
        size = _length(http, what) if "content-length" in http else len(body)
        if len(body) != (0 if kind == "revisit" else size):
            raise ValueError(f"{what}: {len(body)} bytes of payload, not {size}")
    if kind != "revisit":
        _verify(fields.get("warc-payload-digest"), body, what)
    elif not fields.get("warc-refers-to"):
        raise ValueError(f"{what}: revisit of nothing")
    digest = fields.get("warc-payload-digest")
    return Record(
        offset,
        kind,
        fields["warc-record-id"].strip("<>"),
        fields["warc-date"],
        fields.get("warc-target-uri"),
        digest.partition(":")[2] if digest else None,
        size,
        fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        body.tobytes(),
    )


def read_archive(stream: BinaryIO) -> Iterator[Record]:
    return (parse_record(offset, content) for offset, content in frames(stream))


_SCHEMA = (
    "path string, `offset` long, record_type string, record_id string, date string, target_uri string, "
    "payload_digest string, payload_bytes long, refers_to string"
)
_TYPES = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]
#: A batch of rows ends beyond so many records or bytes of payload.
BATCH_RECORDS, BATCH_BYTES = 4096, 1 << 24


def _read(with_payload: bool) -> Callable:
    names = ["path", *Record._fields][: None if with_payload else -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(zip(*rows, strict=True), _TYPES, strict=False)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns][: len(names)], names)

        for paths in batches:
            for path in paths.column(0).to_pylist():
                store, name = FileSystem.from_uri(path)
                rows, size = [], 0
                with store.open_input_stream(name, compression=None) as stream:
                    try:
                        for record in read_archive(stream):
                            rows.append((path, *record)[: len(names)])
                            size += len(record.payload) if with_payload else 0
                            if len(rows) >= BATCH_RECORDS or size >= BATCH_BYTES:
                                yield batch(rows)
                                rows, size = [], 0
                    except ValueError as e:
                        raise ValueError(f"{path}: {e}") from e
                if rows:
                    yield batch(rows)

    return run


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of ``archives``, a table with ``path`` and ``bytes``: one row each, with
    ``path, offset, record_type, record_id, date, target_uri, payload_digest,
    payload_bytes, refers_to`` and, unless unwanted, ``payload``.

    ``payload_bytes`` is the length of the full payload, also for a revisit, whose
    ``payload`` is empty. A task reads about ``TASK_BYTES`` of archives. An archive that
    breaks the format ends the job with its path and the place.
    """
    spark = archives.sparkSession
    total = archives.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).first()
    tasks = max(1, min(total.n, max((total.bytes or 0) // TASK_BYTES + 1, spark.sparkContext.defaultParallelism)))
    schema = f"{_SCHEMA}, payload binary" if with_payload else _SCHEMA
    return archives.select("path").repartition(tasks).mapInArrow(_read(with_payload), schema)


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """The archives of a folder, as ``read_archives`` takes them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("path", F.col("length").alias("bytes"))


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages written to archives and read back: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``, a row per page (see ``write_archives``).

    Size and digest (bare base32 SHA-1) are those of the full payload, also for a
    revisit; ``refers_to`` is the id of the response that a revisit refers to, else null.
    """
    read = read_archives(write_archives(pages, page_id, url, html), with_payload=False)

    def page_of(urn: str) -> Column:
        return F.nullif(F.split_part(F.col(urn), F.lit(":"), F.lit(3)), F.lit("")).cast("long")

    return read.where("record_type in ('response', 'revisit')").select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of("refers_to").alias("refers_to"),
    )


ORACLE = r"""
WITH d AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), h AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM d
), r AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM h
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
           1 + ((('0x' || hex[5 * (i // 4) + 1 : 5 * (i // 4) + 5])::BIGINT >> (5 * (3 - i % 4))) & 31)]
       ), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM r
"""
