"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Writing: of records with equal payloads of at least ``revisit_bytes`` bytes the one with the smallest id is a
response; the others are revisits that name it and hold no payload. Each record is a gzip member of its own and
carries digests of its block and payload. A task writes one file of its rows, under a name that no other
attempt uses; only files in the stored manifest count.

Reading: a member or record is accepted if it decompresses with the right checksum, its header parses, its block
has the promised length and its digests agree. After a failed check the reader looks for the next gzip header
whose member begins with a version line (in plain files: the next version line whose header parses), goes on
from there, and logs the bytes between as a gap with the reason. A file is read by one task, in pieces; memory is
bounded by the largest record.

Null payloads are empty. Null urls give no target header. Rows with a null id are written with an empty id and read
back with a null one; they never are the response others refer to, unless no row of their group has an id, and
then all are responses. Repeated rows with the response's id are all responses. Empty tables give no records.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import stored
from threadlens.llm.token_files import open_folder
from threadlens.session import scratch_path

# Fixed values of the formats.
VERSION = b"WARC/1."
GZIP = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PIECE = 1 << 20
HEADER_BYTES = 1 << 20

MANIFEST = "file string, n_records bigint, n_bytes bigint"
RECORDS = (
    "file string, begins bigint, ends bigint, kind string, page_id bigint, url string, payload_bytes bigint, "
    "payload_digest string, record_type string, refers_to bigint, payload binary, reason string"
)
_TYPES = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
_FIELDS = [tuple(f.split(" ")) for f in RECORDS.split(", ")]


def _one_line(value: str) -> str:
    """A header's value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A response, or a revisit if ``refers_to`` is given."""
    digest = hashlib.sha256(payload).hexdigest()
    head = HTTP_HEAD % len(payload)
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = 6) -> bytes:
    """A gzip member with one record."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


class Damaged(ValueError):
    """A check that failed, with its reason."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes


def parse_headers(lines: bytes) -> dict[str, str]:
    first, *rest = lines.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.\d", first):
        raise Damaged("no version line")
    headers = {}
    for line in rest:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("a header without a colon")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not headers.get("content-length", "").isdecimal() or "warc-type" not in headers:
        raise Damaged("no type or length")
    return headers


def check_record(headers: dict[str, str], block: bytes) -> Record:
    said = headers.get("warc-block-digest")
    if said and said != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise Damaged("block digest")
    if headers["warc-type"] == "response" and "warc-payload-digest" in headers:
        if headers["warc-payload-digest"] != f"sha256:{hashlib.sha256(payload_of(block)).hexdigest()}":
            raise Damaged("payload digest")
    return Record(headers, block)


def payload_of(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


class Window:
    """Bytes of a file from a moving start; ``data`` holds what has been read from ``base`` on."""

    def __init__(self, source):
        self.source, self.base, self.data, self.ended = source, 0, b"", False

    def more(self) -> bool:
        piece = b"" if self.ended else self.source.read(PIECE)
        self.ended = not piece
        self.data += piece
        return bool(piece)

    def skip(self, n: int) -> None:
        self.data, self.base = self.data[n:], self.base + n

    def need(self, n: int) -> bool:
        while len(self.data) < n and self.more():
            pass
        return len(self.data) >= n


def parse_plain(window: Window) -> tuple[Record, int]:
    """The record at the window's start and its length in bytes."""
    if not window.need(len(VERSION)) or not window.data.startswith(VERSION):
        raise Damaged("no version line")
    window.need(HEADER_BYTES)
    end = window.data.find(b"\r\n\r\n", 0, HEADER_BYTES)
    if end < 0:
        raise Damaged("a header without an end")
    headers = parse_headers(window.data[:end])
    stop = end + 4 + int(headers["content-length"])
    if not window.need(stop + 4):
        raise Damaged("the file ends inside a block")
    if window.data[stop:stop + 4] != b"\r\n\r\n":
        raise Damaged("a block of another length")
    return check_record(headers, window.data[end + 4:stop]), stop + 4


def parse_member(window: Window) -> tuple[list[Record], int]:
    """The records of the gzip member at the window's start and the member's length in bytes."""
    if not window.need(len(GZIP)) or not window.data.startswith(GZIP):
        raise Damaged("no member header")
    unpacker, parts, fed = zlib.decompressobj(31), [], 0
    try:
        while not unpacker.eof:
            if fed == len(window.data) and not window.more():
                raise Damaged("the file ends inside a member")
            piece = window.data[fed:]
            parts.append(unpacker.decompress(piece))
            fed = len(window.data)
    except zlib.error as error:
        raise Damaged(f"member: {error}") from error
    length = fed - len(unpacker.unused_data)
    inner, records = Window(_Bytes(b"".join(parts))), []
    while inner.need(1):
        record, size = parse_plain(inner)
        records.append(record)
        inner.skip(size)
    return records, length


class _Bytes:
    def __init__(self, data: bytes):
        self.data = data

    def read(self, _n: int) -> bytes:
        data, self.data = self.data, b""
        return data


def begins_member(data: bytes) -> bool:
    """Whether a gzip member at the start of the data begins with a version line."""
    try:
        return zlib.decompressobj(31).decompress(data, 64).startswith(VERSION)
    except zlib.error:
        return False


def salvage(source) -> Iterator[tuple[int, int, Record | None, str | None]]:
    """(begin, end, record, None) for each good record and (begin, end, None, reason) for each gap of a file."""
    window = Window(source)
    gap: tuple[int, str] | None = None
    while window.need(1):
        packed = window.data.startswith(GZIP[:2])
        try:
            records, size = parse_member(window) if packed else _single(window)
        except Damaged as error:
            gap = gap or (window.base, str(error))
            _next_start(window)
            continue
        if gap:
            yield gap[0], window.base, None, gap[1]
            gap = None
        for record in records:
            yield window.base, window.base + size, record, None
        window.skip(size)
    if gap:
        yield gap[0], window.base, None, gap[1]


def _single(window: Window) -> tuple[list[Record], int]:
    record, size = parse_plain(window)
    return [record], size


def _next_start(window: Window) -> None:
    """Move the window to the next place where a member or a record may begin, or to the end."""
    window.need(2)
    window.skip(1)
    while True:
        places = [p for p in (window.data.find(GZIP), window.data.find(VERSION)) if p >= 0]
        if places:
            at = min(places)
            window.skip(at)
            window.need(1 << 16)
            if window.data.startswith(VERSION) or begins_member(window.data[:1 << 16]):
                return
            window.skip(1)
            continue
        window.skip(max(0, len(window.data) - len(VERSION) + 1))
        if not window.more():
            window.skip(len(window.data))
            return


def write_archives(
    pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", payload: str = "html",
    revisit_bytes: int = 100,
) -> DataFrame:
    """Write a record per page; returns the manifest.

    Digests are grouped without payloads, and only digests that several rows share are joined back; that is a
    many-to-one join which Spark can split where one payload is very frequent.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).cast("bigint").alias("key"), F.col(url).cast("string").alias("target"), body.alias("body"),
        F.sha2(body, 256).alias("digest"),
    )
    large = rows.filter(F.octet_length("body") >= revisit_bytes)
    shared = stored(
        large.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"),
        "shared-payloads",
    ).select(F.col("digest").alias("of"), "first")
    refers = F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    typed = rows.join(shared, F.col("digest") == F.col("of"), "left").select("key", "target", "body", refers.alias("refers"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, uri, n = None, "", 0
        for batch in batches:
            for page, target, data, first in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if stream is None:
                    uri = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"
                    system, path = open_folder(uri)
                    stream = system.open_output_stream(path, compression=None)
                stream.write(member(record_bytes(page, target, data, first)))
                n += 1
        if stream is not None:
            size = stream.tell()
            stream.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([uri]), pa.array([n], type=pa.int64()), pa.array([size], type=pa.int64())],
                names=["file", "n_records", "n_bytes"])

    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    return stored(typed.mapInArrow(write, MANIFEST), "archive-manifest")


def read_archives(files: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """Records and gaps (``kind``) of the files named in column ``file``, one task per file."""
    names = files.select("file").repartition(max(1, files.count()), "file")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = open_folder(uri)
                with system.open_input_stream(path, compression=None) as source:
                    rows, held = [], 0
                    for begin, end, record, reason in salvage(source):
                        rows.append(_row(uri, begin, end, record, reason, with_payload))
                        held += 200 + len(rows[-1][10] or b"")
                        if held > 1 << 23:
                            yield _records(rows)
                            rows, held = [], 0
                    if rows:
                        yield _records(rows)

    return names.mapInArrow(read, RECORDS)


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def _row(uri: str, begin: int, end: int, record: Record | None, reason: str | None, with_payload: bool) -> tuple:
    if record is None:
        return uri, begin, end, "gap", None, None, None, None, None, None, None, reason
    head, kind = record.headers, record.headers["warc-type"]
    payload = payload_of(record.block) if kind == "response" else None
    digest = hashlib.sha256(payload).hexdigest() if payload is not None else (
        head.get("warc-payload-digest", "").removeprefix("sha256:") or None)
    said = head.get("x-payload-length", "")
    size = len(payload) if payload is not None else int(said) if said.isdecimal() else None
    return (
        uri, begin, end, "record", _page(head.get("warc-record-id")), head.get("warc-target-uri"), size, digest, kind,
        _page(head.get("warc-refers-to")), payload if with_payload else None, None,
    )


def _records(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(c, type=_TYPES[t]) for c, (_, t) in zip(zip(*rows), _FIELDS)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in _FIELDS])


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages into a new folder below the shared one and read the records back."""
    folder = scratch_path(pages.sparkSession, "archives")
    found = read_archives(write_archives(pages, folder, **options))
    return found.filter("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
