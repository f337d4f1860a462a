"""Token ids in seekable zstandard files: one frame per document, its checksum and a trailing seek table.

A file holds, in this order:

* one independent zstandard frame per document: its ids as little-endian unsigned 32-bit integers,
  with zstandard's content checksum (low 32 bits of XXH64);
* a skippable frame with the keys: a count, 64-bit integers, and a byte per key that is 1 for null;
* a skippable frame with the seek table of zstandard's seekable format: compressed size,
  decompressed size and checksum of each frame.

Any zstandard decoder can decompress the whole file; a reader that wants some documents reads the two
tables at the end and only the frames it needs. Files are written by tasks into the shared folder under
names that no other attempt uses; only files named in the manifest count, which Spark commits, so that a
task that is run again leaves a file that nobody reads instead of a damaged one.

Null texts are empty texts. Every document has at least its end id. Repeated rows are written as often
as they come. Null keys come first. An empty table gives an empty manifest. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threadlens.llm.common import held, slices, stored
from threadlens.session import scratch_path

# Fixed values of the zstandard formats.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
HEAD = struct.Struct("<II")
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])

MANIFEST = "file string, first_key bigint, first_order bigint, n_documents bigint, n_ids bigint, n_bytes bigint"
#: Characters whose classes are the same in all Unicode versions in use, so that the units found here are
#: those that the library's own splitting finds; texts with any other go to the library as a whole. Of white
#: space only the blank and the line feed are among them.
USUAL = r"\n\x20-\x7e\x{a1}-\x{24f}\x{2010}-\x{2027}\x{20ac}"
#: Runs of white space and white space at the end, where the library's splitting looks ahead; empty texts.
AHEAD = r"[ \n][ \n]|[ \n]\z|\A\z"
CACHE_UNITS = 500_000
LINE_START = "\x00"
LINES = 100
#: A mark after a letter or digit always begins a pre-token of its own: words are known without their marks.
MARKS = r"([\p{L}\p{N}])([.,;:!?])"


class _Units:
    """Ids of the units that a worker has met, as one ragged array, and the place of each unit in it.

    When there are more than ``most`` units, those met in the fewest slices go.
    """

    def __init__(self, library, most: int):
        self.library, self.most = library, most
        self.line_feed = self._ids(["\n"])[0]
        self.place: dict[str, int] = {}
        self.start, self.met = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and number of ids of units. The library gets several at a time, as lines: a line feed is a token there."""
        plain = [u[1:] if u[0] == LINE_START else " " + u for u in units]
        ids = self._ids(["\n".join(plain[i:i + LINES]) + "\n" for i in range(0, len(plain), LINES)])
        together = np.concatenate(ids)
        cuts = np.flatnonzero(together == self.line_feed[0])
        if len(self.line_feed) == 1 and len(cuts) == len(units):
            return np.delete(together, cuts), np.diff(cuts, prepend=-1) - 1
        ids = self._ids(plain)
        return np.concatenate(ids), np.array([len(i) for i in ids])

    def places(self, units: list[str]) -> np.ndarray:
        """The place of each of a slice's distinct units; new ones are encoded."""
        if len(self.place) > self.most:
            self._forget()
        known = self.place.get
        places = [known(u, -1) for u in units]
        new = [u for u, p in zip(units, places) if p < 0 and u != "\n"]
        places = np.array(places, np.int64)
        missing = places < 0
        if missing.any():
            ids, sizes = self._encoded(new) if new else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            if len(new) < missing.sum():
                new, ids, sizes = [*new, "\n"], np.append(ids, self.line_feed), np.append(sizes, len(self.line_feed))
            first = len(self.met)
            self.place.update(zip(new, range(first, first + len(new))))
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, ids])
            self.met = np.concatenate([self.met, np.zeros(len(sizes), np.int64)])
            places[missing] = [self.place[units[i]] for i in np.flatnonzero(missing).tolist()]
        self.met[places] += 1
        return places

    def _forget(self) -> None:
        units, size = np.array(list(self.place), object), np.diff(self.start)
        keep = np.sort(np.argsort(-self.met, kind="stable")[: self.most // 2])
        self.place = {u: i for i, u in enumerate(units[keep])}
        self.ids = self.ids[_ragged(self.start[keep], size[keep])]
        self.start = np.concatenate([[0], np.cumsum(size[keep])])
        self.met = self.met[keep] // 2


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, … of runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def text_encoder(path: str, units_kept: int = CACHE_UNITS) -> Callable[[pa.Array | list[str]], list[bytes]]:
    """Ids of texts as the tokenizers library gives them, as bytes, each unit encoded once.

    For byte-level vocabularies, whose splitting never looks across a unit: the characters between two
    blanks or line feeds, with the blank before them, cut before marks. A slice's texts are split and their units numbered by
    Arrow; only distinct units are looked up in a table that lives as long as the worker process, and the
    ids of all words are gathered from it at once. Texts with unusual characters or runs of white space go to
    the library as a whole.
    """
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    special = [re.escape(t.content) for t in library.get_added_tokens_decoder().values()]
    whole = "|".join([f"[^{USUAL}]", AHEAD, *special])
    units = _Units(library, units_kept)

    def by_units(texts: pa.Array) -> list[bytes]:
        lines = pc.replace_substring(texts, "\n", f" \n {LINE_START}")
        lines = pc.replace_substring_regex(lines, MARKS, f"\\1 {LINE_START}\\2")
        words = pc.split_pattern(pc.binary_join_element_wise(pa.scalar(LINE_START), lines, pa.scalar("")), " ")
        coded = words.flatten().dictionary_encode()
        place = units.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        starts = units.start[place]
        sizes = units.start[place + 1] - starts
        ids = units.ids[_ragged(starts, sizes)].astype("<u4", copy=False).tobytes()
        ends = 4 * np.concatenate([[0], np.cumsum(sizes)])
        bounds = ends[np.asarray(words.offsets) - words.offsets[0].as_py()].tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(texts: pa.Array | list[str]) -> list[bytes]:
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        direct = np.asarray(pc.match_substring_regex(texts, whole).to_numpy(zero_copy_only=False), bool)
        out: list[bytes] = [b""] * len(texts)
        if not direct.all():
            for i, found in zip(np.flatnonzero(~direct).tolist(), by_units(texts.filter(pa.array(~direct)))):
                out[i] = found
        if direct.any():
            odd = texts.filter(pa.array(direct)).to_pylist()
            for i, e in zip(np.flatnonzero(direct).tolist(), library.encode_batch_fast(odd, add_special_tokens=False)):
                out[i] = array("I", e.ids).tobytes()
        return out

    return encode


def open_folder(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder or file given as a URI or an absolute path."""
    return arrow_fs.FileSystem.from_uri(uri)


class TokenFileWriter:
    """Appends documents to one file; ``close`` writes the tables and returns the file's size."""

    def __init__(self, uri: str, level: int = 3):
        system, path = open_folder(uri)
        self.stream = system.open_output_stream(path, compression=None)
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.keys: list[int | None] = []
        self.entries: list[tuple[int, int, int]] = []
        self.n_ids = 0

    def append(self, key: int | None, ids: bytes) -> None:
        frame = self.packer.compress(ids)
        self.stream.write(frame)
        self.keys.append(key)
        self.entries.append((len(frame), len(ids), int.from_bytes(frame[-4:], "little")))
        self.n_ids += len(ids) // 4

    def close(self) -> int:
        n = len(self.keys)
        keys = np.array([k or 0 for k in self.keys], "<i8").tobytes()
        nulls = np.array([k is None for k in self.keys], "u1").tobytes()
        body = struct.pack("<Q", n) + keys + nulls
        self.stream.write(HEAD.pack(SKIPPABLE, len(body)) + body)
        table = np.array(self.entries, ENTRY).tobytes()
        self.stream.write(HEAD.pack(SEEK_TABLE, len(table) + FOOTER.size) + table)
        self.stream.write(FOOTER.pack(n, 0x80, SEEKABLE))
        size = self.stream.tell()
        self.stream.close()
        return size


class TokenFile:
    """Reads single documents of a file through its tables."""

    def __init__(self, uri: str):
        system, path = open_folder(uri)
        self.uri, self.source = uri, system.open_input_file(path)
        size = self.source.size()
        n, flags, magic = FOOTER.unpack(self.source.read_at(FOOTER.size, size - FOOTER.size))
        if magic != SEEKABLE or not flags & 0x80:
            raise ValueError(f"{uri}: no seek table at its end")
        table = n * ENTRY.itemsize
        start = size - FOOTER.size - table
        self.entries = np.frombuffer(self.source.read_at(table, start), ENTRY)
        length = 8 + 9 * n
        body = self.source.read_at(length, start - HEAD.size - length)
        if struct.unpack("<Q", body[:8])[0] != n:
            raise ValueError(f"{uri}: keys and frames differ in number")
        keys = np.frombuffer(body, "<i8", n, 8).tolist()
        self.keys = [None if null else k for k, null in zip(keys, body[8 + 8 * n:])]
        self.offsets = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        self.first_ids = np.concatenate([[0], np.cumsum(self.entries["plain"], dtype=np.int64)]) // 4
        self.unpacker = zstandard.ZstdDecompressor()

    def ids(self, place: int) -> bytes:
        """Ids of the document at a place, checked against the seek table and the frame's checksum."""
        entry = self.entries[place]
        frame = self.source.read_at(int(entry["packed"]), int(self.offsets[place]))
        if int.from_bytes(frame[-4:], "little") != int(entry["check"]):
            raise ValueError(f"{self.uri}: the checksum of frame {place} differs from the seek table")
        ids = self.unpacker.decompress(frame)  # verifies the frame's own checksum
        if len(ids) != int(entry["plain"]):
            raise ValueError(f"{self.uri}: frame {place} has another length than the seek table says")
        return ids

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """Place and ids of the wanted documents (all without ``wanted``), in the file's order."""
        for place, key in enumerate(self.keys):
            if wanted is None or key in wanted:
                yield place, self.ids(place)

    def close(self) -> None:
        self.source.close()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, *, key: str = "doc_id", text: str = "text", end_id: int = 0,
    units_kept: int = CACHE_UNITS,
) -> DataFrame:
    """Encode all texts and write them in ascending order of the key; returns the manifest.

    The rows are range-partitioned by key (and text, for keys that many rows share) and sorted; each
    task writes one file as its rows stream by and keeps only the tables of that file in memory.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("bigint").alias("key"), body.alias("body"), F.xxhash64(body).alias("mark"))
    order = ["key", "mark"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    end = struct.pack("<I", end_id)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, uri, first = None, "", None
        encode = held("encoder", f"{units_kept} {tokenizer}", lambda: text_encoder(tokenizer, units_kept))
        for batch in slices(batches):
            keys = batch.column(0).to_pylist()
            if writer is None:
                uri = f"{folder}/ids-{uuid.uuid4().hex}.zst"
                writer, first = TokenFileWriter(uri), (keys[0], batch.column(2)[0].as_py())
            for one, ids in zip(keys, encode(batch.column(1))):
                writer.append(one, ids + end)
        if writer is not None:
            size = writer.close()
            row = [uri, *first, len(writer.keys), writer.n_ids, size]
            types = [pa.string()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], type=t) for v, t in zip(row, types)],
                names=["file", "first_key", "first_order", "n_documents", "n_ids", "n_bytes"],
            )

    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    return stored(rows.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, wanted: list[int] | None = None, *, with_ids: bool = False) -> DataFrame:
    """Documents of the manifest's files, read by one task per file.

    Columns ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` and, if
    asked for, ``ids``. With ``wanted`` (a short list of keys) only their frames are decompressed. The
    running sum over the manifest sees one row per file.
    """
    in_order = W.orderBy(F.col("first_key").asc_nulls_first(), "first_order", "file")
    before = F.sum("n_ids").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    files = manifest.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    files = files.repartitionByRange(max(1, manifest.count()), "before")  # no two files begin at the same place
    keys = None if wanted is None else set(wanted)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source = TokenFile(uri)
                rows: list[tuple] = []
                held = 0
                for place, ids in source.documents(keys):
                    rows.append((
                        source.keys[place], start + int(source.first_ids[place]), len(ids) // 4, zlib.crc32(ids),
                        *([np.frombuffer(ids, "<u4").tolist()] if with_ids else []),
                    ))
                    held += len(ids) if with_ids else 64
                    if held > 1 << 22:
                        yield _batch(rows, with_ids)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, with_ids)
                source.close()

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    return files.mapInArrow(read, schema)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)


def token_files(docs: DataFrame, tokenizer: str, *, end_id: int = 0, units_kept: int = CACHE_UNITS) -> DataFrame:
    """Write the documents into a new folder below the shared one and read the files back.

    A worker keeps up to about twice ``units_kept`` encoded units: fewer need less memory and more time.
    """
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id=end_id, units_kept=units_kept))
