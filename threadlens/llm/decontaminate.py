"""Benchmark decontamination: windows of benchmark words, looked up in the words of every document.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case. An
item gives all its windows of ``size`` consecutive words; one with fewer words, but not none, is one window.

The benchmark becomes a set of window hashes that every task gets by broadcast, as long as its number of
words is within ``broadcast_words`` (its size in memory is proportional to that). A document's words are
mapped to the benchmark's word numbers; where a window of known words has a hash that is in the set, the
words are compared one by one. A larger benchmark is joined by window text through a shuffle instead;
both ways give the same rows.

Null and empty texts have no words: they hit nothing and no document hits them. The windows of items without an id
count as hits like any other (``n_hit``, spans, ``contaminated``), but such items have no name: ``n_items``,
``items`` and ``items_sha256`` are of the named items only. Repeated documents get a row each, repeated items count once. Empty tables give no rows or no hits. Other columns are ignored by
``find_overlap``; the filters keep them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import ARROW_TYPES, free_name, per_text, stored, text_column

BROADCAST_WORDS = 2_000_000
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
#: For each byte its lower-case form if it belongs to a word, else a blank.
_FOLD = bytes(
    b if b in _WORD else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
FIELDS = {
    "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string",
    "contaminated": "boolean", "items": "array<string>", "span_starts": "array<bigint>", "span_ends": "array<bigint>",
}


def words_of(text: bytes) -> list[bytes]:
    """Normalised words of a UTF-8 text."""
    return text.translate(_FOLD).split()


def _powers(size: int) -> np.ndarray:
    odd = np.uint64(0x9E3779B97F4A7C15)
    return np.array([pow(int(odd), i, 1 << 64) for i in range(size)], np.uint64)


def _hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of word numbers."""
    n = len(ids) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i, power in enumerate(_powers(size)):
        out += (ids[i:i + n].astype(np.uint64) + np.uint64(1)) * power
    return out


@dataclass
class WindowSet:
    """The benchmark's windows in flat arrays: about 24 bytes for each of its words, and its vocabulary."""

    size: int
    vocabulary: dict[bytes, int]
    names: list[str | None]
    flat: np.ndarray  # word numbers of all items, one after the other
    begins: np.ndarray  # where each item begins in them
    hashes: dict[int, np.ndarray]  # by window length: the sorted hashes
    places: dict[int, np.ndarray]  # and where in ``flat`` each window is

    @classmethod
    def build(cls, size: int, items: Iterable[tuple[str | None, Sequence[bytes]]]) -> WindowSet:
        vocabulary: dict[bytes, int] = {}
        names, parts = [], []
        for name, words in items:
            names.append(name)
            parts.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64))
        lengths = np.array([len(p) for p in parts], np.int64)
        flat = np.concatenate([*parts, np.zeros(0, np.int64)])
        begins = np.cumsum(lengths) - lengths
        hashes, places = {}, {}
        for length in sorted(set(np.minimum(lengths, size).tolist()) - {0}):
            spans = [
                np.arange(b, b + n - length + 1) for b, n in zip(begins.tolist(), lengths.tolist())
                if min(n, size) == length
            ]
            at = np.concatenate(spans)
            values = _hashes(flat, length)[at]
            order = np.argsort(values, kind="stable")
            hashes[length], places[length] = values[order], at[order]
        return cls(size, vocabulary, names, flat, begins, hashes, places)

    def occurrences(self, words: Sequence[bytes]) -> Iterator[tuple[int, int, list[str | None]]]:
        """Start, length and items of each place where a window occurs, its words compared."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        for length, hashes in self.hashes.items():
            if len(ids) < length:
                continue
            whole = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not len(whole):
                continue
            values = _hashes(ids, length)[whole]
            low = np.searchsorted(hashes, values, "left")
            high = np.searchsorted(hashes, values, "right")
            hit = high > low
            for start, a, b in zip(whole[hit].tolist(), low[hit].tolist(), high[hit].tolist()):
                at = self.places[length][a:b]
                same = (self.flat[at[:, None] + np.arange(length)] == ids[start:start + length]).all(axis=1)
                if same.any():
                    owner = np.searchsorted(self.begins, at[same], "right") - 1
                    yield start, length, [self.names[o] for o in set(owner.tolist())]


def digest_of(n_words: int, found: Iterable[tuple[int, int, Sequence[str | None]]]) -> tuple:
    """The columns of FIELDS from a document's occurrences."""
    edge = np.zeros(n_words + 1, np.int64)
    items: set[str] = set()
    for start, length, names in found:
        edge[start] += 1
        edge[start + length] -= 1
        items.update(n for n in names if n is not None)
    hit = np.concatenate([[0], np.cumsum(edge)[:n_words] > 0, [0]]).astype(np.int8)
    turn = np.diff(hit)
    starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    names = sorted(items)
    sha = hashlib.sha256(",".join(names).encode()).hexdigest()
    n_hit = int((ends - starts).sum())
    return n_words, n_hit, len(names), sha, n_hit > 0, names, starts.tolist(), ends.tolist()


def find_overlap(
    docs: DataFrame, benchmark: DataFrame, *, size: int = 10, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """Per document its words, hit words, items and the hit spans (word positions, end exclusive)."""
    items = _items(benchmark, item, item_text)
    shared = _shared(items, size, broadcast_words)
    if shared is None:
        return _joined(docs, items, size, key, text)

    def make() -> Callable[[list[bytes]], list[list]]:
        known = shared.value

        def scan(texts: list[bytes]) -> list[list]:
            rows = []
            for one in texts:
                words = words_of(one)
                rows.append(digest_of(len(words), known.occurrences(words)))
            return [list(c) for c in zip(*rows)] if rows else [[] for _ in FIELDS]

        return scan

    return per_text(docs, [key], text, FIELDS, make, binary=True)


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    return benchmark.select(F.col(item).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _shared(items: DataFrame, size: int, broadcast_words: int) -> Broadcast | None:
    """The broadcast set, if the items' words are within the bound (a word and its separator are two bytes)."""
    total = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    if total > broadcast_words:
        return None
    rows = items.dropDuplicates(["item", "text"]).collect()
    windows = WindowSet.build(size, ((r["item"], words_of(r["text"].encode())) for r in rows))
    return items.sparkSession.sparkContext.broadcast(windows)


def _windows(table: DataFrame, keep: str, size: int, text: str, short: bool) -> DataFrame:
    """A row per window: the kept column, the start, the window's words; ``short`` texts are one window."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(one)
                lengths = [min(size, len(words))] if short else range(1, size + 1)
                for length in lengths:
                    n = len(words) - length + 1 if length else 0
                    for a in range(0, max(n, 0), 10_000):
                        starts = range(a, min(a + 10_000, n))
                        yield pa.RecordBatch.from_arrays([
                            pa.array([name] * len(starts), type=pa.string()), pa.array(starts, type=pa.int64()),
                            pa.array([length] * len(starts), type=pa.int64()),
                            pa.array([b" ".join(words[i:i + length]) for i in starts], type=pa.binary()),
                        ], names=["name", "start", "length", "window"])

    narrow = table.select(F.col(keep).alias("name"), F.col(text).cast("binary").alias("body"))
    return narrow.mapInArrow(cut, "name string, start bigint, length bigint, window binary")


def _digests(docs: DataFrame, items: DataFrame, size: int, text: str) -> tuple[DataFrame, DataFrame]:
    """Distinct texts (``mark``, ``body``), and the FIELDS of each mark with the benchmark's windows joined by a shuffle."""
    body = F.coalesce(F.col(text), F.lit(""))
    mark = F.sha2(body, 256)
    texts = stored(docs.select(mark.alias("mark"), body.alias("body")).dropDuplicates(["mark"]), "texts")
    known = stored(_windows(items, "item", size, "text", True).select("name", "window").distinct(), "windows")
    lengths = [r[0] for r in stored(
        _windows(items, "item", size, "text", True).select("length").distinct(), "lengths").collect()]
    of_docs = _windows(texts, "mark", size, "body", False).filter(F.col("length").isin(lengths or [0]))
    hits = of_docs.join(known.withColumnRenamed("name", "item"), "window")
    spans = hits.groupBy("name").agg(
        F.collect_set(F.struct("start", "length")).alias("spans"), F.sort_array(F.collect_set("item")).alias("items")
    )
    counted = texts.join(spans, texts["mark"] == spans["name"], "left").select("mark", "body", "spans", "items")

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for one, spans_, names in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                found = [(s["start"], s["length"], ()) for s in spans_ or ()]
                rows.append(digest_of(len(words_of(one)), found + ([(0, 0, names)] if names else [])))
            columns = zip(*rows) if rows else [[] for _ in FIELDS]
            made = [pa.array(c, type=ARROW_TYPES[t]) for c, t in zip(columns, FIELDS.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["mark", *FIELDS])

    schema = "mark string, " + ", ".join(f"{n} {t}" for n, t in FIELDS.items())
    digests = stored(
        counted.select("mark", F.col("body").cast("binary"), "spans", "items").mapInArrow(finish, schema), "overlap")
    return texts, digests


def _joined(docs: DataFrame, items: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """The same result as with a broadcast set, from the shuffle join."""
    _, digests = _digests(docs, items, size, text)
    mark = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    return docs.select(F.col(key), mark.alias("_mark")).join(digests, F.col("_mark") == F.col("mark")).select(key, *FIELDS)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, *, size: int = 10, max_share: float = 0.0, text: str = "text",
    item: str = "item_id", item_text: str = "text", broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """Documents whose hit words are at most ``max_share`` of their words, all columns as they are.

    With a broadcast set the hit share is a column made from the text alone and no row is shuffled.
    """
    items = _items(benchmark, item, item_text)
    shared = _shared(items, size, broadcast_words)
    if shared is None:
        mark = free_name(docs, "_text_mark")
        marked = docs.withColumn(mark, F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
        found = _joined(marked.select(F.col(mark).alias("key"), F.col(text).alias("body")), items, size, "key", "body")
        bad = found.filter(F.col("n_hit") > F.lit(max_share) * F.col("n_words")).select(F.col("key").alias(mark))
        return marked.join(bad.distinct(), mark, "left_anti").select(*docs.columns)

    def make() -> Callable[[list[bytes]], list[bool]]:
        known = shared.value

        def clean(one: bytes) -> bool:
            words = words_of(one)
            n_hit = digest_of(len(words), known.occurrences(words))[1]
            return n_hit <= max_share * len(words)

        return lambda texts: [clean(t) for t in texts]

    return docs.filter(text_column(text, "boolean", make, binary=True))


def _without(words: list[bytes], starts: Iterable[int], ends: Iterable[int]) -> str:
    """The words outside the spans, joined by blanks."""
    hit = np.zeros(len(words), bool)
    for a, b in zip(starts, ends):
        hit[a:b] = True
    return b" ".join(w for w, h in zip(words, hit.tolist()) if not h).decode()


def cut_spans(docs: DataFrame, benchmark: DataFrame, *, size: int = 10, text: str = "text", **options) -> DataFrame:
    """Documents without their hit words: the rest of the words, folded, joined by blanks; other columns stay.

    For corpora where a passage should go but its document stay. A benchmark beyond ``broadcast_words`` is joined
    by shuffle; both ways give the same rows.
    """
    items = _items(benchmark, options.get("item", "item_id"), options.get("item_text", "text"))
    shared = _shared(items, size, options.get("broadcast_words", BROADCAST_WORDS))
    if shared is None:
        return _cut_joined(docs, items, size, text)

    def make() -> Callable[[list[bytes]], list[str]]:
        known = shared.value

        def rest(one: bytes) -> str:
            words = words_of(one)
            found = digest_of(len(words), known.occurrences(words))
            return _without(words, found[6], found[7]) if found[1] else one.decode()

        return lambda texts: [rest(t) for t in texts]

    return docs.withColumn(text, text_column(text, "string", make, binary=True))


def _cut_joined(docs: DataFrame, items: DataFrame, size: int, text: str) -> DataFrame:
    """``cut_spans`` with the spans of the shuffle join; only texts with hits are cut and joined back."""
    texts, digests = _digests(docs, items, size, text)
    hit = digests.filter("n_hit > 0").select("mark", "span_starts", "span_ends")
    of_hits = texts.join(hit, "mark").select("mark", F.col("body").cast("binary"), "span_starts", "span_ends")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_without(words_of(b), s, e) for b, s, e in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, type=pa.string())], names=["mark", "rest"])

    mark, rest = free_name(docs, "_text_mark"), free_name(docs, "_text_rest")
    done = stored(of_hits.mapInArrow(cut, "mark string, rest string"), "cut-texts")
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = docs.withColumn(mark, F.sha2(whole, 256)).join(done.toDF(mark, rest), mark, "left")
    return marked.withColumn(text, F.coalesce(F.col(rest), whole)).select(*docs.columns)
