"""Repeated passages between and within documents, found by fixed-block anchors.

A window is ``window`` consecutive words of one document. A window whose words also start earlier (in a row
with a smaller key, or in the same key at a smaller place) is a repeat; every word inside a repeat is removed.
Windows are judged on the input. The first occurrence of a passage stays.

Index: each document is cut into blocks of (window + 1) // 2 words, one after the other; wherever a window
starts, it holds one whole block of its own document. Probe: every rolling run of as many words is looked up among
the blocks. Hits are runs that equal a block somewhere and occur more than once; all other places need not be looked
at again. Extension: a hit is extended on both sides to the windows that hold it, at every offset; windows
of equal words meet and all but the earliest are repeats. What overlapping repeats cover are the maximal exact
repeats, given as spans.

How it runs, for slices of some megabytes (``slices.py``): a slice sends each of its distinct runs once, as 32 bits of
hash in the bucket that the other bits name; a bucket answers with the hits. A hash that only looks alike costs work and no
result. Then the slice sends each distinct extended window once, with 96 bits of hash beside those of the
bucket and the smallest place it has there; the bucket answers which are later than another slice's. So however
often a passage occurs, and be it in a third of all rows, it is one entry per slice, and no pair is ever formed. Words
are compared by those hashes: by chance two of 10^13 different windows agree with a probability below 10^-4.

Null and empty texts have no words. A text with fewer words than a window stays whole. Null keys come before all others;
rows of one key are compared by their places only, so that equal rows repeat nothing of each other. Ties
cannot arise otherwise. An empty table gives no rows. Other columns are ignored. A document is handled as a
whole: memory follows the longest one, about 100 bytes for each of its words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import stored
from threadlens.llm.slices import (
    answers_for, checksum, mixed, packed, partition, read_answers, slices, store_answers, unpacked, words_of,
)

WINDOW = 20
BUCKET_BYTES = 16_000_000  # of text; a bucket gets about a quarter as many entries
NO_KEY = np.iinfo(np.int64).min
_STEPS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))  # odd multipliers of the two rolling hashes


class Slice:
    """The words of some documents as hashes."""

    def __init__(self, rows: pa.Table, window: int):
        self.window, self.block = window, (window + 1) // 2
        keys = rows.column("key").combine_chunks()
        self.keys = np.asarray(pc.fill_null(keys, NO_KEY), np.int64)
        texts = pc.fill_null(rows.column("body").combine_chunks(), "")
        self.words, self.counts = words_of(texts)
        self.mark = checksum(self.keys, self.counts)
        coded = self.words.dictionary_encode()
        known = [xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()]
        self.hashes = np.array(known, np.uint64)[np.asarray(coded.indices)]
        ends = np.cumsum(self.counts)
        self.document = np.repeat(np.arange(len(self.counts)), self.counts)
        self.place = np.arange(len(self.hashes)) - np.repeat(ends - self.counts, self.counts)
        self.left = np.repeat(ends, self.counts) - np.arange(len(self.hashes))  # words to the document's end

    def _rolled(self, starts: np.ndarray, size: int, which: int) -> np.ndarray:
        """Hash of the ``size`` words from each start."""
        words = self.hashes if which == 0 else mixed(self.hashes)
        out = np.zeros(len(starts), np.uint64)
        for j in range(size):
            out = out * _STEPS[which] + words[starts + j]
        return mixed(out)

    def runs(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and code of every rolling run of a block's length: bucket in the high half, rest of the hash in the low."""
        starts = np.flatnonzero(self.left >= self.block)
        found = self._rolled(starts, self.block, 0)
        low = np.uint64(32)
        return starts, (((found >> low) % np.uint64(buckets)) << low) | (found & np.uint64(0xFFFFFFFF))

    def questions(self, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Bucket, kind and number of entries, and all entries: each distinct run once.

        The kind has 1 if the run is one of the slice's blocks, and 2 if it occurs in the slice more than once.
        """
        starts, codes = self.runs(buckets)
        order = np.argsort(codes, kind="stable")
        codes, block = codes[order], (self.place[starts] % self.block == 0)[order]
        if not len(codes):
            return
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        times = np.diff(np.append(first, len(codes)))
        kind = (np.add.reduceat(block, first) > 0) + 2 * (times > 1)
        codes = codes[first]
        group = (codes >> np.uint64(32)).astype(np.int64) * 4 + kind
        by_group = np.argsort(group, kind="stable")
        groups, sizes = np.unique(group, return_counts=True)
        yield groups // 4, groups % 4, sizes, (codes[by_group] & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def extended(self, hits: pa.Table | None, buckets: int) -> Windows:
        """The windows that hold a hit."""
        none = np.zeros(0, np.int64)
        if hits is None:
            return Windows(self, none, buckets)
        low, row = unpacked(hits.column("hashes"), "<u4")
        wanted = (hits.column("bucket").to_numpy().astype(np.uint64)[row] << np.uint64(32)) | low
        starts, codes = self.runs(buckets)
        hit = np.zeros(len(self.hashes) + 1, np.int64)
        hit[starts] = np.isin(codes, wanted)
        before = np.concatenate([[0], np.cumsum(hit)])
        windows = np.flatnonzero(self.left >= self.window)
        return Windows(self, windows[before[windows + self.block] > before[windows]], buckets)

    def removed(self, starts: np.ndarray) -> np.ndarray:
        """Which words the windows from these starts cover."""
        change = np.zeros(len(self.hashes) + 1, np.int32)
        change[starts] += 1
        change[starts + self.window] -= 1  # no window passes its document's end
        return np.cumsum(change[:-1]) > 0


class Windows:
    """A slice's extended windows, grouped by their words; of each group the earliest place speaks."""

    def __init__(self, own: Slice, starts: np.ndarray, buckets: int):
        first, second = (own._rolled(starts, own.window, which) for which in (0, 1))
        keys, place = own.keys[own.document[starts]], own.place[starts]
        order = np.lexsort((place, keys, second, first))
        self.starts, self.keys, self.place, first, second = (a[order] for a in (starts, keys, place, first, second))
        new = np.ones(len(order), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        heads = np.flatnonzero(new)
        self.group = np.cumsum(new) - 1
        later = (self.keys != self.keys[heads][self.group]) | (self.place != self.place[heads][self.group])
        self.repeats = later  # of a place in the same slice
        bucket = ((second >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)[heads]
        # within a bucket in order of the keys, whose bytes then repeat
        self.entries = heads[np.lexsort((self.place[heads], self.keys[heads], bucket))]
        self.buckets, self.sizes = np.unique(bucket, return_counts=True)
        self.hashes, self.checks = first[self.entries], (second[self.entries] & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def answered(self, answers: pa.Table | None) -> np.ndarray:
        """Starts of all windows that are repeats, of a place in this slice or in another."""
        repeats = self.repeats.copy()
        if answers is not None:
            at, row = unpacked(answers.column("later"), "<u4")
            begin = np.cumsum(self.sizes) - self.sizes
            asked = np.searchsorted(self.buckets, answers.column("bucket").to_numpy())[row]
            known = np.zeros(self.group[-1] + 1, bool)
            known[self.group[self.entries[begin[asked] + at]]] = True
            repeats |= known[self.group]
        return self.starts[repeats]


def _hits(table: pa.Table) -> pa.Table:
    """Of a bucket's runs those that equal a block and occur more than once, by the slice that asked."""
    values, row = unpacked(table.column("hashes"), "<u4")
    kind = table.column("kind").to_numpy()[row]
    order = np.argsort(values, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], values[order][1:] != values[order][:-1]])) if len(values) else np.zeros(0, int)
    times = np.diff(np.append(first, len(values)))
    kinds = np.bitwise_or.reduceat(kind[order], first) if len(values) else kind
    hit = (kinds & 1 > 0) & ((times > 1) | (kinds & 2 > 0))
    chosen = np.sort(order[np.repeat(hit, times)])
    rows, sizes = np.unique(row[chosen], return_counts=True)
    return table.take(pa.array(rows)).select(["part", "slice", "mark", "bucket"]).append_column(
        "hashes", packed(values[chosen], sizes))


def _later(table: pa.Table) -> pa.Table:
    """Of a bucket's windows those that start earlier in another slice, by the slice that asked."""
    hashes, row = unpacked(table.column("hashes"), "<u8")
    checks, keys, places = (unpacked(table.column(n), k)[0] for n, k in (("checks", "<u4"), ("keys", "<i8"), ("places", "<u4")))
    order = np.lexsort((places, keys, checks, hashes))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (checks[order][1:] != checks[order][:-1])
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    chosen = np.sort(order[(keys[order] != keys[head]) | (places[order] != places[head])])
    begin = np.searchsorted(row, np.arange(table.num_rows))
    rows, sizes = np.unique(row[chosen], return_counts=True)
    return table.take(pa.array(rows)).select(["part", "slice", "mark", "bucket"]).append_column(
        "later", packed((chosen - begin[row[chosen]]).astype(np.uint32), sizes))


ASKED = "part int, slice bigint, mark bigint, bucket int"
FOUND = "key bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept string"


def _rows(number: int, own: Slice, bucket: np.ndarray, more: dict[str, pa.Array]) -> pa.RecordBatch:
    n = len(bucket)
    first = [pa.array([v] * n, t) for v, t in ((partition(), pa.int32()), (number, pa.int64()), (own.mark, pa.int64()))]
    return pa.RecordBatch.from_arrays(
        [*first, pa.array(bucket, pa.int32()), *more.values()], names=["part", "slice", "mark", "bucket", *more])


def _found(own: Slice, starts: np.ndarray) -> pa.RecordBatch:
    """The verdicts on a slice's documents."""
    gone = own.removed(starts)
    ends = np.cumsum(own.counts)
    removed_before = np.concatenate([[0], np.cumsum(gone)])
    n_removed = removed_before[ends] - removed_before[ends - own.counts]
    kept_ends = np.concatenate([[0], np.cumsum(own.counts - n_removed)])
    kept = pa.ListArray.from_arrays(pa.array(kept_ends, pa.int32()), own.words.filter(pa.array(~gone)))
    begins = np.flatnonzero(gone & ~(np.concatenate([[False], gone[:-1]]) & (own.place > 0)))
    stops = np.flatnonzero(gone & ~(np.concatenate([gone[1:], [False]]) & (own.left > 1)))
    spans = pa.StructArray.from_arrays(
        [pa.array(own.place[begins], pa.int64()), pa.array(own.place[stops] + 1, pa.int64())], names=["start", "end"])
    n_spans = np.bincount(own.document[begins], minlength=len(own.counts))
    return pa.RecordBatch.from_arrays([
        pa.array(own.keys, pa.int64(), mask=own.keys == NO_KEY), pa.array(own.counts), pa.array(n_removed),
        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_spans)]), pa.int32()), spans),
        pc.binary_join(kept, " "),
    ], names=["key", "n_words", "n_removed", "spans", "kept"])


def find_repeats(
    docs: DataFrame, *, window: int = WINDOW, key: str = "doc_id", text: str = "text", from_files: bool = False,
) -> DataFrame:
    """Per row its key, ``n_words``, ``n_removed``, the removed ``spans`` of words (end excluded) and the ``kept`` words.

    ``docs`` is read three times. With ``from_files`` it must be a table as read from files, without joins or shuffles;
    any other is stored first. Keys are cast to bigint; the smallest bigint counts as no key.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("body"))
    if not from_files:
        rows = stored(rows, "texts")
    spark = docs.sparkSession
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets = max(spark.sparkContext.defaultParallelism, size // BUCKET_BYTES + 1)

    def ask_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in slices(batches, "body"):
            own = Slice(part, window)
            for bucket, kind, sizes, entries in own.questions(buckets):
                yield _rows(number, own, bucket, {"kind": pa.array(kind, pa.int32()), "hashes": packed(entries, sizes)})

    runs = rows.mapInArrow(ask_runs, f"{ASKED}, kind int, hashes binary")
    hits = store_answers(runs.groupBy("bucket").applyInArrow(_hits, f"{ASKED}, hashes binary"), "block-hits")

    def ask_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = read_answers(hits, partition(), ["bucket", "hashes"])
        for number, part in slices(batches, "body"):
            if number in answers:
                own = Slice(part, window)
                found = own.extended(answers_for(answers, number, own.mark), buckets)
                entries, sizes = found.entries, found.sizes
                yield _rows(number, own, found.buckets, {
                    "hashes": packed(found.hashes, sizes), "checks": packed(found.checks, sizes),
                    "keys": packed(found.keys[entries], sizes), "places": packed(found.place[entries].astype(np.uint32), sizes),
                })

    asked = rows.mapInArrow(ask_windows, f"{ASKED}, hashes binary, checks binary, keys binary, places binary")
    later = store_answers(asked.groupBy("bucket").applyInArrow(_later, f"{ASKED}, later binary"), "later-windows")

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_hits = read_answers(hits, partition(), ["bucket", "hashes"])
        part_later = read_answers(later, partition(), ["bucket", "later"])
        for number, part in slices(batches, "body"):
            own = Slice(part, window)
            found = own.extended(answers_for(part_hits, number, own.mark), buckets)
            yield _found(own, found.answered(answers_for(part_later, number, own.mark)))

    return rows.mapInArrow(judge, FOUND).withColumnRenamed("key", key)
