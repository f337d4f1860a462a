"""Counts and weights of words and word pairs, on word numbers instead of one string per occurrence.

Words come as arrays made by Spark. A task numbers the words of some rows, so that pairs are pairs of
numbers; strings are made again only for what leaves the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

Batches = Iterator[pa.RecordBatch]

PIECE_WORDS = 1_000_000  # words that are numbered at a time
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS  # into which pairs are hashed
COUNTS = "term string, bucket int, df bigint, total bigint"
GROUPED = "group string, " + COUNTS


def _pieces(lists: pa.ListArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, pa.Array]]:
    """First row, number of rows, each word's row (from 0) and number, and the distinct words, for some rows at a time."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    start = 0
    while start < len(lists):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + PIECE_WORDS, "right")) - 1)
        words = lists.slice(start, stop - start).flatten().dictionary_encode()
        rows = np.repeat(np.arange(stop - start), np.diff(ends[start:stop + 1]))
        yield start, stop - start, rows, words.indices.to_numpy().astype(np.int64), words.dictionary
        start = stop


def _neighbours(rows: np.ndarray) -> np.ndarray:
    """Places of the words that another word of their row follows."""
    return np.flatnonzero(rows[1:] == rows[:-1])


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)


def _buckets(hashes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A pair's bucket depends on its two words only, whatever their numbers are."""
    mixed = (hashes[left] * np.uint64(0x9E3779B97F4A7C15) + hashes[right]) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _documents(number: np.ndarray, rows: np.ndarray, distinct: int) -> np.ndarray:
    """In how many rows each number is."""
    wide = int(rows.max(initial=0)) + 1
    cells = np.sort(number * wide + rows)
    return np.bincount(cells[np.diff(cells, prepend=-1) > 0] // wide, minlength=distinct)


def _counted(term: pa.Array, bucket: pa.Array, df: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    columns = [term.cast(pa.string()), bucket, pa.array(df, pa.int64()), pa.array(total, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["term", "bucket", "df", "total"])


def _grouped(batch: pa.RecordBatch, start: int, rows: np.ndarray, codes: np.ndarray, distinct: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Each word's number within its group (of the batch), each row's group number, and the groups' names."""
    names = pc.dictionary_encode(batch.column(0), null_encoding="encode")
    group = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)[start:]
    return group[rows] * distinct + codes, group, names.dictionary.cast(pa.string())


def _group_buckets(names: pa.Array, hashes: np.ndarray, group: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A pair's bucket depends on its group and two words only."""
    of = _hashes(names.fill_null("")) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (hashes[left] * np.uint64(0x9E3779B97F4A7C15) + hashes[right] + of[group]) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _grouped_counts(names: pa.Array, group: np.ndarray, term: pa.Array, df: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    counted = _counted(term, pa.nulls(len(term), pa.int32()), df, total)
    return pa.RecordBatch.from_arrays([names.take(pa.array(group)), *counted.columns], names=["group", *counted.schema.names])


def tally_groups(pairs: bool) -> Callable[[Batches], Batches]:
    """As ``tally``, per group: batches have a group and its words. Groups share the buckets of pairs."""

    def run(batches: Batches) -> Batches:
        loads = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for start, _, rows, codes, words in _pieces(batch.column(1)):
                if not len(words):
                    continue
                named, group, names = _grouped(batch, start, rows, codes, len(words))
                found, number = np.unique(named, return_inverse=True)
                of, word = np.divmod(found, len(words))
                yield _grouped_counts(names, of, words.take(pa.array(word)), _documents(number, rows, len(found)), np.bincount(number))
                if pairs:
                    at = _neighbours(rows)
                    buckets = _group_buckets(names, _hashes(words), group[rows[at]], codes[at], codes[at + 1])
                    loads += np.bincount(buckets, minlength=BUCKETS)
        filled = np.flatnonzero(loads)
        counted = _counted(pa.nulls(len(filled)), pa.array(filled, pa.int32()), np.zeros(len(filled)), loads[filled])
        yield pa.RecordBatch.from_arrays([pa.nulls(len(filled), pa.string()), *counted.columns], names=["group", *counted.schema.names])

    return run


def count_group_pairs(loads: np.ndarray, least: dict[str | None, int]) -> Callable[[Batches], Batches]:
    """Documents and occurrences of the pairs of buckets that hold as many pairs as their group needs."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for start, _, rows, codes, words in _pieces(batch.column(1)):
                if not len(words):
                    continue
                _, group, names = _grouped(batch, start, rows, codes, len(words))
                bar = np.array([least.get(name, 1) for name in names.to_pylist()])
                at = _neighbours(rows)
                of = group[rows[at]]
                enough = loads[_group_buckets(names, _hashes(words), of, codes[at], codes[at + 1])] >= bar[of]
                at, of = at[enough], of[enough]
                found, number = np.unique((of * len(words) + codes[at]) * len(words) + codes[at + 1], return_inverse=True)
                of, pair = np.divmod(found, len(words) ** 2)
                left, right = (words.take(pa.array(half)) for half in np.divmod(pair, len(words)))
                term = pc.binary_join_element_wise(left, right, " ")
                yield _grouped_counts(names, of, term, _documents(number, rows[at], len(found)), np.bincount(number, minlength=len(found)))

    return run


def tally(pairs: bool) -> Callable[[Batches], Batches]:
    """Documents and occurrences of words; of pairs only the occurrences by bucket, in rows without a term."""

    def run(batches: Batches) -> Batches:
        loads = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, _, rows, codes, words in _pieces(batch.column(0)):
                df = _documents(codes, rows, len(words))
                yield _counted(words, pa.nulls(len(words), pa.int32()), df, np.bincount(codes, minlength=len(words)))
                if pairs and len(words):
                    at = _neighbours(rows)
                    loads += np.bincount(_buckets(_hashes(words), codes[at], codes[at + 1]), minlength=BUCKETS)
        filled = np.flatnonzero(loads)
        yield _counted(pa.nulls(len(filled)), pa.array(filled, pa.int32()), np.zeros(len(filled)), loads[filled])

    return run


def count_pairs(buckets: np.ndarray) -> Callable[[Batches], Batches]:
    """Documents and occurrences of the pairs of the given buckets."""
    packed = np.packbits(np.isin(np.arange(BUCKETS), buckets))

    def run(batches: Batches) -> Batches:
        wanted = np.unpackbits(packed).astype(bool)
        for batch in batches:
            for _, _, rows, codes, words in _pieces(batch.column(0)):
                if not len(words):
                    continue
                at = _neighbours(rows)
                at = at[wanted[_buckets(_hashes(words), codes[at], codes[at + 1])]]
                found, number = np.unique(codes[at] * len(words) + codes[at + 1], return_inverse=True)
                left, right = (words.take(pa.array(half)) for half in np.divmod(found, len(words)))
                term = pc.binary_join_element_wise(left, right, " ")
                yield _counted(
                    term, pa.nulls(len(found), pa.int32()), _documents(number, rows[at], len(found)),
                    np.bincount(number, minlength=len(found)),
                )

    return run


def _looked_up(known: Sequence[tuple[int, int]]) -> Callable[[np.ndarray], np.ndarray]:
    """Function for the numbers of some keys; -1 for a key that is not known."""
    keys, numbers = np.array(sorted(known) or [(-1, -1)]).T

    def look(key: np.ndarray) -> np.ndarray:
        near = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[near] == key, numbers[near], -1)

    return look


def weigh(terms: Sequence[str], idf: Sequence[float], pairs: bool, groups: Sequence[str] | None = None) -> Callable[[Batches], Batches]:
    """Positions and unit tf * idf weights of the known terms of each row; the columns before the words are kept.

    ``groups`` names each term's group. The column before the words then tells the group of a row, whose terms alone count.
    """
    names = sorted({*groups}) if groups is not None else [""]
    number = {name: i for i, name in enumerate(names)}
    of = [number[g] for g in groups] if groups is not None else [0] * len(terms)
    halves = [(of[p], term[:i], term[i + 1:], p) for p, term in enumerate(terms) if pairs for i, c in enumerate(term) if c == " "]
    parts = sorted({*terms, *(left for _, left, _, _ in halves), *(right for _, _, right, _ in halves)})
    place = {part: i for i, part in enumerate(parts)}
    alone = [(g * len(parts) + place[term], p) for p, (g, term) in enumerate(zip(of, terms))]
    joined = [((g * len(parts) + place[left]) * len(parts) + place[right], p) for g, left, right, p in halves]

    def run(batches: Batches) -> Batches:
        single, pair = _looked_up(alone), _looked_up(joined)
        scale, known, named = np.array(idf), pa.array(parts, pa.string()), pa.array(names, pa.string())
        for batch in batches:
            kept = batch.num_columns - 1
            for start, n, rows, codes, words in _pieces(batch.column(kept)):
                part = pc.index_in(words.cast(pa.string()), value_set=known).fill_null(-1).to_numpy().astype(np.int64)
                if groups is None:
                    group, term = np.zeros(n, np.int64), single(part)[codes]  # a word that is no part of a term has -1
                    part = part[codes]
                else:
                    group = pc.index_in(batch.column(kept - 1).slice(start, n).cast(pa.string()), value_set=named)
                    group, part = group.fill_null(-1).to_numpy().astype(np.int64), part[codes]
                    part[group[rows] < 0] = -1
                    term = np.where(part >= 0, single(group[rows] * len(parts) + part), -1)
                row = rows
                if pairs:
                    at = _neighbours(rows)
                    at = at[(part[at] >= 0) & (part[at + 1] >= 0)]
                    term = np.concatenate([term, pair((group[rows[at]] * len(parts) + part[at]) * len(parts) + part[at + 1])])
                    row = np.concatenate([rows, rows[at]])
                cell, tf = np.unique((row * len(terms) + term)[term >= 0], return_counts=True)
                row, term = np.divmod(cell, len(terms))
                weight = tf * scale[term]
                weight /= np.sqrt(np.bincount(row, weight * weight, minlength=n))[row]
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(start, n) for c in range(kept)),
                        pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(weight)),
                    ],
                    names=[*batch.schema.names[:kept], "_positions", "_weights"],
                )

    return run
