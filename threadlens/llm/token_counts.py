"""Token counts by byte-pair merging on ragged arrays, for vocabularies with word ends.

White space is dropped before the merging, so a text's count is the sum over its white-space separated
chunks; each chunk met for the first time is split into pre-tokens, and all new pre-tokens of a batch are
merged together: they lie one after the other in one array of symbols, and in each round every pre-token's
lowest-rank pair is merged at all its places at once, until no pair of any has a rank.

Null texts are empty and have no tokens. Repeated rows are counted as often as they come. Special strings
inside a text are one token each, as by the library's default.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import held, per_text

CACHE_CHUNKS = 600_000
#: Characters with the same class and case in all Unicode versions in use; chunks with any other are
#: normalised and split by the library before they are merged here.
USUAL = "\x00-\x1b\x20-\u024f\u2000-\u206f\u20ac"
UNUSUAL = re.compile(f"[^{USUAL}]")
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")  # fixed values of the vocabulary's pattern


def _class(first_letter: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == first_letter)


def _byte_symbols() -> list[str]:
    """The character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class MergeTable:
    """Pair ranks of a vocabulary as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = [t["content"] for t in spec["added_tokens"]]
        symbols = _byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self.inner = np.array([vocab.get(s, -1) for s in symbols], np.int64)
        self.last = np.array([vocab.get(s + end, -1) for s in symbols], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.width = max(vocab.values()) + 1
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order, made[order]

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (a very large number if none) and merged symbol of each pair."""
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.rank[at], np.iinfo(np.int64).max), self.made[at]

    def count(self, words: list[bytes]) -> np.ndarray:
        """Surviving symbols of each pre-token after all merges."""
        lengths = np.array([len(w) for w in words], np.int64)
        if not lengths.sum():
            return lengths
        data = np.frombuffer(b"".join(words), np.uint8)
        owner = np.repeat(np.arange(len(words)), lengths)
        symbol = self.inner[data]
        ends = np.cumsum(lengths)[lengths > 0] - 1
        symbol[ends] = self.last[data[ends]]
        total = np.zeros(len(words), np.int64)
        none = np.iinfo(np.int64).max
        while len(symbol) > 1:
            joined = owner[1:] == owner[:-1]
            rank, made = self.lookup(symbol[:-1], symbol[1:])
            rank[~joined] = none
            starts = np.flatnonzero(np.concatenate([[True], ~joined]))
            lowest = np.minimum.reduceat(np.append(rank, none), starts)
            sizes = np.diff(np.append(starts, len(symbol)))
            open_ = lowest < none
            chosen = (rank < none) & (rank == np.repeat(lowest, sizes)[:-1])
            # of overlapping places (a a a) every second one merges, counted from the left
            places = np.flatnonzero(chosen)
            if len(places):
                first = np.concatenate([[True], np.diff(places) > 1])
                run = np.flatnonzero(first)[np.cumsum(first) - 1]
                places = places[(np.arange(len(places)) - run) % 2 == 0]
            symbol[places] = made[places]
            keep = np.ones(len(symbol), bool)
            keep[places + 1] = False
            done = np.repeat(~open_, sizes)
            total += np.bincount(owner[done], minlength=len(words))
            keep &= ~done
            symbol, owner = symbol[keep], owner[keep]
        return total + np.bincount(owner, minlength=len(words))


class _Known(dict):
    """Counts by chunk; a chunk that is not there counts 0 and is noted in ``missed``."""

    missed: list[str]

    def __missing__(self, chunk: str) -> int:
        self.missed.append(chunk)
        return 0


def text_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Token counts of texts; chunks met before are taken from a table of the worker process.

    When it gets large, it keeps the chunks met since it last did.
    """
    from tokenizers import Tokenizer

    table, library = MergeTable(path), Tokenizer.from_file(path)
    parts = re.compile("|".join([*CONTRACTIONS, f"[{_class('L')}]+", f"[{_class('N')}]", rf"[^\s{_class('L')}{_class('N')}]+"]))
    special = re.compile("|".join(map(re.escape, table.special))) if table.special else None
    known, older = _Known(), _Known()

    def pre_tokens(chunk: str) -> list[bytes]:
        if not UNUSUAL.search(chunk):
            return [p.encode() for p in parts.findall(chunk)]
        split = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(chunk))
        return [bytes(table.byte_of[c] for c in piece) for piece, _ in split]

    def learn(chunks: set[str]) -> None:
        found = [c for c in chunks if c in older]
        known.update((c, older[c]) for c in found)
        new = list(chunks.difference(found))
        words = [pre_tokens(c) for c in new]
        each = list({w for ws in words for w in ws})
        count = dict(zip(each, table.count(each).tolist()))
        known.update((c, sum(count[w] for w in ws)) for c, ws in zip(new, words))

    def chunks_of(text: str) -> tuple[list[str], int]:
        """White-space separated chunks, in lower case where that is safe, and the special strings' number."""
        extra, segments = 0, [text]
        if special and "<" in text:
            extra, segments = len(special.findall(text)), special.split(text)
        out: list[str] = []
        for segment in segments:
            if UNUSUAL.search(segment):
                out += library.normalizer.normalize_str(segment).split(" ")
            else:
                out += segment.lower().split()
        return out, extra

    def count(texts: list[str]) -> list[int]:
        nonlocal known, older
        if len(known) > CACHE_CHUNKS:
            known, older = _Known(), known
        known.missed, totals, spans = [], [], []
        for text in texts:
            chunks, extra = chunks_of(text)
            start = len(known.missed)
            totals.append(sum(map(known.__getitem__, chunks)) + extra)
            spans.append((start, len(known.missed)))
        missed = known.missed
        learn(set(missed))
        return [t + sum(map(known.__getitem__, missed[a:b])) for t, (a, b) in zip(totals, spans)]

    return count


def count_tokens(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key, ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text."""

    def make() -> Callable[[list[str]], list[list[int]]]:
        count = held("counter", tokenizer, lambda: text_counter(tokenizer))
        return lambda texts: [[len(t.encode()) for t in texts], count(texts)]

    return per_text(docs, [key], text, {"n_bytes": "bigint", "n_tokens": "bigint"}, make)


def flag_long(counts: DataFrame, limit: int) -> DataFrame:
    """Add ``over_limit``: more tokens than the limit."""
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
