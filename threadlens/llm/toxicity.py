"""Toxicity of texts written to get past word lists: noisy-channel decoding, then a score of what was meant.

1. A character model (trigrams, smoothed with bigrams) is counted over the words of all documents.
2. Words with digits, symbols or long runs inside, and runs of single characters, become lattices: a leet
   symbol may stand for letters, a run for one or two letters, a separator for nothing or a word's end.
   Viterbi decoding under the channel's costs and the character model gives the restored words.
3. Each restored word has an evidence of toxicity from labelled documents: the share of toxic documents among
   those with the word, smoothed towards the share of its beginning of six letters, that towards five, and so on
   to three letters. A logistic model of the strongest evidences of a document gives its score.

Labels come from at most about ``max_rows`` labelled rows (a hash of the key decides which; all of them if
there are fewer). All counts of the character model cover all documents. The two tables that tasks get by
broadcast have fixed sizes: 64 to the power of 3 numbers, and ``BUCKETS`` counts in which words are hashed.

Null texts are empty; the score of an empty text comes from the model's constant. Rows with a null or unknown
key are scored like all others. Without labels every score is 0.5. Repeated rows get equal scores, and count as
often as they come. Empty tables give no rows. Other columns are ignored by ``score_toxicity`` and kept by
``drop_toxic``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import free_name, held, per_text, slices, stored, text_column

MAX_ROWS = 200_000
BUCKETS = 1 << 21
PREFIXES = (3, 4, 5, 6)
STRENGTH = 4.0  # documents' worth of trust in the shorter beginning
TOP = 10

# Characters: 0 a word's edge, 1-26 a-z, 27-59 the letters ß to ÿ, 63 all others.
EDGE, OTHER, SIDE = 0, 63, 64
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100)))
_CLASS = {c: i + 1 for i, c in enumerate(LETTERS) if c != "÷"}

# Letters that a symbol may stand for (the channel).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou",
    "#": "h", "%": "x", "¢": "c", "§": "s",
}
COST_LEET, COST_SELF, COST_DROP, COST_SHORTEN, COST_DOUBLE, COST_SPLIT, COST_JOIN = 1.0, 9.0, 2.0, 0.7, 4.0, 3.0, 0.2
_NOISE = set(".-_'’·~^`,:;/\\\"=<>[]{}")
_TRIM = ".,;:!?\"'()[]{}<>…-–—_*|+=~^`/\\&%#«»“”„’‘·"
_SPACED = re.compile(r"(?<![^\s])[^\W_](?:[ .\-_*·]{1,2}[^\W_]){2,}(?![^\W_])")
_SUSPECT = re.compile(r"[^a-zß-öø-ÿ]|(.)\1\1")
_RUN = re.compile(r"(.)\1\1")
_EDGE_RUNS = re.compile(r"^([^\w\s])\1{2,}|([^\w\s])\2{2,}$")


def class_of(text: str) -> list[int]:
    return [_CLASS.get(c, OTHER) for c in text]


# 1. the character model


def _count_trigrams(texts: list[str]) -> np.ndarray:
    """Counts of (before the last, last, next) over the words of texts, edges included."""
    codes = np.frombuffer(" ".join(["", *texts, ""]).lower().encode("utf-32-le"), np.uint32)
    table = np.full(0x250, OTHER, np.uint8)
    for char, number in _CLASS.items():
        table[ord(char)] = number
    table[[9, 10, 11, 12, 13, 32]] = EDGE
    symbols = np.where(codes < 0x250, table[np.minimum(codes, 0x24F)], OTHER).astype(np.int64)
    last, here = symbols[:-2], symbols[1:-1]
    cells = (last * SIDE + here) * SIDE + symbols[2:]
    keep = here != EDGE  # a word's first letter follows two edges
    starts = (symbols[:-1] == EDGE) & (symbols[1:] != EDGE)
    return np.bincount(cells[keep], minlength=SIDE**3) + np.bincount(symbols[1:][starts], minlength=SIDE**3)


def count_characters(docs: DataFrame, text: str = "text") -> DataFrame:
    """``cell`` (a trigram's number) and ``n`` over all whole texts; each task sums its own first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIDE**3, np.int64)
        for batch in slices(batches):
            total += _count_trigrams(batch.column(0).to_pylist())
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    counted = texts.mapInArrow(run, "cell bigint, n bigint")
    return counted.groupBy("cell").agg(F.sum("n").alias("n"))


def character_model(counts: DataFrame) -> np.ndarray:
    """Cost (negative log probability) of a character after two others, from at most 64^3 counts."""
    found = counts.toArrow().to_pandas()
    n = np.zeros(SIDE**3)
    n[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    n = n.reshape(SIDE, SIDE, SIDE)
    two = n.sum(axis=0)
    one = two.sum(axis=0) + 0.5
    p1 = one / one.sum()
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (n + 5 * p2[None]) / (n.sum(axis=2, keepdims=True) + 5)
    return -np.log(p3).astype(np.float32)


# 2. decoding

Option = tuple[str, float]  # what is emitted ("" for nothing, " " for a word's end), and its cost


def lattice(word: str) -> list[list[Option]]:
    """Positions of a word with their options; runs of a character are one position."""
    out: list[list[Option]] = []
    i = 0
    while i < len(word):
        j = i
        while j < len(word) and word[j] == word[i]:
            j += 1
        char, run = word[i], j - i
        options: list[Option] = []
        if char in _CLASS:
            if run == 1:
                options = [(char, 0.0)]
            elif run == 2:
                options = [(char * 2, 0.0), (char, COST_DOUBLE)]
            else:
                options = [(char, COST_SHORTEN), (char * 2, COST_SHORTEN + 0.5)]
        else:
            for letter in LEET.get(char, ""):
                options.append((letter, COST_LEET))
                if run > 1:
                    options.append((letter * 2, COST_LEET))
            if char in _NOISE or char in LEET and not char.isdigit():
                options.append(("", COST_DROP))
                options.append((" ", COST_SPLIT))
            if not options or char.isalnum():
                options.append((char * run, COST_SELF))
        out.append(options)
        i = j
    return out


def spaced_lattice(run: str) -> list[list[Option]]:
    """Positions of a run of single characters: what lies between them is nothing or a word's end."""
    out: list[list[Option]] = []
    for part in re.findall(r"[ .\-_*·]+|[^ .\-_*·]", run):
        if part in _CLASS:
            out.append([(part, 0.0)])
        elif part in LEET and part.isalnum():
            out.append([(letter, COST_LEET) for letter in LEET[part]] + [(part, COST_SELF)])
        elif part[0].isalnum():
            out.append([(part, 0.0)])
        else:
            wide = len(part) > 1
            out.append([("", COST_SPLIT if wide else COST_JOIN), (" ", COST_JOIN if wide else COST_SPLIT)])
    return out


def decode(positions: Sequence[Sequence[Option]], cost: np.ndarray) -> str:
    """The cheapest reading: Viterbi over states of the last two characters."""
    states: dict[tuple[int, int], tuple[float, tuple]] = {(EDGE, EDGE): (0.0, ())}
    for options in [*positions, [(" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (spent, path) in states.items():
            for emitted, extra in options:
                x, y, total = a, b, spent + extra
                for char in emitted:
                    number = EDGE if char == " " else _CLASS.get(char, OTHER)
                    if number == EDGE and y == EDGE:
                        continue
                    total += float(cost[x, y, number])
                    x, y = (EDGE, EDGE) if number == EDGE else (y, number)
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, (path, emitted))
        states = after
    _, path = min(states.values(), key=lambda s: s[0])
    parts = []
    while path:
        path, emitted = path
        parts.append(emitted)
    return "".join(reversed(parts)).strip()


def restore_word(word: str, cost: np.ndarray) -> tuple[str, ...]:
    """Restored words of one white-space separated word in lower case."""
    bare = word.strip(_TRIM)
    if bare.isalpha():
        return tuple(decode(lattice(bare), cost).split()) if _RUN.search(bare) else (bare,)
    core = _EDGE_RUNS.sub("", word).strip(".,;:?\"'()[]{}<>…–—&%#=~`«»“”„’‘").rstrip("!*|+-_/\\").lstrip("*|+-_/\\")
    if any(c in _CLASS for c in core) and _SUSPECT.search(core):
        return tuple(decode(lattice(core), cost).split())
    return (bare,) if bare else ()


def restore_text(text: str, cost: np.ndarray) -> str:
    """A text with its suspicious words and runs replaced by what they decode to, in lower case."""
    joined = _SPACED.sub(lambda m: decode(spaced_lattice(m[0]), cost), text.lower())
    return " ".join(w for part in joined.split() for w in restore_word(part, cost))


class Words:
    """Numbers of the distinct restored words of texts, and each word's hash buckets.

    Words met before are taken from tables of the worker process, which are emptied when they get large.
    """

    def __init__(self, cost: np.ndarray, limit: int = 300_000):
        self.cost, self.limit = cost, limit
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}  # by word as written: a number, or -1 - the place in ``several``
        self.several: list[tuple[int, ...]] = [()]
        self.number: dict[str, int] = {}
        self.rows: list[list[int]] = []
        self.table = np.zeros((0, len(PREFIXES) + 1), np.int32)

    def numbers_of(self, words: Iterable[str]) -> tuple[int, ...]:
        out = []
        for word in words:
            number = self.number.get(word)
            if number is None:
                number = self.number[word] = len(self.number)
                self.rows.append(buckets_of(word))
            out.append(number)
        return tuple(out)

    def learn(self, words: Iterable[str]) -> None:
        for word in words:
            numbers = self.numbers_of(restore_word(word, self.cost))
            if len(numbers) == 1:
                self.known[word] = numbers[0]
            elif not numbers:
                self.known[word] = -1
            else:
                self.known[word] = -1 - len(self.several)
                self.several.append(numbers)

    def buckets(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Per text an array with a row of buckets for each of its distinct restored words."""
        if len(self.known) > self.limit:
            self.clear()
        split, new, runs = [], set(), []
        for text in texts:
            low = text.lower()
            words = set(low.split())
            found = list(map(self.known.get, words))
            if None in found:
                new.update(w for w, f in zip(words, found) if f is None)
            split.append(words)
            runs.append([decode(spaced_lattice(r), self.cost).split() for r in _SPACED.findall(low)])
        self.learn(new)
        numbers = []
        for words, spaced in zip(split, runs):
            found = set(map(self.known.__getitem__, words))
            for code in [f for f in found if f < 0]:
                found.discard(code)
                found.update(self.several[-1 - code])
            for run in spaced:
                found.update(self.numbers_of(run))
            numbers.append(found)
        if self.rows:
            self.table = np.concatenate([self.table, np.array(self.rows, np.int32)]) if len(self.table) else np.array(self.rows, np.int32)
            self.rows = []
        return [self.table[np.fromiter(n, np.int64, len(n))] for n in numbers]


def words_for(cost: np.ndarray) -> Words:
    """The worker process's tables for a character model; a new model gets new ones."""
    return held("words", cost, lambda: Words(cost))


# 3. evidence and score


def buckets_of(word: str) -> list[int]:
    """Hash buckets of a word's beginnings and of the word itself; BUCKETS where it is too short."""
    code = word.encode("utf-16-le", "surrogatepass")
    out, crc, at = [], 0, 0
    for n in PREFIXES:
        if n < len(word):
            crc, at = zlib.crc32(code[at:2 * n], crc), 2 * n
            out.append(crc % BUCKETS)
        else:
            out.append(BUCKETS)
    return out + [zlib.crc32(b"=", zlib.crc32(code[at:], crc)) % BUCKETS]


@dataclass
class Evidence:
    """Counts of toxic and other documents per bucket (the last is for no bucket), and the toxic share of all."""

    toxic: np.ndarray
    other: np.ndarray
    base: float

    def of(self, buckets: np.ndarray, own_toxic: int = 0, own_other: int = 0) -> np.ndarray:
        """Log odds over the base's of words, a row of buckets each, without a document's own counts."""
        share = np.full(len(buckets), self.base)
        for b in buckets.T:
            real = b < BUCKETS
            t, o = self.toxic[b] - own_toxic * real, self.other[b] - own_other * real
            share = (t + STRENGTH * share) / (t + o + STRENGTH)
        share = np.clip(share, 1e-6, 1 - 1e-6)
        return np.log(share / (1 - share)) - math.log(self.base / (1 - self.base))


def summary(evidence: np.ndarray) -> list[float]:
    """What the logistic model sees of a document: its strongest evidences, their sum, and its length."""
    top = np.zeros(TOP)
    strong = np.sort(evidence[evidence > 0])[::-1][:TOP]
    top[:len(strong)] = strong
    return [float(top[0]), float(top[1]), float(top[2]), float(top.sum()), float((top > 2).sum()), math.log1p(len(evidence))]


N_SUMMARY = 6


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights, the constant last, by Newton's method; the ridge keeps separable cases finite."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    cost: np.ndarray
    evidence: Evidence
    weights: np.ndarray


def training_rows(labels: DataFrame, usable, max_rows: int, key: str, label: str) -> DataFrame:
    """Key and label of at most about ``max_rows`` usable labelled rows, one per key (the larger label)."""
    clean = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).filter(usable)
    each = stored(clean.groupBy(F.col(key).alias("_label_key")).agg(F.max(F.col(label).cast("int")).alias("_label")), "labels")
    n = each.count()
    if n > max_rows:
        place = F.conv(F.substring(F.md5(F.col("_label_key").cast("string")), 1, 8), 16, 10).cast("double") / 2.0**32
        each = each.filter(place < max_rows / n)
    return each


def train(
    docs: DataFrame, labels: DataFrame, usable=None, *, max_rows: int = MAX_ROWS, key: str = "doc_id",
    text: str = "text", label_key: str = "doc_id", label: str = "toxic",
) -> Broadcast:
    """The model, in a broadcast: from all texts and from the labels of usable rows (a condition on them)."""
    context = docs.sparkSession.sparkContext
    cost = character_model(count_characters(docs, text))
    shared_cost = context.broadcast(cost)
    chosen = training_rows(labels, F.lit(True) if usable is None else usable, max_rows, label_key, label)
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_body"))
    # at most about max_rows keys and labels: 9 bytes each
    labelled = texts.join(F.broadcast(chosen), F.col("_key") == F.col("_label_key")).select("_label", "_body")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_for(shared_cost.value)
        total = np.zeros((2, BUCKETS + 1), np.int32)
        rows = [0, 0]
        for batch in slices(batches):
            for y, rows_of in zip(batch.column(0).to_pylist(), words.buckets(batch.column(1).to_pylist())):
                rows[y > 0] += 1
                total[int(y > 0), np.unique(rows_of)] += 1
        used = np.flatnonzero(total[:, :BUCKETS].any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), *(pa.array(np.append(total[y, used], rows[y]).astype(np.int64)) for y in (1, 0))],
            names=["bucket", "toxic", "other"],
        )

    counted = labelled.mapInArrow(count, "bucket bigint, toxic bigint, other bigint")
    sums = counted.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    # at most BUCKETS rows of three numbers
    found = sums.toArrow().to_pandas().astype("int64").set_index("bucket")
    n1, n0 = (int(found.loc[-1, c]) if -1 in found.index else 0 for c in ("toxic", "other"))
    found = found[found.index >= 0]
    empty = np.zeros(BUCKETS + 1, np.int32)
    evidence = Evidence(empty, empty.copy(), (n1 + 0.5) / (n1 + n0 + 1))
    evidence.toxic[found.index.to_numpy()] = found["toxic"].to_numpy()
    evidence.other[found.index.to_numpy()] = found["other"].to_numpy()
    shared = context.broadcast((cost, evidence))

    def summarise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost_, known = shared.value
        words = words_for(cost_)
        for batch in slices(batches):
            rows = []
            for y, rows_of in zip(batch.column(0).to_pylist(), words.buckets(batch.column(1).to_pylist())):
                y = int(y > 0)
                rows.append([float(y), *summary(known.of(rows_of, y, 1 - y))])
            columns = zip(*rows) if rows else [[] for _ in range(N_SUMMARY + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.float64()) for c in columns], names=names)

    names = ["y", *(f"x{i}" for i in range(N_SUMMARY))]
    # one short row per labelled row: the bounded sample
    seen = labelled.mapInArrow(summarise, ", ".join(f"{n} double" for n in names)).toArrow().to_pandas().sort_values(names)
    values = seen.to_numpy(float)
    weights = fit_logistic(values[:, 1:], values[:, 0]) if len(values) else np.zeros(N_SUMMARY + 1)
    return context.broadcast(Model(cost, evidence, weights))


def scorer(shared: Broadcast) -> Callable[[], Callable[[list[str]], list[float]]]:
    """A maker of functions that score texts with a broadcast model."""

    def make() -> Callable[[list[str]], list[float]]:
        model: Model = shared.value
        words = words_for(model.cost)

        def score(texts: list[str]) -> list[float]:
            seen = np.array([summary(model.evidence.of(b)) for b in words.buckets(texts)]).reshape(-1, N_SUMMARY)
            z = np.clip(seen @ model.weights[:-1] + model.weights[-1], -30, 30)
            return (1 / (1 + np.exp(-z))).tolist()

        return score

    return make


def score_toxicity(docs: DataFrame, model: Broadcast, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the ``score`` (0 to 1) of each row's whole text."""
    make = scorer(model)

    def columns() -> Callable[[list[str]], list[list[float]]]:
        score = make()
        return lambda texts: [score(texts)]

    return per_text(docs, [key], text, {"score": "double"}, columns)


def drop_toxic(docs: DataFrame, model: Broadcast, *, reject: float = 0.7, text: str = "text") -> DataFrame:
    """Rows with a score below ``reject``, all columns as they are; no shuffle."""
    score = free_name(docs, "_score")
    return docs.withColumn(score, text_column(text, "double", scorer(model))).filter(F.col(score) < reject).drop(score)
