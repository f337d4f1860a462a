"""SimHash near-duplicates with pigeonring filtering.

A text's fingerprint has a bit for each of the 64 bits of its shingles' hashes: 1 if more than half of the
shingles have a 1 there. Texts whose fingerprints differ in at most ``radius`` bits are linked; linked texts
form components.

Search: the 64 bits are a ring of ``radius`` + 1 segments. If two fingerprints differ in at most ``radius``
bits, there is a segment from which every chain of l consecutive segments differs in at most
l * radius / segments bits in all. So some segment is equal and together with its successor differs in at most
``chain_budget`` bits, which leaves one of ``chain_budget`` + 1 pieces of the successor equal as well. Segment
and piece are the key under which distinct fingerprints meet; pairs that break a chain's budget are pruned
before the full distance is looked at. No pair within the radius is lost, whatever the size of a key's group.

Groups are cut into blocks of ``block`` fingerprints; each pair of blocks is compared by one task, which hands
on a spanning forest of the links it found instead of all pairs. The components come from rounds of minimum
labels over stored edges; only counts reach the driver.

Null and empty texts have fingerprint 0 and are linked like any other. Repeated rows have the same fingerprint
and so the same component. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import free_name, per_text, release, row_mark, stored
from threadlens.llm.components import connected_components

SEED = 42
BITS = 64
BLOCK = 256
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_CHUNK = 1 << 14


def fingerprint(text: bytes, words: int) -> int:
    """Fingerprint of a UTF-8 text from the hashes of its shingles, repeats included."""
    parts = text.translate(_LOWER).split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(parts) - words + 1, 1)
    stops = ends[min(words, len(parts)) - 1:]
    ones, hash_of = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for a in range(0, n, _CHUNK):
        places = zip(starts[a:min(a + _CHUNK, n)].tolist(), stops[a:a + _CHUNK].tolist())
        values = np.array([hash_of(line[i:j], SEED) for i, j in places], ">u8")
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, *, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the signed 64-bit ``fingerprint`` of each row's whole text."""

    def make() -> Callable[[list[bytes]], list[list[int]]]:
        release()

        def signed(texts: list[bytes]) -> list[list[int]]:
            found = np.array([fingerprint(t, words) for t in texts], np.uint64)
            return [found.view(np.int64).tolist()]

        return signed

    return per_text(docs, [key], text, {"fingerprint": "bigint"}, make, binary=True)


def _segments(radius: int) -> list[tuple[int, int]]:
    """Shift and width of each segment, from the lowest bits up."""
    count = radius + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def chain_budget(length: int, radius: int) -> int:
    """Bits that a chain of so many segments may differ in."""
    return length * radius // (radius + 1)


def _cut(value, shift: int, width: int):
    return F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1))


def _keys(prints: DataFrame, radius: int) -> DataFrame:
    """A row for each key of each fingerprint: ``slot`` (which bits), ``first`` segment and ``bits``."""
    ring, value, keys = _segments(radius), F.col("fingerprint"), []
    if radius == 0:
        return prints.select("fingerprint", F.lit(0).alias("slot"), F.lit(0).alias("first"), value.alias("bits"))
    pieces = chain_budget(2, radius) + 1
    for i, (shift, width) in enumerate(ring):
        next_shift, next_width = ring[(i + 1) % len(ring)]
        edges = [next_width * p // pieces for p in range(pieces + 1)]
        for p, (a, b) in enumerate(zip(edges, edges[1:])):
            bits = F.shiftleft(_cut(value, shift, width), b - a).bitwiseOR(_cut(value, next_shift + a, b - a))
            keys.append(F.struct(F.lit(i * pieces + p).alias("slot"), F.lit(i).alias("first"), bits.alias("bits")))
    return prints.select("fingerprint", F.explode(F.array(*keys)).alias("k")).select("fingerprint", "k.*")


def _chains(a: np.ndarray, b: np.ndarray, first: int, radius: int) -> np.ndarray:
    """Whether the chains that begin at a segment keep their budgets, for each pair of a row and a column."""
    ring = _segments(radius)
    differ = a[:, None] ^ b[None, :]
    viable, spent = np.ones(differ.shape, bool), np.zeros(differ.shape, np.int16)
    for length in range(1, len(ring) + 1):
        shift, width = ring[(first + length - 1) % len(ring)]
        mask = np.uint64((1 << width) - 1)
        spent += np.bitwise_count((differ >> np.uint64(shift)) & mask).astype(np.int16)
        viable &= spent <= chain_budget(length, radius)
        if not viable.any():
            break
    return viable


def forest(a: np.ndarray, b: np.ndarray, first: int, radius: int) -> list[tuple[int, int]]:
    """Edges (smaller, larger signed value) that connect what the links between two blocks connect."""
    rows, columns = np.nonzero(_chains(a.view(np.uint64), b.view(np.uint64), first, radius))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    for x, y in zip(a[rows].tolist(), b[columns].tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
    return [(find(x), x) for x in list(root) if find(x) != x]


def links(prints: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints that join all pairs within the radius.

    ``prints`` has distinct values of ``fingerprint``. Keys that one fingerprint has alone are dropped by
    counts; a key with more than ``block`` fingerprints goes to several pairs of blocks.
    """
    keyed = _keys(prints, radius)
    counts = stored(
        keyed.groupBy("slot", "bits").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "simhash-keys")
    blocks = F.ceil(F.col("size") / block).cast("int")
    met = (
        keyed.join(counts, ["slot", "bits"])
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "slot", "bits", "first", "fingerprint",
            F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            (F.col("own") > F.col("other")).alias("second"),
        )
    )
    group = ["slot", "bits", "low", "high"]
    dealt = met.repartition(*group).sortWithinPartitions(*group)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rest = group + ["first", "second", "fingerprint"], None
        for batch in batches:
            held = np.rec.fromarrays([np.asarray(batch.column(n).to_numpy(zero_copy_only=False)) for n in names], names=names)
            rest = held if rest is None else np.concatenate([rest, held])
            if not len(rest):
                continue
            new = np.zeros(len(rest), bool)
            for n in group:
                new[1:] |= rest[n][1:] != rest[n][:-1]
            edges = np.flatnonzero(new)
            last = edges[-1] if len(edges) else 0
            yield from _compared(rest[:last], edges[:-1], radius)
            rest = rest[last:]
        if rest is not None and len(rest):
            yield from _compared(rest, np.zeros(0, np.int64), radius)

    return dealt.mapInArrow(compare, "a bigint, b bigint").distinct()


def _compared(rows: np.ndarray, edges: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    """Edges of the groups of sorted rows that begin at 0 and at the given places."""
    found: list[tuple[int, int]] = []
    bounds = np.concatenate([[0], edges, [len(rows)]]) if len(rows) else np.zeros(1, np.int64)
    values, second, low, high, first = (rows[n] for n in ("fingerprint", "second", "low", "high", "first"))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a < 2:
            continue
        mine = values[a:b]
        if low[a] == high[a]:
            found += forest(mine, mine, int(first[a]), radius)
        else:
            found += forest(mine[~second[a:b]], mine[second[a:b]], int(first[a]), radius)
    if found:
        left, right = zip(*found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(left, type=pa.int64()), pa.array(right, type=pa.int64())], names=["a", "b"])


def near_duplicates(
    docs: DataFrame, *, words: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text", block: int = BLOCK,
) -> DataFrame:
    """Each row's key, ``fingerprint`` (signed) and ``component_id``, the smallest key that links reach.

    The fingerprints are stored once; all later steps see a few numbers per row.
    """
    prints = stored(fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("body")), words=words,
                                 key="key", text="body"), "fingerprints")
    each = stored(prints.groupBy("fingerprint").agg(F.min("key").alias("smallest")), "fingerprint-groups")
    labels = connected_components(links(each.select("fingerprint"), radius, block))
    named = stored(
        each.join(labels, each["fingerprint"] == labels["node"], "left")
        .select("fingerprint", "smallest", F.coalesce("label", "fingerprint").alias("label")),
        "fingerprint-labels",
    )
    smallest = stored(named.groupBy("label").agg(F.min("smallest").alias("component_id")), "components")
    of_print = stored(named.join(smallest, "label").select("fingerprint", "component_id"), "fingerprint-components")
    return prints.join(of_print, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")


def drop_near_duplicates(
    docs: DataFrame, *, words: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row of each component, with all columns as they are: a row with the smallest key.

    Of several rows with that key the one with the smallest row hash stays, and of equal rows one.
    """
    marked = docs.withColumn(mark := free_name(docs, "_row_mark"), row_mark(docs, docs.columns))
    found = near_duplicates(
        marked.select(F.struct(F.col(key).alias("key"), F.col(mark).alias("mark")).alias("row"), F.col(text).alias("body")),
        words=words, radius=radius, key="row", text="body",
    )
    keep = found.filter(F.col("row") == F.col("component_id")).select(F.col("row.mark").alias(mark)).distinct()
    return marked.join(stored(keep, "kept-rows"), mark, "left_semi").dropDuplicates([mark]).select(*docs.columns)
