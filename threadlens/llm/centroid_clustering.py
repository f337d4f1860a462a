"""Lloyd's clustering of integer vectors with an equal-average equal-variance search for the nearest centroid.

Vectors become integers, floor(scale * component); centroids are integers as well, so every distance is exact and any
run, on any number of machines, gives the same clusters.

Search: centroids are sorted by their component sum. A vector looks at them outward from its own sum, nearer ones first. With
S the sum and D = n * sum of squares - S^2 (n^2 times the variance) of an n-component vector,

    n * distance^2 >= (S_x - S_c)^2 + (sqrt(D_x) - sqrt(D_c))^2.

If the first term alone passes n times the best distance so far, the vector is done, for all that follow are farther
out; if both together pass it, the centroid is left out; otherwise the distance is computed in integers. The
inequality's rounding is allowed for, so no centroid at the smallest distance is ever left out; of several the smallest
number wins.

Each round is one pass over the vectors: tasks hold the centroids (their number times their size, given by parameters)
and hand on sums per centroid and component, which Spark adds up; only those sums come to the driver. Sums travel as
limbs of 40 bits, so they are exact at any number of rows.

Vectors of another length, with a null, NaN or infinite component, and null vectors are left out. A null key is a key like
others, in the order of first centroids as if its digits were empty. Repeated rows count as often as they come; two
first centroids may then be equal, and the larger-numbered of them stays empty and as it is. Fewer vectors than
centroids: as many centroids as vectors. An empty table gives no rows. Distances and sums beyond a bigint are null.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import stored

SAFE = 1 << 24  # components below it leave room for all sums of squares of 64 components in 64 bits
LIMB = 40
LARGEST = 2**63 - 1


def is_whole(vector: Column, size: int) -> Column:
    """Whether a vector has ``size`` components, all of them finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == size) & ~bad, F.lit(False))


def as_integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * component) as 64-bit integers if small, else as Python's integers."""
    if not vectors.size or np.abs(vectors).max() < SAFE / scale:
        return np.floor(vectors * scale).astype(np.int64)
    floor = lambda x: int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale)
    return np.array([[floor(x) for x in row] for row in vectors.tolist()], object)


class Codebook:
    """Centroids in order of their component sums."""

    def __init__(self, centroids: list[tuple[int, ...]]):
        small = all(abs(x) < SAFE for c in centroids for x in c)
        rows = np.array(centroids, np.int64 if small else object)
        self.size = rows.shape[1]
        self.number = np.argsort(rows.sum(axis=1), kind="stable")
        self.rows = rows[self.number]
        self.sums = self.rows.sum(axis=1)
        self.spread = self.size * (self.rows * self.rows).sum(axis=1) - self.sums * self.sums

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the squared distance, for each vector."""
        n, k = len(vectors), len(self.rows)
        exact = vectors.dtype == object or self.rows.dtype == object
        vectors = vectors.astype(object) if exact else vectors
        sums = vectors.sum(axis=1)
        spread = self.size * (vectors * vectors).sum(axis=1) - sums * sums
        high = np.searchsorted(self.sums.astype(sums.dtype), sums)
        low = high - 1
        best, number = np.zeros(n, sums.dtype), np.full(n, -1)
        active = np.arange(n)
        while len(active):
            own, below, above = sums[active], low[active], high[active]
            left, right = (np.abs(own - self.sums[np.clip(at, 0, k - 1)]) for at in (below, above))
            down = (above >= k) | ((below >= 0) & (left <= right))
            at, gap = np.where(down, below, above), np.where(down, left, right)
            limit, first = self.size * best[active], number[active] < 0
            open_ = first | (gap * gap <= limit)
            active, at, gap, limit, first, down = (a[open_] for a in (active, at, gap, limit, first, down))
            near = np.ones(len(active), bool) if exact else first | (self._bound(gap, spread[active], at) <= limit)
            tried, which = active[near], at[near]
            difference = vectors[tried] - self.rows[which]
            distance = (difference * difference).sum(axis=1)
            named = self.number[which]
            better = (number[tried] < 0) | (distance < best[tried]) | ((distance == best[tried]) & (named < number[tried]))
            best[tried[better]], number[tried[better]] = distance[better], named[better]
            low[active[down]] -= 1
            high[active[~down]] += 1
            active = active[(low[active] >= 0) | (high[active] < k)]
        return number, best

    def _bound(self, gap: np.ndarray, spread: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A number that n times the squared distance is never below, rounding allowed for."""
        of = self.spread[at].astype(float)
        apart = np.sqrt(spread.astype(float)) - np.sqrt(of)
        total = gap.astype(float) ** 2 + apart * apart
        return total - 1e-12 * (total + spread + of)


def _limbs(value: int) -> list[tuple[int, int]]:
    """Position and value of the limbs of an integer; only the highest may be negative."""
    out, at = [], 0
    while abs(value) >= 1 << LIMB:
        out.append((at, value & ((1 << LIMB) - 1)))
        value, at = value >> LIMB, at + 1
    return [*out, (at, value)]


def _vectors(batch: pa.RecordBatch, size: int, scale: int) -> np.ndarray:
    flat = np.asarray(batch.column("vector").flatten().to_numpy(zero_copy_only=False), float)
    return as_integers(flat.reshape(-1, size), scale)


def _moved(kept: DataFrame, centroids: list[tuple[int, ...]], scale: int) -> list[tuple[int, ...]]:
    """The centroids after one round."""
    size = len(centroids[0])

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(centroids)
        total = np.zeros((len(centroids), size + 1), object)
        for batch in batches:
            vectors = _vectors(batch, size, scale)
            number, _ = book.nearest(vectors)
            for c in np.unique(number).tolist():
                mine = vectors[number == c]
                total[c, :size] += mine.sum(axis=0).astype(object)
                total[c, size] += len(mine)
        rows = [(c, j, at, v) for c, j in zip(*np.nonzero(total)) for at, v in _limbs(int(total[c, j]))]
        if rows:
            columns = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "component", "limb", "part"])

    parts = kept.mapInArrow(sums, "cluster int, component int, limb int, part bigint")
    total = np.zeros((len(centroids), size + 1), object)
    # a few numbers for each component of each centroid
    for r in parts.groupBy("cluster", "component", "limb").agg(F.sum("part").alias("part")).collect():
        total[r["cluster"], r["component"]] += r["part"] << (LIMB * r["limb"])
    return [tuple(int(x) // int(row[size]) for x in row[:size]) if row[size] else old for row, old in zip(total, centroids)]


def first_centroids(kept: DataFrame, k: int, seed: int, scale: int) -> list[tuple[int, ...]]:
    """The vectors whose keys have the smallest hashes; of one key's vectors the smaller first."""
    digits = F.coalesce(F.col("key").cast("string"), F.lit(""))
    chosen = kept.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), digits), 256)).orderBy("hash", "vector").limit(k)
    return [tuple(map(int, as_integers(np.array([r["vector"]], float), scale)[0])) for r in chosen.collect()]


def cluster(
    table: DataFrame, *, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2,
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """Key, ``cluster``, squared ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid`` (its integers, joined by commas)."""
    kept = table.filter(is_whole(F.col(vector), size)).select(
        F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    centroids = first_centroids(kept, k, seed, scale)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(kept, centroids, scale)
    key_type = kept.schema["key"].dataType.simpleString()

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(centroids) if centroids else None
        for batch in batches:
            if batch.num_rows:
                number, distance = book.nearest(_vectors(batch, size, scale))
                fits = [d if d <= LARGEST else None for d in distance.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array(number, pa.int32()), pa.array(fits, pa.int64())],
                    names=["key", "cluster", "distance"])

    assigned = stored(kept.mapInArrow(assign, f"key {key_type}, cluster int, distance bigint"), "assigned")
    exact = F.sum(F.col("distance").cast("decimal(20,0)"))
    inertia = lambda total, lost: F.when(lost == 0, total.try_cast("bigint"))
    groups = assigned.groupBy("cluster").agg(exact.alias("total"), F.count_if(F.isnull("distance")).alias("lost"))
    each = groups.select("cluster", "lost", "total", inertia(F.col("total"), F.col("lost")).alias("cluster_inertia"))
    every = groups.agg(F.sum("total").alias("total"), F.sum("lost").alias("lost")).select(
        inertia(F.col("total"), F.col("lost")).alias("inertia"))
    names = table.sparkSession.createDataFrame(
        [(c, ",".join(map(str, v))) for c, v in enumerate(centroids)], "cluster int, centroid string")
    totals = each.join(names, "cluster").withColumn("inertia", every.scalar()).select("cluster", "cluster_inertia", "inertia", "centroid")
    # a row per centroid
    return assigned.join(F.broadcast(totals), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
