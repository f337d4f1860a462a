import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from threadlens.llm import centroid_clustering as cc

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, distance string, key string, centroid string"


def brute(rows, k, rounds, size, scale, seed):
    """Plain Lloyd rounds over Python's integers."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    whole = lambda v: tuple(math.floor(x * scale) if abs(x) < 2**53 else int(x) * scale for x in v)
    centres = [whole(v) for _, v in sorted(kept, key=lambda r: (mark(r[0]), r[1]))[:k]]
    kept = [(i, whole(v)) for i, v in kept]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        to = assign()
        for n in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(kept, to) if c == n]
            if mine:
                centres[n] = tuple(sum(xs) // len(mine) for xs in zip(*mine))
    to = assign()
    sums = Counter()
    for d, c in to:
        sums[c] += d
    fits = lambda x: x if x < 2**63 else None
    return Counter((i, c, fits(d), fits(sums[c]), fits(sum(sums.values())), ",".join(map(str, centres[c])))
                   for (i, _), (d, c) in zip(kept, to))


def rows_of(rng, n, size, spread=1.0):
    return [(i, [rng.gauss(0, spread) for _ in range(size)]) for i in range(n)]


def found(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size,k,spread", [(4, 5, 1.0), (8, 12, 0.01), (64, 40, 0.2), (3, 6, 4e4), (2, 4, 1e30)])
def test_against_plain_rounds(spark, size, k, spread):
    rng = random.Random(size)
    rows = rows_of(rng, 150, size, spread)
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)] + [rows[3], rows[3], (None, rows[4][1]), (None, [0.0] * size)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * (size + 1)), (2003, [None] + [1.0] * (size - 1)),
             (2004, [float("nan")] * size), (2005, [float("inf")] + [0.0] * (size - 1))]
    table = spark.createDataFrame([(*r, *["x"] * 4) for r in rows], SCHEMA).repartition(3)
    df = cc.cluster(table, k=k, rounds=3, size=size, scale=256, seed=2)
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert found(df) == brute(rows, k, 3, size, 256, 2)


def test_few_and_none(spark):
    rows = rows_of(random.Random(1), 3, 4)
    few = spark.createDataFrame([(*r, *["x"] * 4) for r in rows], SCHEMA)
    assert found(cc.cluster(few, k=9, rounds=2, size=4)) == brute(rows, 9, 2, 4, 256, 2)
    assert cc.cluster(few.limit(0), size=4).collect() == []


def test_search_leaves_out_most_and_loses_nothing():
    rng = np.random.default_rng(5)
    centroids = [tuple(map(int, c)) for c in rng.integers(-300, 300, (40, 64)) + rng.integers(-600, 600, (40, 1))]
    vectors = (rng.integers(-300, 300, (2000, 64)) + rng.integers(-600, 600, (2000, 1))).astype(np.int64)
    book, bounds = cc.Codebook(centroids), []
    whole = cc.Codebook._bound
    book._bound = lambda *a: bounds.append(len(a[0])) or whole(book, *a)
    number, distance = book.nearest(vectors)
    every = ((vectors[:, None, :] - np.array(centroids)[None]) ** 2).sum(axis=2)
    assert (every.argmin(axis=1) == number).all() and (every.min(axis=1) == distance).all()
    assert sum(bounds) < 0.5 * every.size


def test_limbs():
    for value in [0, 1, -1, 2**40 - 1, 2**40, -(2**40), -(2**40) - 1, 5**60, -(7**50)]:
        limbs = cc._limbs(value)
        assert sum(v << (cc.LIMB * at) for at, v in limbs) == value
        assert all(abs(v) <= 2**cc.LIMB for _, v in limbs)
