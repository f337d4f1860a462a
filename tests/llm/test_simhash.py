import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.data import no_documents, odd_documents, odd_rows
from threadlens.llm import simhash as sh
from threadlens.llm.components import connected_components


def plain_fingerprint(text, size):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(len(words) - size + 1, 1))]
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(v >> b & 1 for v in values) * 2 > len(values)) << b for b in range(64))


def plain_components(rows, radius):
    prints = [plain_fingerprint(r[1], 3) for r in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[label[i]] = min(smallest.get(label[i], r[0]), r[0])
    return Counter((r[0], prints[i], smallest.get(label[i])) for i, r in enumerate(rows))


def near_rows():
    """Chains of near copies: one word changed after the other."""
    rng, rows = random.Random(5), list(odd_rows())
    base = [f"w{rng.randint(0, 9999)}" for _ in range(300)]
    for i in range(30):
        base[rng.randrange(300)] = f"v{i}"
        rows.append((1000 + 7 * i, " ".join(base), None, None, *["c"] * 9))
    return rows


@pytest.mark.parametrize("radius", [0, 1, 2, 4])
@pytest.mark.parametrize("block", [256, 3])
def test_components_match_all_pairs(spark, radius, block):
    from tests.llm.data import SCHEMA

    docs = spark.createDataFrame(near_rows(), SCHEMA).repartition(3)
    found = sh.near_duplicates(docs, radius=radius, block=block).collect()
    got = Counter((r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in found)
    assert got == plain_components(near_rows(), radius)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_no_link_between_close_fingerprints_is_lost(spark, radius):
    """Random and crowded fingerprints, bits flipped up to the radius; every pair by brute force."""
    rng = random.Random(radius)
    values = {rng.getrandbits(64) for _ in range(150)}
    crowd = rng.getrandbits(64)
    for _ in range(400):
        v = crowd if rng.random() < 0.5 else rng.choice(sorted(values))
        for _ in range(rng.randint(1, 2 * radius)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    signed = sorted(int(np.uint64(v).astype(np.int64)) for v in values)
    table = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    edges = sh.links(table, radius, block=16)
    assert all(((r["a"] ^ r["b"]) % 2**64).bit_count() <= 64 for r in edges.collect())
    labels = {r["node"]: r["label"] for r in connected_components(edges).collect()}
    root = {v: v for v in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[i + 1:]:
            if ((a ^ b) % 2**64).bit_count() <= radius:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    assert {v: labels.get(v, v) for v in signed} == {v: find(v) for v in signed}


def test_chains_prune_but_keep_every_pair():
    rng = random.Random(2)
    for radius in (1, 2, 3, 5):
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for _ in range(rng.randint(0, 2 * radius)):
                b ^= 1 << rng.randrange(64)
            x, y = np.array([a], np.uint64), np.array([b], np.uint64)
            viable = any(sh._chains(x, y, first, radius)[0, 0] for first in range(radius + 1))
            assert viable == ((a ^ b).bit_count() <= radius)


def test_long_path(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    shuffled = edges.select(F.pmod(F.col("a") * 71, F.lit(211)).alias("a"), F.pmod(F.col("b") * 71, F.lit(211)).alias("b"))
    labels = connected_components(shuffled).collect()
    assert len(labels) == 201 and len({r["label"] for r in labels}) == 1


def test_one_of_each_group_stays(spark):
    docs = odd_documents(spark)
    kept = sh.drop_near_duplicates(docs)
    components = {c for _, _, c in plain_components([r for r in odd_rows() if r[0] is not None], 2)}
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns
    assert sorted(i for i in ids if i is not None) == sorted(components) and ids.count(None) == 1


def test_no_documents(spark):
    assert sh.near_duplicates(no_documents(spark)).collect() == []
    assert sh.drop_near_duplicates(no_documents(spark)).collect() == []
