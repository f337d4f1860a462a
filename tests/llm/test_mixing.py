import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.llm.data import no_documents, odd_documents, odd_rows
from threadlens.llm import mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes, weights, share, most):
    """Targets by repeated capping."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, rest, free = {}, set(order), Fraction(sum(sizes.values())) * Fraction(share)
    while rest:
        total = sum(weight[s] for s in rest)
        over = {s for s in rest if free * weight[s] / total >= sizes[s] * most}
        if not over:
            target.update({s: free * weight[s] / total for s in rest})
            break
        for s in over:
            target[s] = Fraction(sizes[s] * most)
            free -= target[s]
        rest -= over
    return target


def test_targets_and_decisions(spark):
    found = mixing.mix(odd_documents(spark)).collect()
    sizes = defaultdict(int)
    by_key = {}
    for r in odd_rows():
        n = len(WORD.findall(r[1] or ""))
        sizes[r[3]] += n
        by_key[r[0]] = (r[3], n)
    expected = water(sizes, (3, 1, 2), Fraction(3, 2), 2)
    assert len(found) == len(odd_rows())
    for r in found:
        source, n = by_key[r["doc_id"]]
        assert r["size"] == n and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(float(expected[source]))
        rate = r["target"] / r["source_size"]
        assert r["copies"] in (int(rate), int(rate) + 1) and r["taken"] == r["copies"] * n <= 2 * n
    again = mixing.mix(odd_documents(spark, 7)).collect()
    assert Counter(found) == Counter(again)


def test_many_sources(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 1500).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 1500 % 17 + F.col("id") % 3).cast("int")).alias("text"))
    sizes = defaultdict(int)
    for i in range(6000):
        sizes[f"s{i % 1500}"] += i % 1500 % 17 + i % 3
    expected = water(sizes, (3, 1, 2), Fraction(3, 2), 2)
    found = mixing.mix(docs).select("target", F.concat(F.lit("s"), F.col("doc_id") % 1500).alias("s")).distinct().collect()
    assert {r["s"]: pytest.approx(r["target"]) for r in found} == {s: float(t) for s, t in expected.items()}


def test_taken_words_come_near_the_target(spark):
    docs = spark.range(40000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 4).alias("source"), F.lit("a b c").alias("text"))
    by_source = mixing.mix(docs).groupBy("target", (F.col("doc_id") % 4)).agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r["taken"] / r["target"] - 1) < 0.03 for r in by_source)


def test_repeated_documents_match_the_decisions(spark):
    docs = odd_documents(spark)
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[r["doc_id"]] += r["copies"]
    mixed = mixing.repeat_documents(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == +copies


def test_no_documents(spark):
    assert mixing.mix(no_documents(spark)).collect() == []
    assert mixing.repeat_documents(no_documents(spark)).collect() == []
    assert sharding.interleave(no_documents(spark)).collect() == []


def test_words_are_not_all_null(spark):
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix(empty).collect()] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize("shards", [3, 8, 100])
def test_shards(spark, shards):
    import zlib

    found = sharding.interleave(odd_documents(spark), shards).collect()
    n = len(odd_rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows())
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[i]) for i in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == n and set(slots) <= set(range(shards))


def test_every_shard_matches_the_mixture(spark):
    docs = spark.range(8000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.lit("a").alias("text"))
    found = sharding.interleave(docs, 8).join(docs, "doc_id").groupBy("source", "shard").count().collect()
    by_source = defaultdict(list)
    for r in found:
        by_source[r["source"]].append(r["count"])
    # a cut falls between rows of other sources: off by less than one row per source
    assert all(len(c) == 8 and max(c) - min(c) < len(by_source) for c in by_source.values())
    assert Counter(sharding.interleave(docs, 8).collect()) == Counter(sharding.interleave(docs.repartition(5), 8).collect())
