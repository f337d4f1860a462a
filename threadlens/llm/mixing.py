"""Mixing sources to target weights, in DataFrame expressions only.

Sizes are summed per source. A share of all sizes is dealt to the sources by weight; no source gets more
than ``most`` times its own size, and what it would get beyond that goes to the others by their weights. A
source's repetition rate is its target over its size. A document is taken floor(rate) times and once more
with a probability equal to the rate's fraction, decided by a hash of the seed and the document's key, so
that every run decides alike.

Null texts have size 0. Null sources are one source, the last in order. A source of size 0 has target 0 and
its documents are taken 0 times. Repeated rows share their decision. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threadlens.llm.common import free_name, global_positions, stored, unit_hash

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most: float, source: str = "source",
) -> DataFrame:
    """``target`` for each row of (source, ``source_size``): one row per source.

    Sources take the weights in turn, by code point, null last. Capped sources are those with the smallest
    ratio of cap to weight; a source is capped if its ratio is at most the level that the rest of the
    share has for the rest of the weights. Sources are numbered and summed up by range, not in one task.
    """
    last = sizes.withColumn("_last", F.col(source).isNull().cast("int"))
    numbered = global_positions(last, ["_last", source], "_number")
    turn = (F.col("_number") % len(weights)).cast("int") + 1
    weighted = numbered.select(
        source, "source_size", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn).alias("weight"),
        (F.lit(float(most)) * F.col("source_size")).alias("cap"),
    )
    weighted = stored(weighted.withColumn("ratio", F.col("cap") / F.col("weight")), "weights")
    # sums below each ratio: a range-partitioned running sum over distinct ratios
    ratios = weighted.groupBy("ratio").agg(F.sum("cap").alias("cap"), F.sum("weight").alias("weight"))
    free, free_weight = _level(ratios, share, most)
    return weighted.select(
        source, "source_size", F.when(F.col("ratio") <= F.lit(free / free_weight), F.col("cap"))
        .otherwise(F.col("weight") * F.lit(free) / F.lit(free_weight)).alias("target"),
    )


def _level(ratios: DataFrame, share: float, most: float) -> tuple[float, float]:
    """The share and the weight that the sources above the level have among them (two numbers)."""
    ordered = global_positions(ratios, ["ratio"], "_at")
    part = ordered.withColumn("_part", F.floor(F.col("_at") / 1024))
    sums = part.groupBy("_part").agg(F.sum("cap").alias("c"), F.sum("weight").alias("w"))
    upto = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = sums.select(
        "_part", F.coalesce(F.sum("c").over(upto), F.lit(0.0)).alias("_c"),
        F.coalesce(F.sum("w").over(upto), F.lit(0)).alias("_w"))
    whole = ratios.agg(F.sum("cap"), F.sum("weight")).first()
    free, weights = (whole[0] or 0.0) / most * share, whole[1] or 0
    inside = W.partitionBy("_part").orderBy("_at")
    running = (
        part.join(before, "_part")
        .withColumn("used", F.col("_c") + F.sum("cap").over(inside) - F.col("cap"))
        .withColumn("passed", F.col("_w") + F.sum("weight").over(inside) - F.col("weight"))
        .withColumn("free", F.lit(free) - F.col("used"))
        .withColumn("free_weight", F.lit(weights) - F.col("passed"))
    )
    # the first ratio above the level that holds when all before it are capped
    above = running.filter(F.col("ratio") * F.col("free_weight") > F.col("free"))
    first = above.agg(F.min(F.struct("_at", "free", "free_weight")).alias("f")).first()["f"]
    return (float("inf"), 1.0) if first is None else (first["free"], float(first["free_weight"]))


def mix(
    docs: DataFrame, *, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7,
    key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """Each row with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (columns named so here)."""
    sized = docs.select(F.col(key), F.col(source).alias("_source"), word_count(text).alias("size"))
    return decide(sized, weights, share, most, seed, key).drop("_source")


def decide(sized: DataFrame, weights: Sequence[int], share: float, most: float, seed: int, key: str) -> DataFrame:
    """Add the decision to rows that have ``size`` and ``_source``."""
    sized = stored(sized, "sized")
    sizes = sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(stored(sizes, "source-sizes"), weights, share, most, "_source"), "targets")
    targets = targets.withColumnRenamed("_source", "_of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    extra = (unit_hash(seed, key) < rate - whole).cast("bigint")
    return (
        sized.join(targets, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")
        .withColumn("copies", whole + extra)
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def repeat_documents(
    docs: DataFrame, *, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7,
    key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The mixed corpus: every row as many times as it is taken, all columns as they are.

    Of the texts only the sizes go through the aggregation; the rows meet their source's target in a join
    with one row per source.
    """
    size, of, n = (free_name(docs, c) for c in ("_size", "_of_source", "_copies"))
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(F.sum(word_count(text)).alias("source_size"))
    targets = stored(source_targets(stored(sizes, "source-sizes"), weights, share, most, "_source"), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = targets.select(F.col("_source").alias(of), rate.alias(size))
    whole = F.floor(F.col(size))
    taken = (whole + (unit_hash(seed, key) < F.col(size) - whole).cast("bigint")).cast("int")
    return (
        docs.join(rates, F.col(source).eqNullSafe(F.col(of)), "left")
        .withColumn(n, F.explode(F.array_repeat(F.lit(1), taken)))
        .select(*docs.columns)
    )
