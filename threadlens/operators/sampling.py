"""Seeded samples. The order is the md5 of seed and id, so a sample can be drawn again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.functions.scalars import row_mean, score_bin, seeded_order
from threadlens.operators.lookup import broadcast_checked
from threadlens.operators.ranking import GROUP_LIMIT_CONF, number_by_hash, top_n_per_group
from threadlens.session import cut_lineage

EMPTY_LABELS = ("gold_intent", "gold_escalate", "escalate_reason", "labeler_notes")
DIMENSIONS = ("correctness", "tone", "actionability")
CELL_DIGITS = 4  # of a digest


def sample_per_group(df: DataFrame, by: str, key: str, n: int, seed: int) -> DataFrame:
    """Up to ``n`` random rows of each non-null group."""
    order = [F.col("_digest"), F.col(key)]
    drawn = df.filter(F.col(by).isNotNull()).withColumn("_digest", seeded_order(seed, F.col(key)))
    if n > int(df.sparkSession.conf.get(GROUP_LIMIT_CONF, "1000")):
        drawn = up_to_the_nth(drawn, by, n)
    return top_n_per_group(drawn, [by], order, n).drop("_digest", "_rank")


def up_to_the_nth(drawn: DataFrame, by: str, n: int) -> DataFrame:
    """Rows of each group whose digest begins no higher than that of the group's ``n``-th row.

    Counts per first digits of the digest, combined before the shuffle, say where that row lies; all beyond it stay where
    they are. Of a group of any size about ``n`` rows and one cell of 1/65,536 of it go on.
    """
    cell = F.substring("_digest", 1, CELL_DIGITS)
    cells = drawn.groupBy(by, cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_rows"))
    until = F.sum("_rows").over(W.partitionBy(by).orderBy("_cell"))  # a row per cell
    ends = cells.withColumn("_until", until).filter(F.col("_until") >= n).groupBy(by).agg(F.min("_cell").alias("_end"))
    return drawn.join(broadcast_checked(ends), by, "left").filter(F.coalesce(cell <= F.col("_end"), F.lit(True))).drop("_end")


def sample_listed(df: DataFrame, by: str, groups: Sequence[str], key: str, n: int, seed: int) -> DataFrame:
    """The strata of the listed groups in one table: up to ``n`` random rows of each, none of other groups."""
    return sample_per_group(df.filter(F.col(by).isin(list(groups))), by, key, n, seed)


def short_groups(df: DataFrame, by: str, n: int, groups: Sequence[str] | None = None) -> DataFrame:
    """Groups with fewer than ``n`` rows, which a sample cannot fill.

    With a list of groups, these and no others: one without rows has 0.
    """
    counts = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("available"))
    if groups is not None:
        schema = T.StructType([T.StructField(by, df.schema[by].dataType)])
        listed = df.sparkSession.createDataFrame([(g,) for g in groups], schema).distinct()
        counts = listed.join(counts, by, "left").withColumn("available", F.coalesce("available", F.lit(0).cast("bigint")))
    return counts.filter(F.col("available") < n)


def shuffle_and_number(
    df: DataFrame, key: str, seed: int, out: str = "example_id", prefix: str = "g", width: int = 4
) -> DataFrame:
    """Number the rows in random order: g0000, g0001, …"""
    digest = df.withColumn("_digest", seeded_order(seed, F.col(key)))
    numbered = number_by_hash(digest, "_digest", key, "_number")
    label = F.format_string(f"{prefix}%0{width}d", F.col("_number"))
    return numbered.select(label.alias(out), *df.columns)


def random_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Simple random sample of ``n`` rows.

    The rows per first five digits of the digest say where the sample ends, so that only a few more than
    ``n`` rows are sorted and not ``n`` of every partition.
    """
    first = F.coalesce(F.substring(seeded_order(seed, F.col(key)), 1, 5), F.lit(""))
    sizes = df.select(first.alias("_first")).groupBy("_first").agg(F.count(F.lit(1)).alias("_rows"))
    running = sizes.withColumn("_until", F.sum("_rows").over(W.orderBy("_first")))  # 16^5 rows at most
    end = running.filter(F.col("_until") >= n).agg(F.min("_first")).scalar()
    near = df.filter(first <= F.coalesce(end, F.lit("g")))  # no digit is beyond g
    return near.orderBy(seeded_order(seed, F.col(key)), key).limit(n)


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by id."""
    return df.orderBy(key).limit(n)


def golden_sheet(labeled: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Sheet for hand labelling: equal sample per intent, shuffled, with empty label columns."""
    drawn = cut_lineage(sample_per_group(labeled, "intent", key, n, seed))
    return labelling_sheet(shuffle_and_number(drawn, key, seed))


def labelling_sheet(drawn: DataFrame) -> DataFrame:
    """Choose and rename the columns a labeller sees and add the empty ones."""
    shown = ["example_id", "customer_tweet_id", "customer_text", "prior_context", "brand_text", "followup_text"]
    return drawn.select(
        *shown,
        F.col("intent").alias("suggested_intent_from_clustering"),
        *[F.lit("").alias(c) for c in EMPTY_LABELS],
    )


def with_score_bin(scores: DataFrame) -> DataFrame:
    """Add the mean score of a row and its bin."""
    average = row_mean([F.col(d) for d in DIMENSIONS])
    return scores.withColumn("avg_score", average).withColumn("score_bin", score_bin(F.col("avg_score")))


def calibration_sample(scores: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """About ``n`` rows, the same number from each score bin in use, numbered at random.

    ``n`` bounds any bin's share, so it serves as the limit Spark applies before the shuffle.
    """
    binned = with_score_bin(scores)
    used = binned.agg(F.count_distinct("score_bin")).scalar()
    per_bin = F.greatest(F.lit(1), F.floor(F.lit(n) / F.greatest(used, F.lit(1))))
    order = [seeded_order(seed, F.col(key)), F.col(key)]
    drawn = top_n_per_group(binned.filter(F.col("score_bin").isNotNull()), ["score_bin"], order, n)
    drawn = cut_lineage(drawn.filter(F.col("_rank") <= per_bin).drop("_rank"))
    return number_by_hash(
        drawn.withColumn("_digest", seeded_order(seed, F.col(key))), "_digest", key, "position"
    ).drop("_digest")


def blinded_sheet(drawn: DataFrame) -> DataFrame:
    """Sheet for a human rater: the judge's own scores are left out."""
    return drawn.select(
        "example_id", "customer_text", "reply", *[F.lit("").alias(f"human_{d}") for d in DIMENSIONS]
    )
