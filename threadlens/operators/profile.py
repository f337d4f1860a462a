"""Profiling of the pairs: response times, lengths, shares, tokens, group counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import profile_tokens
from threadlens.functions.words import COMPLAINT_WORDS, THANK_WORDS
from threadlens.operators.ranking import count_quantiles, quantiles, value_counts
from threadlens.session import cut_lineage


def response_time_stats(pairs: DataFrame) -> DataFrame:
    """Median, 90th percentile and maximum of the known response times (one row)."""
    return quantiles(
        pairs, "response_seconds", {"median_seconds": 0.5, "p90_seconds": 0.9, "max_seconds": 1.0}
    )


def clipped_histogram(
    df: DataFrame, value: str = "response_seconds", clip: float = 0.95, bins: int = 40
) -> DataFrame:
    """Counts in equal-width bins of the values, cut off at their ``clip`` quantile.

    Works on the stored counts of distinct values. The limits are scalar subqueries. The top value
    belongs to the last bin; if all values are equal they are in the first.
    """
    counts = cut_lineage(value_counts(df, value))
    limit = count_quantiles(counts, value, {"limit": clip}).select("limit").scalar()
    clipped = counts.select(F.least(F.col(value), limit).alias("v"), "n")
    low, high = (clipped.agg(f("v")).scalar() for f in (F.min, F.max))
    ranged = clipped.withColumn("low", low).withColumn("high", high)
    place = F.width_bucket(F.col("v"), F.col("low"), F.col("high"), F.lit(bins))
    in_bin = F.when(F.col("low") < F.col("high"), F.least(place, F.lit(bins))).otherwise(F.lit(1))
    width = (F.col("high") - F.col("low")) / bins
    return (
        ranged.withColumn("bin", in_bin.cast("int"))
        .groupBy("bin")
        .agg(F.sum("n").alias("n"), F.max("low").alias("low"), F.max("high").alias("high"))
        .select(
            "bin",
            (F.col("low") + (F.col("bin") - 1) * width).alias("lower_edge"),
            (F.col("low") + F.col("bin") * width).alias("upper_edge"),
            "n",
        )
    )


def with_lengths(pairs: DataFrame) -> DataFrame:
    """Text lengths in characters."""
    return pairs.withColumns({
        "customer_len": F.length("customer_text").cast("bigint"),
        "brand_len": F.length("brand_text").cast("bigint"),
    })


def length_stats(pairs: DataFrame) -> DataFrame:
    """Mean and median text length, one row per side."""
    sides = F.array(*[
        F.struct(F.lit(side).alias("side"), F.col(f"{side}_len").alias("len")) for side in ("customer", "brand")
    ])
    counts = cut_lineage(value_counts(with_lengths(pairs).select(F.inline(sides)), "len", ["side"]))
    found = count_quantiles(counts, "len", {"median_len": 0.5}, ["side"])
    return found.withColumnRenamed("mean", "mean_len")


def context_shares(pairs: DataFrame) -> DataFrame:
    """Shares of pairs with a prior customer text and with a customer follow-up (one row)."""
    share = lambda c: F.avg(F.col(c).isNotNull().cast("double"))
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"),
        share("prior_context").alias("with_prior"),
        share("followup_text").alias("with_followup"),
    )


def keyword_rate(text: Column, words: Sequence[str]) -> Column:
    """Share of non-null texts that contain one of the words; null if there is no text."""
    return F.avg(F.lower(text).rlike("|".join(words)).cast("double"))


def followup_rates(
    pairs: DataFrame, thanks: Sequence[str] = THANK_WORDS, complaints: Sequence[str] = COMPLAINT_WORDS
) -> DataFrame:
    """Shares of follow-ups that look thankful and unresolved (one row)."""
    text = F.col("followup_text")
    return pairs.agg(
        keyword_rate(text, thanks).alias("thankful"),
        keyword_rate(text, complaints).alias("unresolved"),
    )


def group_shares(df: DataFrame, by: str) -> DataFrame:
    """Rows per group with their percentage of all rows; rows without a group count in the total."""
    counts = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", 100.0 * F.col("n") / total).orderBy(F.desc("n"), by)


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct non-null values (one row)."""
    return df.agg(F.count_distinct(column).alias("n_distinct"))


def top_tokens(df: DataFrame, text: str, n: int = 25) -> DataFrame:
    """The ``n`` most frequent tokens, ties by token."""
    return (
        df.select(F.explode_outer(profile_tokens(F.col(text))).alias("token"))
        .filter(F.col("token").isNotNull())
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(n)
    )
