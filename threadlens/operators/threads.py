"""Rebuilding (customer message, brand reply) pairs from a flat message table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.scalars import first_listed_id, seconds_between
from threadlens.operators.lookup import broadcast_checked, heavy_buckets, salted_lookup

PAIR_COLUMNS = [
    "customer_tweet_id", "customer_text", "customer_created_at", "prior_context",
    "brand_tweet_id", "brand_text", "brand_created_at", "response_seconds", "followup_text",
]
ROWS_PER_SPLIT = 500_000
_KINDS = {"reply": "_replies", "followup": "_followups", "prior": "_answers"}


def brand_replies(tweets: DataFrame, brand: str) -> DataFrame:
    """Messages the brand itself has sent."""
    return tweets.filter(~F.col("inbound") & (F.col("author_id") == brand))


def unique_tweets(tweets: DataFrame, *columns: str) -> DataFrame:
    """One row per ``tweet_id``: the earliest, a missing date last, then by text.

    A grouped minimum, so that copies of one id are combined before the shuffle.
    """
    rest = [c for c in columns if c not in ("created_at", "text")]
    first = F.min(F.struct(F.col("created_at").isNull().alias("_undated"), "created_at", "text", *rest))
    return tweets.groupBy("tweet_id").agg(first.alias("_first")).select(
        "tweet_id", *[F.col(f"_first.{c}").alias(c) for c in columns]
    )


def first_inbound(tweets: DataFrame) -> DataFrame:
    """Per ``tweet_id`` whether its first message (as in ``unique_tweets``) is inbound.

    Dates decide without the texts; only messages of ids whose earliest ones are of both kinds are
    compared by text, so texts of no others are shuffled.
    """
    undated = F.col("created_at").isNull().alias("_undated")
    first = tweets.groupBy("tweet_id").agg(
        F.min(F.struct(undated, "created_at", F.col("inbound").alias("_in"))).alias("_low"),
        F.min(F.struct(undated, "created_at", (~F.col("inbound")).alias("_out"))).alias("_high"),
    ).select("tweet_id", F.col("_low._in").alias("inbound"), (~F.col("_high._out")).alias("_other"))
    same = F.col("inbound").eqNullSafe(F.col("_other"))
    tied = tweets.join(broadcast_checked(first.filter(~same).select("tweet_id")), "tweet_id", "left_semi")
    by_text = unique_tweets(tied, "created_at", "text", "inbound").select("tweet_id", "inbound")
    return first.filter(same).drop("_other").unionByName(by_text)


def _key_counts(tweets: DataFrame, brand: str) -> DataFrame:
    """Per id, how often it is a brand reply's parent, a brand reply's follow-up, a customer's parent."""
    parent, reply = F.col("in_response_to_tweet_id"), ~F.col("inbound") & (F.col("author_id") == brand)
    named = F.array(
        F.struct(F.when(reply, parent).alias("tweet_id"), F.lit("reply").alias("_kind")),
        F.struct(F.when(reply, first_listed_id(F.col("response_tweet_id"))).alias("tweet_id"), F.lit("followup").alias("_kind")),
        F.struct(F.when(F.col("inbound"), parent).alias("tweet_id"), F.lit("prior").alias("_kind")),
    )
    each = tweets.select(F.inline(named)).filter(F.col("tweet_id").isNotNull())
    return each.groupBy("tweet_id").agg(*[F.count_if(F.col("_kind") == k).alias(n) for k, n in _KINDS.items()])


def build_pairs(tweets: DataFrame, brand: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """One row per brand reply whose parent is a customer message.

    ``prior_context`` is the text the parent answers, ``followup_text`` the first listed answer
    to the reply; both only if a customer wrote them. The prior text is attached to the
    customer message before the replies come in, so each join has a side with unique keys.
    The table is read three times: for the replies, for the numbers of rows per id, and for the
    customer messages; parent, prior and follow-up take these from one shuffle.
    """
    replies = brand_replies(tweets, brand).select(
        F.col("in_response_to_tweet_id").alias("customer_tweet_id"),
        first_listed_id(F.col("response_tweet_id")).alias("_followup_id"),
        F.col("tweet_id").alias("brand_tweet_id"),
        F.col("text").alias("brand_text"),
        F.col("created_at").alias("brand_created_at"),
        # From the row's own values, so that a task run again deals it to the same slot.
        F.xxhash64("tweet_id", "created_at", "text").alias("_seat"),
    )
    counts = _key_counts(tweets, brand)
    heavy = heavy_buckets(counts, "tweet_id", _KINDS, rows_per_split)
    # All counts are named, so that this and the heavy buckets share one shuffle.
    answered = counts.filter((F.col("_replies") > 0) & (F.col("_followups") >= 0) & (F.col("_answers") >= 0))
    written = unique_tweets(
        tweets.filter(F.col("tweet_id").isNotNull()), "text", "created_at", "inbound", "in_response_to_tweet_id"
    ).filter("inbound")

    def texts(key: str, out: str) -> DataFrame:
        return written.select(F.col("tweet_id").alias(key), F.col("text").alias(out))

    customers = written.join(answered.select("tweet_id"), "tweet_id", "left_semi").select(
        F.col("tweet_id").alias("customer_tweet_id"),
        F.col("text").alias("customer_text"),
        F.col("created_at").alias("customer_created_at"),
        F.col("in_response_to_tweet_id").alias("_prior_id"),
    )
    customers = salted_lookup(
        customers, texts("_prior_id", "prior_context"), "_prior_id", "prior", heavy, F.col("customer_tweet_id"), "left")
    pairs = salted_lookup(replies, customers, "customer_tweet_id", "reply", heavy, F.col("_seat"), "inner")
    pairs = salted_lookup(
        pairs, texts("_followup_id", "followup_text"), "_followup_id", "followup", heavy, F.col("_seat"), "left")
    seconds = seconds_between(F.col("customer_created_at"), F.col("brand_created_at"))
    return pairs.withColumn("response_seconds", seconds).select(*PAIR_COLUMNS)


def pair_drop_counts(tweets: DataFrame, brand: str) -> DataFrame:
    """How many brand replies give a pair, and why the others do not (one row).

    Replies are counted per parent first, so one much-answered parent is a single row.
    """
    parents = (
        brand_replies(tweets, brand)
        .groupBy(F.col("in_response_to_tweet_id").alias("tweet_id"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    answered = tweets.filter(F.col("tweet_id").isNotNull()).select("tweet_id", "created_at", "text", "inbound")
    found = first_inbound(answered)
    rows = F.col("_rows")
    total = lambda condition: F.coalesce(F.sum(F.when(condition, rows)), F.lit(0)).cast("bigint")
    return parents.join(found, "tweet_id", "left").agg(
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("brand_tweets"),
        total(F.col("inbound").isNull()).alias("missing_parent"),
        total(~F.col("inbound")).alias("parent_not_customer"),
        total(F.col("inbound")).alias("valid_pairs"),
    )
