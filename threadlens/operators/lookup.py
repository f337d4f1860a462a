"""Joins against small tables and against tables with one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 20
MAX_BROADCAST_ROWS = 10_000


def broadcast_checked(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint after counting that the table has at most ``max_rows`` rows.

    A larger table is returned as it is and joins by shuffle, with AQE splitting hot keys.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def bucket_of(kind: str, key: Column) -> Column:
    """The bucket of a key; ``kind`` tells the keys of several joins apart."""
    return F.pmod(F.xxhash64(F.lit(kind), key), F.lit(BUCKETS))


def heavy_buckets(counts: DataFrame, key: str, kinds: dict[str, str], rows_per_split: int) -> DataFrame:
    """Buckets with a key that has more rows than one task should get, and into how many parts to split them.

    ``counts`` has a row per key and ``kinds`` its columns with the rows of each kind of join. Every heavy key
    is in one of the buckets. There are at most ``BUCKETS`` short rows whatever the number of keys, so the
    result may always be broadcast; light keys of a listed bucket are split as well, which does no harm.
    """
    each = F.array(*[F.struct(bucket_of(k, F.col(key)).alias("_bucket"), F.col(n).alias("_n")) for k, n in kinds.items()])
    return (
        counts.select(F.inline(each))
        .groupBy("_bucket").agg(F.max("_n").alias("_most"))
        .filter(F.col("_most") > rows_per_split)
        .select("_bucket", F.ceil(F.col("_most") / rows_per_split).cast("bigint").alias("_splits"))
    )


def salted_lookup(
    left: DataFrame, lookup: DataFrame, key: str, kind: str, heavy: DataFrame, spread: Column, how: str
) -> DataFrame:
    """Join ``left`` with the row of ``lookup`` (unique on ``key``) that has the same key.

    Rows of a heavy bucket go to ``_splits`` slots by ``spread``, and only the lookup rows of that
    bucket are repeated once per slot. Rows without a key are spread over all tasks. ``spread``
    must not change when a task is run again.
    """
    heavy = F.broadcast(heavy)
    slot = (
        F.when(F.col(key).isNull(), F.xxhash64(spread))
        .when(F.col("_splits").isNotNull(), F.pmod(F.xxhash64(spread), F.col("_splits")))
        .otherwise(F.lit(0).cast("bigint"))
    )
    bucket = bucket_of(kind, F.col(key))
    left = left.withColumn("_bucket", bucket).join(heavy, "_bucket", "left").withColumn("_slot", slot).drop("_splits", "_bucket")
    slots = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_splits"), F.lit(1)) - 1)
    lookup = (
        lookup.withColumn("_bucket", bucket).join(heavy, "_bucket", "left")
        .withColumn("_slot", F.explode(slots))
        .drop("_splits", "_bucket")
    )
    return left.join(lookup, [key, "_slot"], how).drop("_slot")
