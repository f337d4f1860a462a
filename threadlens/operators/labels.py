"""Taxonomy lookup, splits by it, label merge and the leakage guard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.scalars import normalize_id
from threadlens.operators.lookup import broadcast_checked

LABEL_COLUMNS = ("gold_intent", "gold_escalate", "escalate_reason", "labeler_notes")

MAX_GOLDEN_IDS = 100_000


def intent_names(taxonomy: DataFrame) -> DataFrame:
    """Distinct intents that take part in training, in order."""
    return taxonomy.filter("include_in_training").select("intent").distinct().orderBy("intent")


def taxonomy_summary(taxonomy: DataFrame) -> DataFrame:
    """Clusters and sampled messages per intent; a taxonomy has one row per cluster."""
    return (
        taxonomy.filter("include_in_training")
        .groupBy("intent")
        .agg(
            F.array_join(F.sort_array(F.collect_list("cluster_id")).cast("array<string>"), ",")
            .alias("cluster_ids"),
            F.sum("cluster_size").cast("bigint").alias("cluster_size"),
        )
        .orderBy("intent")
    )


def assign_intents(clustered: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Add ``intent`` and ``is_excluded`` by cluster; an unknown cluster gets no intent and stays."""
    kept = F.col("include_in_training")
    dim = taxonomy.select(
        "cluster_id", F.when(kept, F.col("intent")).alias("intent"), (~kept).alias("_excluded")
    )
    joined = clustered.join(broadcast_checked(dim), "cluster_id", "left")
    return joined.withColumn("is_excluded", F.coalesce("_excluded", F.lit(False))).drop("_excluded")


def split_excluded(assigned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labeled and excluded rows."""
    return (
        assigned.filter(~F.col("is_excluded")).drop("is_excluded"),
        assigned.filter("is_excluded").drop("is_excluded"),
    )


def split_by_taxonomy(golden: DataFrame, intents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose gold intent is in the taxonomy, and all others (a missing one included)."""
    names = broadcast_checked(intents.select(F.col("intent").alias("gold_intent")))
    return golden.join(names, "gold_intent", "left_semi"), golden.join(names, "gold_intent", "left_anti")


def usable_exemplars(pool: DataFrame) -> DataFrame:
    """Pairs with a reply that a draft can build on."""
    return pool.filter(F.col("brand_text").isNotNull() & (F.col("brand_text") != ""))


def with_text(df: DataFrame, column: str) -> DataFrame:
    """Replace a missing text by the empty one."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit("")))


def drop_missing(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields, and the number of rows without (one row)."""
    missing = F.lit(False)
    for column in required:
        missing = missing | F.col(column).isNull()
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(missing).alias("rows_dropped")
    )
    return df.na.drop(subset=list(required)), counts


def exclude_ids(pool: DataFrame, golden: DataFrame, key: str = "customer_tweet_id") -> DataFrame:
    """Pool without the golden set's messages, ids compared without spreadsheet damage.

    The pool is not shuffled as long as the golden set has at most ``MAX_GOLDEN_IDS`` rows.
    """
    ids = golden.select(normalize_id(F.col(key)).alias(key)).filter(F.col(key).isNotNull())
    ids = broadcast_checked(ids, MAX_GOLDEN_IDS)
    return pool.withColumn(key, normalize_id(F.col(key))).join(ids, key, "left_anti")


def exclusion_counts(pool: DataFrame, golden: DataFrame, key: str = "customer_tweet_id") -> DataFrame:
    """Pool size before and after the leakage guard (one row)."""
    per_id = pool.groupBy(normalize_id(F.col(key)).alias(key)).agg(F.count(F.lit(1)).alias("_rows"))
    ids = golden.select(normalize_id(F.col(key)).alias(key), F.lit(True).alias("_hit")).distinct()
    joined = per_id.join(ids, key, "left")
    total = F.coalesce(F.sum("_rows"), F.lit(0))
    removed = F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_rows"))), F.lit(0))
    return joined.agg(
        total.cast("bigint").alias("rows_before"),
        removed.cast("bigint").alias("rows_removed"),
        (total - removed).cast("bigint").alias("rows_after"),
    )


def merge_labels(sheet: DataFrame, labels: DataFrame, key: str = "example_id") -> DataFrame:
    """Sheet with its label columns replaced by the hand labels."""
    return sheet.drop(*LABEL_COLUMNS).join(labels.select(key, *LABEL_COLUMNS), key, "left")


def unlabeled_count(merged: DataFrame) -> DataFrame:
    """Number of rows without a gold intent (one row)."""
    return merged.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("gold_intent").isNull()).alias("unlabeled")
    )


def require_complete(merged: DataFrame) -> DataFrame:
    """The merged sheet; raises while a row has no label."""
    missing = unlabeled_count(merged).first()["unlabeled"]
    if missing:
        raise ValueError(f"{missing} rows have no gold_intent; check that the example ids match")
    return merged
