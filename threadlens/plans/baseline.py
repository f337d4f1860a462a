"""Baselines of the intent classifier: leakage guard, both tiers, their report, coverage and predictions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators.classify import IntentClassifier, fit_classifier, predict_majority
from threadlens.operators.evaluate import append_tiers, classification_report
from threadlens.operators.features import TextOptions
from threadlens.operators.labels import exclude_ids, exclusion_counts, split_by_taxonomy, with_text
from threadlens.session import cut_lineage


@dataclass(frozen=True)
class Baselines:
    """``predictions`` has the scored rows with ``trivial_pred`` and ``simple_pred``, ``report`` the metrics of both tiers."""

    predictions: DataFrame
    report: DataFrame
    coverage: DataFrame
    removed: DataFrame
    classifier: IntentClassifier


def evaluate_baselines(
    pool: DataFrame, golden: DataFrame, intents: DataFrame, options: TextOptions, text: str = "customer_text",
    key: str = "customer_tweet_id",
) -> Baselines:
    """Train on the pool without the golden ids and score the golden rows whose intent is one of ``intents``.

    ``coverage`` counts the golden rows and those outside of the intents, which are not scored; ``removed`` the rows
    that the guard took out of the pool.
    """
    train = cut_lineage(with_text(exclude_ids(pool, golden, key), text).select(text, "intent"))
    scored, outside = split_by_taxonomy(golden, intents)
    classifier = fit_classifier(train, text, options)
    trivial = predict_majority(train, with_text(scored, text), out="trivial_pred")
    predictions = cut_lineage(classifier.predict(trivial, text, "simple_pred"))
    report = append_tiers({
        tier: classification_report(predictions, "gold_intent", f"{tier}_pred") for tier in ("trivial", "simple")})
    counts = predictions.agg(F.count(F.lit(1)).alias("scored"))
    out = outside.agg(F.count(F.lit(1)).alias("outside")).scalar()
    share = F.try_divide(F.col("outside"), F.col("scored") + F.col("outside"))
    coverage = counts.withColumn("outside", out).withColumn("outside_share", share)
    return Baselines(predictions, report, coverage, exclusion_counts(pool, golden, key), classifier)
