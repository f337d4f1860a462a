"""Metrics reports as long tables (section, label, metric, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators import evaluate as ev
from threadlens.operators import profile as pf


def long_metrics(df: DataFrame, section: str, metrics: Sequence[str], label: str | None = None) -> DataFrame:
    """One row per metric of each input row, values as double."""
    entries = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])
    named = F.col(label).cast("string") if label else F.lit("")
    return df.select(F.lit(section).alias("section"), named.alias("label"), F.inline(entries))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def escalation_report(outputs: DataFrame, gold: str = "gold_escalate", pred: str = "escalate") -> DataFrame:
    """Counts and rates of the escalation decision."""
    good, _ = ev.readable_decisions(outputs, gold, pred)
    cells = ev.binary_metrics(ev.confusion(good)).withColumn(
        "n", F.col("tp") + F.col("fn") + F.col("fp") + F.col("tn")
    )
    return long_metrics(cells, "escalation", ["n", "precision", "recall", "f1", "tp", "fn", "fp", "tn"])


def agreement_report(scores: DataFrame) -> DataFrame:
    """Agreement and rank correlation per dimension and overall."""
    pairs = ev.score_pairs(scores)
    return _union([
        long_metrics(ev.agreement(pairs), "agreement", ["n", "within_1", "mean_abs_diff"], "dimension"),
        long_metrics(ev.spearman(pairs), "correlation", ["rho"], "dimension"),
    ])


def profile_report(pairs: DataFrame) -> DataFrame:
    """Response times, lengths, shares and follow-up rates of the pairs."""
    times = ["median_seconds", "p90_seconds", "max_seconds"]
    return _union([
        long_metrics(pf.response_time_stats(pairs), "response_time", times),
        long_metrics(pf.length_stats(pairs), "length", ["mean_len", "median_len"], "side"),
        long_metrics(pf.context_shares(pairs), "context", ["pairs", "with_prior", "with_followup"]),
        long_metrics(pf.followup_rates(pairs), "followup", ["thankful", "unresolved"]),
    ])
