"""Classification, escalation and rater-agreement metrics."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.functions.responses import OTHER
from threadlens.functions.scalars import row_mean, to_bool
from threadlens.operators.ranking import running_counts, value_counts
from threadlens.operators.sampling import DIMENSIONS
from threadlens.session import cut_lineage


def _ratio(part: Column, whole: Column) -> Column:
    """Quotient as double, 0 where there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def accuracy(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Share of equal labels (one row)."""
    right = F.coalesce(F.col(gold) == F.col(pred), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(right.cast("double")).alias("accuracy"))


def class_metrics(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support of every label seen as gold or predicted.

    Rows are counted per (gold, predicted) pair first; all else works on that small table.
    """
    cells = df.groupBy(F.col(gold).alias("_gold"), F.col(pred).alias("_pred")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    # A right answer counts once as support, once as prediction, and once as a hit.
    hit = F.when(F.col("_gold") == F.col("_pred"), F.col("_n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("_gold").alias("label"), F.col("_n").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted"), hit.cast("bigint").alias("hits")),
        F.struct(F.col("_pred").alias("label"), F.lit(0).cast("bigint").alias("support"),
                 F.col("_n").alias("predicted"), F.lit(0).cast("bigint").alias("hits")),
    )
    totals = (
        cells.select(F.inline(sides))
        .filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("support", "predicted", "hits")])
    )
    precision, recall = _ratio(F.col("hits"), F.col("predicted")), _ratio(F.col("hits"), F.col("support"))
    return (
        totals.withColumns({"precision": precision, "recall": recall})
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
        .select("label", "precision", "recall", "f1", "support")
    )


def average_metrics(per_class: DataFrame) -> DataFrame:
    """Macro and support-weighted averages over the labels (two rows)."""
    names = ("precision", "recall", "f1")
    weight = F.sum("support")
    wide = per_class.agg(
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[_ratio(F.sum(F.col(c) * F.col("support")), weight).alias(f"weighted_{c}") for c in names],
        weight.cast("bigint").alias("support"),
    )
    rows = F.array(*[
        F.struct(F.lit(f"{kind} avg").alias("label"),
                 *[F.col(f"{kind}_{c}").alias(c) for c in names], F.col("support").alias("support"))
        for kind in ("macro", "weighted")
    ])
    return wide.select(F.inline(rows))


def classification_report(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Per-class and average metrics in one table."""
    per_class = class_metrics(df, gold, pred)
    return per_class.unionByName(average_metrics(per_class))


def taxonomy_coverage(golden: DataFrame, intents: Sequence[str], pred: str) -> DataFrame:
    """Rows outside of the taxonomy, their share, and how many were called ``other`` (one row)."""
    outside = ~F.coalesce(F.col("gold_intent").isin(list(intents)), F.lit(False))
    count = F.count_if(outside)
    return golden.agg(
        F.count(F.lit(1)).alias("n"),
        count.alias("out_of_taxonomy"),
        _ratio(count, F.count(F.lit(1))).alias("share"),
        F.count_if(outside & (F.col(pred) == OTHER)).alias("called_other"),
    )


def disagreement(golden: DataFrame, suggested: str, gold: str, escalate: str) -> DataFrame:
    """Rows where the suggested intent differs from the gold one, and the escalation rate."""
    differs = F.coalesce(F.col(suggested) != F.col(gold), F.lit(True))
    return golden.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(differs).alias("disagreements"),
        F.avg(to_bool(F.col(escalate)).cast("double")).alias("escalate_rate"),
    )


def with_decisions(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Add both escalation flags as booleans."""
    return df.withColumns({"gold_flag": to_bool(F.col(gold)), "pred_flag": to_bool(F.col(pred))})


def readable_decisions(df: DataFrame, gold: str, pred: str) -> tuple[DataFrame, DataFrame]:
    """Rows with two readable flags, and those with a value that cannot be read."""
    flagged = with_decisions(df.na.drop(subset=[gold, pred]), gold, pred)
    bad = F.col("gold_flag").isNull() | F.col("pred_flag").isNull()
    return flagged.filter(~bad), flagged.filter(bad)


def confusion(decisions: DataFrame) -> DataFrame:
    """tp, fn, fp and tn of the escalation decision (one row)."""
    gold, pred = F.col("gold_flag"), F.col("pred_flag")
    return decisions.agg(
        F.count_if(gold & pred).alias("tp"), F.count_if(gold & ~pred).alias("fn"),
        F.count_if(~gold & pred).alias("fp"), F.count_if(~gold & ~pred).alias("tn"),
    )


def binary_metrics(cells: DataFrame) -> DataFrame:
    """Precision, recall and F1 of a confusion table; 0 where undefined."""
    tp = F.col("tp")
    return cells.withColumns({
        "precision": _ratio(tp, tp + F.col("fp")), "recall": _ratio(tp, tp + F.col("fn")),
    }).withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def false_negatives(decisions: DataFrame) -> DataFrame:
    """Messages that needed a person and did not get one."""
    return decisions.filter(F.col("gold_flag") & ~F.col("pred_flag"))


def with_all_scores(human: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with all three human scores, and those with one missing."""
    missing = F.lit(False)
    for d in DIMENSIONS:
        missing = missing | F.col(f"human_{d}").isNull()
    return human.filter(~missing), human.filter(missing)


def scored_count(human: DataFrame) -> DataFrame:
    """How many rows are completely scored (one row)."""
    filled = F.lit(True)
    for d in DIMENSIONS:
        filled = filled & F.col(f"human_{d}").isNotNull()
    return human.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(filled).alias("scored"))


def join_scores(human: DataFrame, judge: DataFrame, key: str = "example_id") -> DataFrame:
    """Human and judge scores of the same examples."""
    return human.select(key, *[f"human_{d}" for d in DIMENSIONS]).join(
        judge.select(key, *DIMENSIONS), key
    )


def unmatched_scores(human: DataFrame, judge: DataFrame, key: str = "example_id") -> DataFrame:
    """Number of human-scored rows the judge has not scored (one row)."""
    return human.join(judge.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("unmatched"))


def score_pairs(scores: DataFrame, overall: bool = True) -> DataFrame:
    """Long table (dimension, human, judge); ``overall`` is the mean of the three scores."""
    rows = [
        F.struct(F.lit(d).alias("dimension"), F.col(f"human_{d}").cast("double").alias("human"),
                 F.col(d).cast("double").alias("judge"))
        for d in DIMENSIONS
    ]
    if overall:
        rows.append(F.struct(
            F.lit("overall").alias("dimension"),
            row_mean([F.col(f"human_{d}") for d in DIMENSIONS]).alias("human"),
            row_mean([F.col(d) for d in DIMENSIONS]).alias("judge"),
        ))
    return scores.select(F.inline(F.array(*rows)))


def agreement(pairs: DataFrame) -> DataFrame:
    """Share within one point and mean absolute difference per dimension.

    A row with a missing score is not within one point, and has no difference.
    """
    gap = F.abs(F.col("human") - F.col("judge"))
    within = F.coalesce(gap <= 1, F.lit(False))
    return pairs.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(within.cast("double")).alias("within_1"),
        F.avg(gap).alias("mean_abs_diff"),
    )


def _average_ranks(cells: DataFrame, value: str, out: str) -> DataFrame:
    """Rank of each distinct value per dimension; ties share the mean of their places."""
    counts = cells.groupBy("dimension", value).agg(F.sum("n").alias("n"))
    ranked = running_counts(counts, value, ["dimension"])
    return ranked.select("dimension", value, (F.col("before") + (F.col("n") + 1) / 2).alias(out))


def spearman(pairs: DataFrame, skip_missing: bool = False) -> DataFrame:
    """Rank correlation per dimension with its t value; null if a side is constant.

    A missing score makes the result of its dimension null, unless ``skip_missing`` leaves
    such rows out. Equal score pairs are counted once and stored; ranks and sums work on the
    distinct pairs.
    """
    full = F.col("human").isNotNull() & F.col("judge").isNotNull()
    counted = cut_lineage(pairs.groupBy("dimension", "human", "judge").agg(F.count(F.lit(1)).alias("n")))
    cells = counted.filter(full)
    # As many rows as there are dimensions.
    size = counted.groupBy("dimension").agg(
        F.sum(F.when(full, F.col("n"))).alias("n_rows"), F.count_if(~full).alias("_missing")
    )
    ranked = (
        cells.join(_average_ranks(cells, "human", "_rh"), ["dimension", "human"])
        .join(_average_ranks(cells, "judge", "_rj"), ["dimension", "judge"])
        .join(size, "dimension")
    )
    middle = (F.col("n_rows") + 1) / 2
    dh, dj, n = F.col("_rh") - middle, F.col("_rj") - middle, F.col("n")
    sums = ranked.groupBy("dimension").agg(
        F.max("n_rows").alias("n"), F.max("_missing").alias("_missing"),
        F.sum(n * dh * dj).alias("_hj"), F.sum(n * dh * dh).alias("_hh"), F.sum(n * dj * dj).alias("_jj"),
    )
    rho = F.try_divide(F.col("_hj"), F.sqrt(F.col("_hh")) * F.sqrt(F.col("_jj")))
    if not skip_missing:
        rho = F.when(F.col("_missing") == 0, rho)
    t = F.col("rho") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("rho") * F.col("rho")))
    return sums.withColumn("rho", rho).withColumn("t", t).select("dimension", "n", "rho", "t")


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz method)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    value = d
    for m in range(1, 100_000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            c = 1.0 + step / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-14:
            break
    return value


def _two_sided_p(t: float, freedom: float) -> float:
    """Two-sided p-value of Student's t."""
    if math.isinf(t):
        return 0.0
    x, a, b = freedom / (freedom + t * t), freedom / 2.0, 0.5
    if x in (0.0, 1.0):
        return x
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


@F.pandas_udf(T.DoubleType())
def _p_values(rho: pd.Series, n: pd.Series) -> pd.Series:
    def one(r: float, rows: float) -> float | None:
        if pd.isna(r) or rows < 3:
            return None
        rest = 1.0 - r * r
        return _two_sided_p(math.inf if rest <= 0 else r * math.sqrt((rows - 2) / rest), rows - 2)

    return pd.Series([one(r, rows) for r, rows in zip(rho, n)], dtype="float64")


def with_p_value(correlations: DataFrame) -> DataFrame:
    """Add the two-sided p-value; the input has one row per dimension."""
    return correlations.withColumn("p_value", _p_values("rho", F.col("n").cast("double")))


def tag_tier(metrics: DataFrame, tier: str) -> DataFrame:
    """Metrics with the name of the classifier tier they belong to."""
    return metrics.select(F.lit(tier).alias("tier"), *metrics.columns)


def append_tiers(tiers: dict[str, DataFrame]) -> DataFrame:
    """Metrics of several classifier tiers in one table."""
    named = [tag_tier(metrics, tier) for tier, metrics in tiers.items()]
    result = named[0]
    for metrics in named[1:]:
        result = result.unionByName(metrics)
    return result
