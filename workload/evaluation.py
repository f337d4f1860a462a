"""Queries on classification, escalation and rater-agreement metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.scalars import to_bool
from threadlens.operators import classify as cl
from threadlens.operators import evaluate as ev
from threadlens.operators import labels as lb
from threadlens.plans.reports import agreement_report, escalation_report
from workload.labels import INTENTS, _IN_TAXONOMY
from workload.registry import Tables, query
from workload.views import view, with_views


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def in_taxonomy(t: Tables) -> DataFrame:
    intents = t.documents.select(F.col("lang").alias("intent")).distinct()
    return lb.split_by_taxonomy(view(t, "golden"), intents)[0]


_SCORED = with_views("golden") + f", scored AS (SELECT * FROM golden WHERE {_IN_TAXONOMY})\n"
_CLASSES = _SCORED + """, names AS (SELECT gold_intent AS label FROM scored UNION SELECT pred FROM scored),
totals AS (SELECT label, COUNT(*) FILTER (gold_intent=label AND pred=label) AS hits,
  COUNT(*) FILTER (pred=label) AS predicted, COUNT(*) FILTER (gold_intent=label) AS support
  FROM names, scored GROUP BY label),
rates AS (SELECT label, support, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS p,
  CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r FROM totals),
classes AS (SELECT label, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f, support FROM rates),
report AS (SELECT label, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1, support FROM classes
UNION ALL SELECT 'macro avg', ROUND(AVG(p), 6), ROUND(AVG(r), 6), ROUND(AVG(f), 6), CAST(SUM(support) AS BIGINT) FROM classes
UNION ALL SELECT 'weighted avg', ROUND(SUM(p * support) / SUM(support), 6), ROUND(SUM(r * support) / SUM(support), 6),
  ROUND(SUM(f * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM classes)
"""
_BOOL = "CASE WHEN LOWER(TRIM({0})) IN ('true', '1', '1.0') THEN TRUE WHEN LOWER(TRIM({0})) IN ('false', '0', '0.0') THEN FALSE END"
_FLAGS = with_views("golden") + f""", flags AS (SELECT *, {_BOOL.format('gold_escalate')} AS gold_flag, {_BOOL.format('escalate')} AS pred_flag
FROM golden WHERE gold_escalate IS NOT NULL AND escalate IS NOT NULL),
cells AS (SELECT COUNT(*) FILTER (gold_flag AND pred_flag) AS tp, COUNT(*) FILTER (gold_flag AND NOT pred_flag) AS fn,
  COUNT(*) FILTER (NOT gold_flag AND pred_flag) AS fp, COUNT(*) FILTER (NOT gold_flag AND NOT pred_flag) AS tn
  FROM flags WHERE gold_flag IS NOT NULL AND pred_flag IS NOT NULL),
rates AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM cells),
metrics AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM rates)
"""


@query("a9_majority_class", with_views("labeled_docs", "golden") + """, pool AS (SELECT * FROM labeled_docs
WHERE customer_tweet_id NOT IN (SELECT REGEXP_REPLACE(customer_tweet_id, '\\.0+$', '') FROM golden)),
top AS (SELECT intent FROM pool GROUP BY intent ORDER BY COUNT(*) DESC, intent LIMIT 1)
SELECT customer_tweet_id, (SELECT intent FROM top) AS trivial FROM golden""")
def a9(t: Tables) -> DataFrame:
    golden = view(t, "golden")
    pool = lb.exclude_ids(view(t, "labeled_docs"), golden)
    return cl.predict_majority(pool, golden.select("customer_tweet_id"), out="trivial")


@query("a10_accuracy", _SCORED + """SELECT COUNT(*) AS n, ROUND(AVG(CAST(gold_intent=pred AS DOUBLE)), 6) AS accuracy FROM scored""")
def a10(t: Tables) -> DataFrame:
    return rounded(ev.accuracy(in_taxonomy(t), "gold_intent", "pred"), "accuracy")


@query("a11_classification_report", _CLASSES + "SELECT * FROM report")
def a11(t: Tables) -> DataFrame:
    return rounded(ev.classification_report(in_taxonomy(t), "gold_intent", "pred"), "precision", "recall", "f1")


@query("f3_to_bool", with_views("golden") + f"""SELECT customer_tweet_id, {_BOOL.format('gold_escalate')} AS gold_flag,
  {_BOOL.format('escalate')} AS pred_flag FROM golden""")
def f3(t: Tables) -> DataFrame:
    return view(t, "golden").select(
        "customer_tweet_id", to_bool(F.col("gold_escalate")).alias("gold_flag"),
        to_bool(F.col("escalate")).alias("pred_flag"),
    )


@query("p5_unreadable_decisions", _FLAGS + """SELECT CASE WHEN gold_flag IS NULL OR pred_flag IS NULL THEN 'unreadable' ELSE 'kept' END AS part,
  customer_tweet_id FROM flags""")
def p5(t: Tables) -> DataFrame:
    good, bad = ev.readable_decisions(view(t, "golden"), "gold_escalate", "escalate")
    return good.select(F.lit("kept").alias("part"), "customer_tweet_id").unionByName(
        bad.select(F.lit("unreadable").alias("part"), "customer_tweet_id")
    )


def decisions(t: Tables) -> DataFrame:
    return ev.readable_decisions(view(t, "golden"), "gold_escalate", "escalate")[0]


@query("a12_confusion", _FLAGS + "SELECT * FROM cells")
def a12(t: Tables) -> DataFrame:
    return ev.confusion(decisions(t))


@query("a13_binary_metrics", _FLAGS + "SELECT tp, fn, fp, tn, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1 FROM metrics")
def a13(t: Tables) -> DataFrame:
    return rounded(ev.binary_metrics(ev.confusion(decisions(t))), "precision", "recall", "f1")


@query("a14_false_negatives", _FLAGS + "SELECT customer_tweet_id FROM flags WHERE gold_flag AND NOT pred_flag")
def a14(t: Tables) -> DataFrame:
    return ev.false_negatives(decisions(t)).select("customer_tweet_id")


@query("a14_first_false_negatives", _FLAGS + """SELECT customer_tweet_id, customer_text, escalate_reason FROM flags
WHERE gold_flag AND NOT pred_flag ORDER BY customer_tweet_id LIMIT 10""")
def a14_first(t: Tables) -> DataFrame:
    missed = ev.false_negatives(decisions(t))
    return missed.orderBy("customer_tweet_id").limit(10).select("customer_tweet_id", "customer_text", "escalate_reason")


@query("a15_taxonomy_coverage", with_views("golden") + f"""SELECT COUNT(*) AS n,
  COUNT(*) FILTER (NOT COALESCE({_IN_TAXONOMY}, FALSE)) AS out_of_taxonomy,
  ROUND(COUNT(*) FILTER (NOT COALESCE({_IN_TAXONOMY}, FALSE)) / COUNT(*), 6) AS share,
  COUNT(*) FILTER (NOT COALESCE({_IN_TAXONOMY}, FALSE) AND pred='other') AS called_other FROM golden""")
def a15(t: Tables) -> DataFrame:
    return rounded(ev.taxonomy_coverage(view(t, "golden"), INTENTS, "pred"), "share")


@query("u2_append_tiers", _CLASSES + """, trivial_totals AS (SELECT label, COUNT(*) FILTER (gold_intent=label AND label='en') AS hits,
  CASE WHEN label='en' THEN COUNT(*) ELSE 0 END AS predicted, COUNT(*) FILTER (gold_intent=label) AS support
  FROM (SELECT gold_intent AS label FROM scored UNION SELECT 'en'), scored GROUP BY label),
trivial_rates AS (SELECT label, support, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS p,
  CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r FROM trivial_totals)
SELECT 'simple' AS tier, label, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1, support FROM classes
UNION ALL SELECT 'trivial', label, ROUND(p, 6), ROUND(r, 6), ROUND(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6), support FROM trivial_rates""")
def u2(t: Tables) -> DataFrame:
    rows = in_taxonomy(t)
    trivial = cl.predict_majority(view(t, "labeled_docs"), rows, out="trivial")
    tiers = {
        "trivial": ev.class_metrics(trivial, "gold_intent", "trivial"),
        "simple": ev.class_metrics(rows, "gold_intent", "pred"),
    }
    return rounded(ev.append_tiers(tiers), "precision", "recall", "f1")


@query("s9_escalation_report", _FLAGS + """SELECT 'escalation' AS section, '' AS label, metric, ROUND(value, 6) AS value FROM (
SELECT UNNEST(['n', 'precision', 'recall', 'f1', 'tp', 'fn', 'fp', 'tn']) AS metric,
  UNNEST([tp + fn + fp + tn, p, r, f, tp, fn, fp, tn]::DOUBLE[]) AS value FROM metrics)""")
def s9_escalation(t: Tables) -> DataFrame:
    return rounded(escalation_report(view(t, "golden")), "value")


_HUMAN = with_views("ratings") + """, human AS (SELECT example_id, human_correctness, human_tone, human_actionability FROM ratings
WHERE human_correctness IS NOT NULL AND human_tone IS NOT NULL AND human_actionability IS NOT NULL),
judge AS (SELECT example_id, correctness, tone, actionability FROM ratings WHERE tone IS NOT NULL),
joined AS (SELECT * FROM human JOIN judge USING (example_id)),
joined_all AS (SELECT * FROM human JOIN (SELECT example_id, correctness, tone, actionability FROM ratings) USING (example_id))
"""


def _long(source: str) -> str:
    mean = "CAST(COALESCE(correctness, 0) + COALESCE(tone, 0) + COALESCE(actionability, 0) AS DOUBLE) / (3 - (tone IS NULL)::INT)"
    return f"""long AS (SELECT 'correctness' AS dimension, CAST(human_correctness AS DOUBLE) AS h, CAST(correctness AS DOUBLE) AS j FROM {source}
UNION ALL SELECT 'tone', human_tone, tone FROM {source} UNION ALL SELECT 'actionability', human_actionability, actionability FROM {source}
UNION ALL SELECT 'overall', CAST(human_correctness + human_tone + human_actionability AS DOUBLE) / 3, {mean} FROM {source})
"""


_RANKS = """, complete AS (SELECT * FROM long WHERE h IS NOT NULL AND j IS NOT NULL),
ranks AS (SELECT dimension,
  RANK() OVER (PARTITION BY dimension ORDER BY h) + (COUNT(*) OVER (PARTITION BY dimension, h) - 1) / 2 AS rh,
  RANK() OVER (PARTITION BY dimension ORDER BY j) + (COUNT(*) OVER (PARTITION BY dimension, j) - 1) / 2 AS rj FROM complete),
rho AS (SELECT dimension, COUNT(*) AS n, COVAR_POP(rh, rj) / NULLIF(STDDEV_POP(rh) * STDDEV_POP(rj), 0) AS rho FROM ranks GROUP BY dimension),
missing AS (SELECT dimension, COUNT(*) FILTER (h IS NULL OR j IS NULL) AS gaps FROM long GROUP BY dimension)
"""
_AGREEMENT = """, agreed AS (SELECT dimension, COUNT(*) AS n, ROUND(AVG(CAST(COALESCE(ABS(h - j) <= 1, FALSE) AS DOUBLE)), 6) AS within_1,
  ROUND(AVG(ABS(h - j)), 6) AS mean_abs_diff FROM long GROUP BY dimension)
"""


def human_rows(t: Tables) -> DataFrame:
    return ev.with_all_scores(view(t, "ratings").select("example_id", *[f"human_{d}" for d in ev.DIMENSIONS]))[0]


def all_scores(t: Tables) -> DataFrame:
    return ev.join_scores(human_rows(t), view(t, "ratings").select("example_id", *ev.DIMENSIONS))


def toned(t: Tables) -> DataFrame:
    return view(t, "ratings").select("example_id", *ev.DIMENSIONS).filter("tone IS NOT NULL")


@query("p6_rows_with_all_scores", with_views("ratings") + """SELECT CASE WHEN human_correctness IS NULL OR human_tone IS NULL
  OR human_actionability IS NULL THEN 'unfilled' ELSE 'kept' END AS part, example_id FROM ratings""")
def p6(t: Tables) -> DataFrame:
    full, unfilled = ev.with_all_scores(view(t, "ratings"))
    return full.select(F.lit("kept").alias("part"), "example_id").unionByName(
        unfilled.select(F.lit("unfilled").alias("part"), "example_id")
    )


@query("j9_join_scores", _HUMAN + "SELECT * FROM joined")
def j9(t: Tables) -> DataFrame:
    return ev.join_scores(human_rows(t), toned(t))


@query("j9_unmatched_scores", _HUMAN + "SELECT COUNT(*) AS unmatched FROM human WHERE example_id NOT IN (SELECT example_id FROM judge)")
def j9_unmatched(t: Tables) -> DataFrame:
    return ev.unmatched_scores(human_rows(t), toned(t))


@query("a17_agreement", _HUMAN + ", " + _long("joined_all") + _AGREEMENT + "SELECT * FROM agreed WHERE dimension <> 'overall'")
def a17(t: Tables) -> DataFrame:
    pairs = ev.score_pairs(all_scores(t), overall=False)
    return rounded(ev.agreement(pairs), "within_1", "mean_abs_diff")


@query("a18_spearman", _HUMAN + ", " + _long("joined_all") + _RANKS + """SELECT dimension, n,
  ROUND(CASE WHEN gaps=0 THEN rho END, 6) AS rho, ROUND(CASE WHEN gaps=0 THEN rho * SQRT((n - 2) / (1 - rho * rho)) END, 6) AS t
FROM rho JOIN missing USING (dimension) WHERE dimension <> 'overall'""")
def a18(t: Tables) -> DataFrame:
    return rounded(ev.spearman(ev.score_pairs(all_scores(t), overall=False)), "rho", "t")


@query("a18_spearman_complete_rows", _HUMAN + ", " + _long("joined_all") + _RANKS + """SELECT dimension, n, ROUND(rho, 6) AS rho,
  ROUND(rho * SQRT((n - 2) / (1 - rho * rho)), 6) AS t FROM rho WHERE dimension <> 'overall'""")
def a18_complete(t: Tables) -> DataFrame:
    return rounded(ev.spearman(ev.score_pairs(all_scores(t), overall=False), skip_missing=True), "rho", "t")


@query("a18_p_value")
def a18_p(t: Tables) -> DataFrame:
    return ev.with_p_value(ev.spearman(ev.score_pairs(all_scores(t)), skip_missing=True))


@query("a19_overall_agreement", _HUMAN + ", " + _long("joined_all") + _RANKS + _AGREEMENT + """SELECT n, within_1, ROUND(rho, 6) AS rho
FROM agreed JOIN (SELECT dimension, rho FROM rho) USING (dimension) WHERE dimension='overall'""")
def a19(t: Tables) -> DataFrame:
    overall = ev.score_pairs(all_scores(t)).filter("dimension = 'overall'")
    both = ev.agreement(overall).join(ev.spearman(overall).select("dimension", "rho"), "dimension")
    return rounded(both.select("n", "within_1", "rho"), "within_1", "rho")


@query("a20_scored_count", with_views("ratings") + """SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (human_correctness IS NOT NULL
  AND human_tone IS NOT NULL AND human_actionability IS NOT NULL) AS scored FROM ratings""")
def a20(t: Tables) -> DataFrame:
    return ev.scored_count(view(t, "ratings"))


@query("s9_agreement_report", _HUMAN + ", " + _long("joined") + _RANKS + _AGREEMENT + """SELECT 'agreement' AS section, dimension AS label, metric, value FROM (
SELECT dimension, UNNEST(['n', 'within_1', 'mean_abs_diff']) AS metric, UNNEST([n, within_1, mean_abs_diff]::DOUBLE[]) AS value FROM agreed)
UNION ALL SELECT 'correlation', dimension, 'rho', ROUND(rho, 6) FROM rho""")
def s9_agreement(t: Tables) -> DataFrame:
    return rounded(agreement_report(ev.join_scores(human_rows(t), toned(t))), "value")
