"""Queries on taxonomy, labelling, sampling and the leakage guard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions import scalars as sc
from threadlens.operators import labels as lb
from threadlens.operators import profile as pf
from threadlens.operators import sampling as sm
from threadlens.operators.evaluate import disagreement
from threadlens.session import scratch_path
from threadlens.sources import tables as io
from threadlens.sources.taxonomy import Taxonomy, load_taxonomy
from workload.registry import Tables, query
from workload.views import view, with_views

SEED = 42
INTENTS = ("de", "en", "es", "fr")
_IN_TAXONOMY = "gold_intent IN ('de', 'en', 'es', 'fr')"
_ASSIGNED = with_views("taxonomy", "clustered") + """, assigned AS (
SELECT c.vec_id, c.cluster_id, CASE WHEN t.include_in_training THEN t.intent END AS intent,
  COALESCE(NOT t.include_in_training, FALSE) AS is_excluded
FROM clustered c LEFT JOIN taxonomy t USING (cluster_id))
"""


def assigned(t: Tables) -> DataFrame:
    return lb.assign_intents(view(t, "clustered"), view(t, "taxonomy")).select(
        "vec_id", "cluster_id", "intent", "is_excluded"
    )


def digest(key: str) -> str:
    return f"MD5(CONCAT('{SEED}:', {key}))"


@query("s5_load_taxonomy", with_views("taxonomy") + """SELECT 'intent' AS kind, intent AS name, CAST(NULL AS INT) AS cluster_size, CAST(NULL AS STRING) AS notes
FROM taxonomy WHERE include_in_training GROUP BY intent
UNION ALL SELECT 'excluded', CAST(cluster_id AS STRING), NULL, NULL FROM taxonomy WHERE NOT include_in_training
UNION ALL SELECT 'mapping', CONCAT(CAST(cluster_id AS STRING), ' ', intent), NULL, NULL FROM taxonomy WHERE include_in_training
UNION ALL SELECT 'row', top_terms, cluster_size, notes FROM taxonomy""")
def s5(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "taxonomy")
    view(t, "taxonomy").write.options(**io.CSV_TEXT).csv(path)
    loaded = load_taxonomy(t.spark, path)

    def part(kind: str, df: DataFrame, name, size=None, notes=None) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), name.cast("string").alias("name"),
            (F.lit(None) if size is None else F.col(size)).cast("int").alias("cluster_size"),
            (F.lit(None) if notes is None else F.col(notes)).cast("string").alias("notes"),
        )

    return (
        part("intent", loaded.intents, F.col("intent"))
        .unionByName(part("excluded", loaded.excluded_clusters, F.col("cluster_id")))
        .unionByName(part("mapping", loaded.cluster_intents, F.concat_ws(" ", "cluster_id", "intent")))
        .unionByName(part("row", loaded.table, F.col("top_terms"), "cluster_size", "notes"))
    )


@query("a8_taxonomy_summary", with_views("taxonomy") + """SELECT intent,
  STRING_AGG(CAST(cluster_id AS STRING), ',' ORDER BY cluster_id) AS cluster_ids,
  CAST(SUM(cluster_size) AS BIGINT) AS cluster_size FROM taxonomy WHERE include_in_training GROUP BY intent""")
def a8(t: Tables) -> DataFrame:
    return lb.taxonomy_summary(Taxonomy(view(t, "taxonomy")).table)


@query("j6_assign_intents", _ASSIGNED + "SELECT vec_id, cluster_id, intent, is_excluded FROM assigned")
def j6(t: Tables) -> DataFrame:
    return assigned(t)


@query("p8_split_excluded", _ASSIGNED + """SELECT CASE WHEN is_excluded THEN 'excluded' ELSE 'labeled' END AS part, vec_id, cluster_id, intent FROM assigned""")
def p8(t: Tables) -> DataFrame:
    labeled, excluded = lb.split_excluded(assigned(t))
    return labeled.select(F.lit("labeled").alias("part"), "*").unionByName(
        excluded.select(F.lit("excluded").alias("part"), "*")
    )


@query("s6_write_split", _ASSIGNED + """SELECT CASE WHEN is_excluded THEN 'excluded' ELSE 'labeled' END AS part, vec_id, cluster_id, intent FROM assigned""")
def s6(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "split")
    io.write_split(assigned(t), path)
    labeled, excluded = io.read_split(t.spark, path)
    return labeled.select(F.lit("labeled").alias("part"), "*").unionByName(
        excluded.select(F.lit("excluded").alias("part"), "*")
    )


@query("a6_intent_shares", _ASSIGNED + """, labeled AS (SELECT * FROM assigned WHERE NOT is_excluded)
SELECT intent, COUNT(*) AS n, ROUND(CAST(100 AS DOUBLE) * COUNT(*) / (SELECT COUNT(*) FROM labeled), 6) AS pct
FROM labeled WHERE intent IS NOT NULL GROUP BY intent""")
def a6(t: Tables) -> DataFrame:
    labeled, _ = lb.split_excluded(assigned(t))
    return pf.group_shares(labeled, "intent").withColumn("pct", F.round("pct", 6))


@query("a7_distinct_intents", with_views("labeled_docs") + "SELECT COUNT(DISTINCT intent) AS n_distinct FROM labeled_docs")
def a7(t: Tables) -> DataFrame:
    return pf.distinct_count(view(t, "labeled_docs"), "intent")


@query("p3_fill_text", with_views("labeled_docs") + "SELECT customer_tweet_id, COALESCE(brand_text, '') AS brand_text FROM labeled_docs")
def p3(t: Tables) -> DataFrame:
    return lb.with_text(view(t, "labeled_docs"), "brand_text").select("customer_tweet_id", "brand_text")


@query("p9_usable_exemplars", with_views("labeled_docs") + """SELECT customer_tweet_id, brand_text FROM labeled_docs
WHERE brand_text IS NOT NULL AND brand_text <> ''""")
def p9(t: Tables) -> DataFrame:
    return lb.usable_exemplars(view(t, "labeled_docs")).select("customer_tweet_id", "brand_text")


@query("p4_drop_missing", with_views("golden") + """SELECT customer_tweet_id, gold_escalate, escalate,
  (SELECT COUNT(*) FROM golden) AS rows_before,
  (SELECT COUNT(*) FROM golden WHERE gold_escalate IS NULL OR escalate IS NULL) AS rows_dropped
FROM golden WHERE gold_escalate IS NOT NULL AND escalate IS NOT NULL""")
def p4(t: Tables) -> DataFrame:
    kept, counts = lb.drop_missing(view(t, "golden"), ["gold_escalate", "escalate"])
    return kept.select(
        "customer_tweet_id", "gold_escalate", "escalate",
        counts.select("rows_before").scalar().alias("rows_before"),
        counts.select("rows_dropped").scalar().alias("rows_dropped"),
    )


@query("p7_split_by_taxonomy", with_views("golden") + f"""SELECT CASE WHEN COALESCE({_IN_TAXONOMY}, FALSE) THEN 'in' ELSE 'out' END AS part,
  customer_tweet_id, gold_intent FROM golden""")
def p7(t: Tables) -> DataFrame:
    intents = t.documents.select(F.col("lang").alias("intent")).distinct()
    inside, outside = lb.split_by_taxonomy(view(t, "golden"), intents)
    shown = ["customer_tweet_id", "gold_intent"]
    return inside.select(F.lit("in").alias("part"), *shown).unionByName(
        outside.select(F.lit("out").alias("part"), *shown)
    )


@query("f4_normalize_id", with_views("golden") + "SELECT customer_tweet_id, REGEXP_REPLACE(customer_tweet_id, '\\.0+$', '') AS normal_id FROM golden")
def f4(t: Tables) -> DataFrame:
    return view(t, "golden").select(
        "customer_tweet_id", sc.normalize_id(F.col("customer_tweet_id")).alias("normal_id")
    )


_POOL = with_views("labeled_docs", "golden") + """, ids AS (SELECT REGEXP_REPLACE(customer_tweet_id, '\\.0+$', '') AS id FROM golden)
"""


@query("j7_leakage_guard", _POOL + """SELECT customer_tweet_id, intent FROM labeled_docs
WHERE customer_tweet_id NOT IN (SELECT id FROM ids)""")
def j7(t: Tables) -> DataFrame:
    return lb.exclude_ids(view(t, "labeled_docs"), view(t, "golden")).select("customer_tweet_id", "intent")


@query("j7_leakage_counts", _POOL + """SELECT COUNT(*) AS rows_before,
  COUNT(*) FILTER (customer_tweet_id IN (SELECT id FROM ids)) AS rows_removed,
  COUNT(*) FILTER (customer_tweet_id NOT IN (SELECT id FROM ids)) AS rows_after FROM labeled_docs""")
def j7_counts(t: Tables) -> DataFrame:
    return lb.exclusion_counts(view(t, "labeled_docs"), view(t, "golden"))


_MERGED = with_views("sheet", "hand_labels") + """, merged AS (
SELECT s.example_id, s.suggested_intent, h.gold_intent, h.gold_escalate, h.escalate_reason, h.labeler_notes
FROM sheet s LEFT JOIN hand_labels h USING (example_id))
"""


def merged(t: Tables) -> DataFrame:
    return lb.merge_labels(view(t, "sheet"), view(t, "hand_labels"))


@query("j8_merge_labels", _MERGED + "SELECT * FROM merged")
def j8(t: Tables) -> DataFrame:
    return merged(t).drop("customer_text")


@query("j8_unlabeled_count", _MERGED + "SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (gold_intent IS NULL) AS unlabeled FROM merged")
def j8_count(t: Tables) -> DataFrame:
    return lb.unlabeled_count(merged(t))


@query("j8_require_complete", """SELECT CAST(d.doc_id AS STRING) AS example_id, d.lang AS suggested_intent,
  CASE WHEN l.doc_id IS NULL THEN 'unseen' WHEN l.quality=0 THEN 'other' ELSE 'known' END AS gold_intent,
  CASE WHEN l.toxic=1 THEN 'True' ELSE 'False' END AS gold_escalate
FROM documents d LEFT JOIN labels l ON l.doc_id=d.doc_id""")
def j8_complete(t: Tables) -> DataFrame:
    """The whole sheet; rows that nobody has labelled get a label that says so."""
    labels, sheet = view(t, "hand_labels"), view(t, "sheet")
    rest = sheet.join(labels.select("example_id"), "example_id", "left_anti").select(
        "example_id", F.lit("unseen").alias("gold_intent"), F.lit("False").alias("gold_escalate"),
        F.lit("").alias("escalate_reason"), F.lit("").alias("labeler_notes"))
    done = lb.require_complete(lb.merge_labels(sheet, labels.select(*rest.columns).unionByName(rest)))
    return done.select("example_id", "suggested_intent", "gold_intent", "gold_escalate")


@query("a16_disagreement", _MERGED + """SELECT COUNT(*) AS n,
  COUNT(*) FILTER (COALESCE(suggested_intent <> gold_intent, TRUE)) AS disagreements,
  ROUND(AVG(CASE gold_escalate WHEN 'True' THEN 1.0::DOUBLE WHEN 'False' THEN 0.0::DOUBLE END), 6) AS escalate_rate FROM merged""")
def a16(t: Tables) -> DataFrame:
    found = disagreement(merged(t), "suggested_intent", "gold_intent", "gold_escalate")
    return found.withColumn("escalate_rate", F.round("escalate_rate", 6))


_RANKED = with_views("labeled_docs") + f""", ranked AS (
SELECT *, ROW_NUMBER() OVER (PARTITION BY intent ORDER BY {digest('customer_tweet_id')}, customer_tweet_id) AS place
FROM labeled_docs WHERE intent IS NOT NULL)
"""


@query("m1_sample_per_intent", _RANKED + "SELECT customer_tweet_id, intent FROM ranked WHERE place <= 25")
def m1(t: Tables) -> DataFrame:
    drawn = sm.sample_per_group(view(t, "labeled_docs"), "intent", "customer_tweet_id", 25, SEED)
    return drawn.select("customer_tweet_id", "intent")


@query("m1_short_groups", with_views("labeled_docs") + """SELECT intent, COUNT(*) AS available FROM labeled_docs
WHERE intent IS NOT NULL GROUP BY intent HAVING COUNT(*) < 150""")
def m1_short(t: Tables) -> DataFrame:
    return sm.short_groups(view(t, "labeled_docs"), "intent", 150)


@query("m2_shuffle_and_number", with_views("labeled_docs") + f"""SELECT customer_tweet_id,
  PRINTF('g%04d', ROW_NUMBER() OVER (ORDER BY {digest('customer_tweet_id')}, customer_tweet_id) - 1) AS example_id FROM labeled_docs""")
def m2(t: Tables) -> DataFrame:
    rows = view(t, "labeled_docs").select("customer_tweet_id")
    return sm.shuffle_and_number(rows, "customer_tweet_id", SEED)


@query("p10_golden_sheet", _RANKED + f"""SELECT
  PRINTF('g%04d', ROW_NUMBER() OVER (ORDER BY {digest('customer_tweet_id')}, customer_tweet_id) - 1) AS example_id,
  customer_tweet_id, customer_text, prior_context, brand_text, followup_text,
  intent AS suggested_intent_from_clustering, '' AS gold_intent, '' AS gold_escalate, '' AS escalate_reason, '' AS labeler_notes
FROM ranked WHERE place <= 25""")
def p10(t: Tables) -> DataFrame:
    return sm.golden_sheet(view(t, "labeled_docs"), "customer_tweet_id", 25, SEED)


_AVG = """CASE WHEN 3 - (correctness IS NULL)::INT - (tone IS NULL)::INT - (actionability IS NULL)::INT > 0 THEN
  CAST(COALESCE(correctness, 0) + COALESCE(tone, 0) + COALESCE(actionability, 0) AS DOUBLE)
  / (3 - (correctness IS NULL)::INT - (tone IS NULL)::INT - (actionability IS NULL)::INT) END"""
_BINNED = with_views("ratings") + f""", averaged AS (SELECT *, {_AVG} AS avg_score FROM ratings),
binned AS (SELECT *, CASE WHEN avg_score > 0 AND avg_score <= 2 THEN 'low' WHEN avg_score > 2 AND avg_score <= 3.5 THEN 'mid'
  WHEN avg_score > 3.5 AND avg_score <= 5 THEN 'high' END AS score_bin FROM averaged)
"""
_CALIBRATION = _BINNED + f""", placed AS (
SELECT *, ROW_NUMBER() OVER (PARTITION BY score_bin ORDER BY {digest('example_id')}, example_id) AS place FROM binned WHERE score_bin IS NOT NULL),
drawn AS (SELECT * FROM placed WHERE place <= GREATEST(1, FLOOR(40 / (SELECT COUNT(DISTINCT score_bin) FROM binned))))
"""


@query("f9_row_mean", _BINNED + "SELECT example_id, ROUND(avg_score, 6) AS avg_score FROM binned")
def f9(t: Tables) -> DataFrame:
    scores = [F.col(d) for d in sm.DIMENSIONS]
    return view(t, "ratings").select("example_id", F.round(sc.row_mean(scores), 6).alias("avg_score"))


@query("f10_score_bin", _BINNED + "SELECT example_id, score_bin FROM binned")
def f10(t: Tables) -> DataFrame:
    return sm.with_score_bin(view(t, "ratings")).select("example_id", "score_bin")


@query("m3_calibration_sample", _CALIBRATION + f"""SELECT example_id, score_bin,
  ROW_NUMBER() OVER (ORDER BY {digest('example_id')}, example_id) - 1 AS position FROM drawn""")
def m3(t: Tables) -> DataFrame:
    return sm.calibration_sample(view(t, "ratings"), "example_id", 40, SEED).select(
        "example_id", "score_bin", "position"
    )


@query("p10_blinded_sheet", _CALIBRATION + """SELECT example_id, customer_text, reply, '' AS human_correctness,
  '' AS human_tone, '' AS human_actionability FROM drawn""")
def p10_blinded(t: Tables) -> DataFrame:
    judged = view(t, "ratings").drop(*[f"human_{d}" for d in sm.DIMENSIONS])
    return sm.blinded_sheet(sm.calibration_sample(judged, "example_id", 40, SEED))


@query("m4_random_rows", f"""SELECT doc_id, lang FROM documents
ORDER BY {digest('doc_id')}, doc_id LIMIT 3000""")
def m4(t: Tables) -> DataFrame:
    return sm.random_rows(t.documents.select("doc_id", "lang"), "doc_id", 3000, SEED)


@query("m4_random_100", f"""SELECT doc_id, lang FROM documents ORDER BY {digest('doc_id')}, doc_id LIMIT 100""")
def m4_small(t: Tables) -> DataFrame:
    return sm.random_rows(t.documents.select("doc_id", "lang"), "doc_id", 100, SEED)


@query("m5_first_rows", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 10")
def m5(t: Tables) -> DataFrame:
    return sm.first_rows(t.documents.select("doc_id", "text"), "doc_id", 10)


@query("u1_concatenate_strata", _RANKED + """SELECT customer_tweet_id, intent FROM ranked WHERE place <= 25""")
def u1(t: Tables) -> DataFrame:
    drawn = sm.sample_listed(view(t, "labeled_docs"), "intent", INTENTS, "customer_tweet_id", 25, SEED)
    return drawn.select("customer_tweet_id", "intent")


_ASKED = (*INTENTS, "no such intent")


@query("m1_short_listed_groups", with_views("labeled_docs") + ", asked AS (SELECT UNNEST([" + ", ".join(f"'{i}'" for i in _ASKED) + """]) AS intent)
SELECT intent, COUNT(customer_tweet_id) AS available FROM asked LEFT JOIN labeled_docs USING (intent)
GROUP BY intent HAVING COUNT(customer_tweet_id) < 100""")
def m1_short_listed(t: Tables) -> DataFrame:
    return sm.short_groups(view(t, "labeled_docs"), "intent", 100, _ASKED)
