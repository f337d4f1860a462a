"""Queries on terms, TF-IDF, topics, classifiers and retrieval."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threadlens.config import Settings
from threadlens.functions.text import with_grams
from threadlens.functions.words import DOMAIN_STOP_WORDS, LATIN_WORD, PROFILE_STOP_WORDS, WORD, stop_words
from threadlens.operators import classify as cl
from threadlens.operators import cluster as cu
from threadlens.operators import evaluate as ev
from threadlens.operators import labels as lb
from threadlens.operators.features import TextModel, TextOptions, fit_text_model, vocabulary, vocabulary_union
from threadlens.operators.retrieve import Retriever
from threadlens.operators.sampling import random_rows
from threadlens.plans import baseline as bl
from threadlens.plans import topics as tp
from threadlens.session import cut_lineage, scratch_path
from threadlens.sources.tables import read_split
from threadlens.sources.taxonomy import TAXONOMY_SCHEMA
from workload.labels import SEED
from workload.registry import SpreadTables, Tables
from workload.registry import query as register
from workload.views import view, with_views

query = partial(register, tables=SpreadTables)
STOP = tuple(sorted(PROFILE_STOP_WORDS))
CLASSIFIER = TextOptions(max_features=10_000, min_df=2, stop=STOP)
RETRIEVAL = TextOptions(max_features=5_000, min_df=1, stop=STOP)
K_CANDIDATES = (6, 8, 10, 12)

_STOP = ", ".join(f"'{w}'" for w in STOP)


def _grams(source: str, key: str, text: str, extra: str = "") -> str:
    """SQL for words, grams and term counts of a text column."""
    return f"""words AS (SELECT {key}{extra}, LIST_FILTER(REGEXP_EXTRACT_ALL(LOWER(COALESCE({text}, '')), '{WORD}'),
  lambda x: x NOT IN ({_STOP})) AS w FROM {source}),
grams AS (SELECT {key}{extra}, LIST_CONCAT(w, LIST_TRANSFORM(RANGE(1, LEN(w)), lambda i: CONCAT(w[i], ' ', w[i+1]))) AS g FROM words),
terms AS (SELECT {key}{extra}, term, COUNT(*) AS tf FROM (SELECT {key}{extra}, UNNEST(g) AS term FROM grams) GROUP BY ALL)
"""


_VOCABULARY = """, vocab AS (SELECT term, COUNT(*) AS df, CAST(SUM(tf) AS BIGINT) AS total FROM terms
GROUP BY term HAVING COUNT(*) >= 2 ORDER BY total DESC, term LIMIT 10000)
"""
_WEIGHTS = """, idf AS (SELECT term, LN((1 + (SELECT COUNT(*) FROM documents)) / (1 + df)) + 1 AS idf FROM vocab),
raw AS (SELECT doc_id, term, tf * idf AS w FROM terms JOIN idf USING (term)),
weights AS (SELECT doc_id, term, w / SQRT(SUM(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)
"""


@query("f8_word_grams", "WITH " + _grams("documents", "doc_id", "text") + """SELECT doc_id, CAST(LEN(g) AS BIGINT) AS n_grams,
  MD5(ARRAY_TO_STRING(g, '|')) AS digest FROM grams""")
def f8(t: Tables) -> DataFrame:
    grams = with_grams(t.documents, "text", "g", WORD, STOP)
    return grams.select("doc_id", F.size("g").cast("bigint").alias("n_grams"), F.md5(F.array_join("g", "|")).alias("digest"))


@query("t1_vocabulary", "WITH " + _grams("documents", "doc_id", "text") + _VOCABULARY + "SELECT * FROM vocab")
def t1(t: Tables) -> DataFrame:
    return vocabulary(t.documents, "text", CLASSIFIER)


@query("u3_vocabulary_union", "WITH " + _grams("documents", "doc_id", "text") + _VOCABULARY + """SELECT term AS word FROM vocab
UNION SELECT lang FROM documents WHERE lang IS NOT NULL UNION SELECT 'other'""")
def u3(t: Tables) -> DataFrame:
    terms = vocabulary(t.documents, "text", CLASSIFIER)
    return vocabulary_union((terms, "term"), (t.documents, "lang"), extra=("other",))


@query("t1_vocabulary_topics")
def t1_topics(t: Tables) -> DataFrame:
    return vocabulary(t.documents, "text", topic_options())


@query("t2_tfidf", "WITH " + _grams("documents", "doc_id", "text") + _VOCABULARY + _WEIGHTS + """SELECT doc_id, term, ROUND(weight, 6) AS weight FROM weights""")
def t2(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text")
    weights = fit_text_model(docs, "text", CLASSIFIER).weights(docs, "text", "doc_id")
    return weights.withColumn("weight", F.round("weight", 6))


@query("s8_saved_text_model", "WITH " + _grams("documents", "doc_id", "text") + _VOCABULARY + _WEIGHTS + """SELECT doc_id, CAST(COUNT(*) AS BIGINT) AS n_terms,
  ROUND(SUM(weight), 6) AS weight FROM weights GROUP BY doc_id""")
def s8(t: Tables) -> DataFrame:
    docs, path = t.documents.select("doc_id", "text"), scratch_path(t.spark, "text-model")
    fit_text_model(docs, "text", CLASSIFIER).save(t.spark, path)
    weights = TextModel.load(t.spark, path).weights(docs, "text", "doc_id")
    return weights.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"), F.round(F.sum("weight"), 6).alias("weight")
    )


def topic_options() -> TextOptions:
    return TextOptions(max_features=5_000, min_df=2, pattern=LATIN_WORD, stop=tuple(stop_words(DOMAIN_STOP_WORDS)))


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )


def topic_vectors(t: Tables) -> DataFrame:
    """TF-IDF vectors of all documents, stored."""
    docs = t.documents.select("doc_id", "text")
    return cut_lineage(fit_text_model(docs, "text", topic_options()).vectors(docs, "text").select("doc_id", "features"))


@query("t3_kmeans_sweep")
def t3(t: Tables) -> DataFrame:
    found = cu.sweep_kmeans(topic_vectors(t), "features", "doc_id", K_CANDIDATES, SEED)
    rows = [(k, cost, score, k == found.k) for k, cost, score in found.scores]
    return t.spark.createDataFrame(rows, "k int, training_cost double, silhouette double, selected boolean")


_CERTIFIED = "TRUE AS nearest, TRUE AS centred"


@query("t3_sweep_certificate", f"""SELECT CAST(k AS INTEGER) AS k, (SELECT COUNT(*) FROM documents) AS n_rows, {_CERTIFIED}, TRUE AS best_selected
FROM (SELECT UNNEST([6, 8, 10, 12]) AS k) WHERE k < (SELECT COUNT(*) FROM documents)""")
def t3_certificate(t: Tables) -> DataFrame:
    """Each k's fit is at rest, and no k has a better silhouette than the one selected."""
    rows = topic_vectors(t)
    found = cu.sweep_kmeans(rows, "features", "doc_id", K_CANDIDATES, SEED)
    best = all(score <= found.silhouette for _, _, score in found.scores)
    checks = [
        cu.fixed_point(rows, found.models[k], "doc_id", 1e-4).select(F.lit(k).alias("k"), "n_rows", "nearest", "centred")
        for k, _, _ in found.scores
    ]
    return reduce(DataFrame.unionByName, checks).withColumn("best_selected", F.lit(best))


_SILHOUETTE = """WITH s AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
ORDER BY MD5(CONCAT('42:', vec_id)), vec_id LIMIT 1000),
d AS (SELECT a.vec_id, a.label, b.label AS other, LIST_DISTANCE(a.x, b.x) AS d FROM s a JOIN s b ON a.vec_id <> b.vec_id),
m AS (SELECT vec_id, label, other, AVG(d) AS d FROM d GROUP BY ALL),
ab AS (SELECT vec_id, MAX(d) FILTER (other = label) AS a, MIN(d) FILTER (other <> label) AS b FROM m GROUP BY vec_id)
SELECT ROUND(AVG(CASE WHEN a IS NULL OR GREATEST(a, b) = 0 THEN 0 ELSE (b - a) / GREATEST(a, b) END), 6) AS silhouette FROM ab"""


@register("t4_silhouette", _SILHOUETTE)
def t4(t: Tables) -> DataFrame:
    drawn = random_rows(t.embeddings, "vec_id", 1000, SEED)
    return cu.silhouette(drawn, "embedding", "label").withColumn("silhouette", F.round("silhouette", 6))


@register("t5_nearest_centroid", """WITH p AS (SELECT label, i, AVG(v) AS m FROM (
  SELECT label, UNNEST(embedding)::DOUBLE AS v, GENERATE_SUBSCRIPTS(embedding, 1) AS i FROM embeddings) GROUP BY label, i),
c AS (SELECT label, LIST(m ORDER BY i) AS centroid FROM p GROUP BY label),
d AS (SELECT vec_id, c.label, LIST_DISTANCE(embedding::DOUBLE[], centroid) AS d FROM embeddings, c)
SELECT vec_id, ARG_MIN(label, d) AS cluster_id, ROUND(MIN(d), 6) AS distance FROM d GROUP BY vec_id""")
def t5(t: Tables) -> DataFrame:
    centroids = cu.mean_vectors(t.embeddings, "label", "embedding")
    found = cu.nearest_centroid(t.embeddings.select("vec_id", "embedding"), "embedding", centroids)
    return found.select("vec_id", "cluster_id", F.round("distance", 6).alias("distance"))


@register("t5_assign_clusters")
def t5_model(t: Tables) -> DataFrame:
    rows = vectors(t)
    model = cu.fit_kmeans(rows, "features", "vec_id", 10, SEED)
    return model.transform(rows).select("vec_id", "label", "cluster_id")


@register("t5_assignment_certificate", f"SELECT COUNT(*) AS n_rows, {_CERTIFIED}, TRUE AS same_when_loaded FROM embeddings")
def t5_certificate(t: Tables) -> DataFrame:
    """A saved and loaded fit gives each row its nearest centre, and each centre is the mean of its rows."""
    rows, path = vectors(t), scratch_path(t.spark, "clusters")
    model = cu.fit_kmeans(rows, "features", "vec_id", 10, SEED)
    model.save(t.spark, path)
    loaded = cu.ClusterModel.load(t.spark, path)
    return cu.fixed_point(rows, loaded, "vec_id", 1e-4).withColumn("same_when_loaded", F.lit(loaded == model))


def cluster_sheet(t: Tables) -> tuple[DataFrame, DataFrame, cu.ClusterModel]:
    """Samples of each topic, the assigned documents, and the fit."""
    docs = t.documents.select("doc_id", "text")
    text_model = fit_text_model(docs, "text", topic_options())
    rows = cut_lineage(text_model.vectors(docs, "text"))
    found = cu.sweep_kmeans(rows, "features", "doc_id", K_CANDIDATES, SEED)
    assigned = cut_lineage(found.model.transform(rows).select("doc_id", "text", "cluster_id"))
    tops = cu.top_terms(found.model, text_model.terms, docs)
    return cu.cluster_samples(assigned, tops, "doc_id", "text", 6, SEED), assigned, found.model


@query("m7_cluster_samples")
def m7(t: Tables) -> DataFrame:
    return cluster_sheet(t)[0]


@query("m7_sample_certificate", """SELECT COUNT(*) AS n_documents, TRUE AS all_clusters, TRUE AS right_size, TRUE AS first_by_digest,
  TRUE AS ten_terms FROM documents""")
def m7_certificate(t: Tables) -> DataFrame:
    """All clusters have their sheet: the first six texts by digest, or all if there are fewer, with the cluster's size."""
    sheet, assigned, _ = cluster_sheet(t)
    sheet = cut_lineage(sheet)
    place = F.row_number().over(W.partitionBy("cluster_id").orderBy(F.md5(F.concat(F.lit(f"{SEED}:"), F.col("doc_id").cast("string"))), "doc_id"))
    drawn = assigned.withColumn("place", place).filter("place <= 6")
    sizes = assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    shown = sheet.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max("cluster_size").alias("told"), F.max("top_terms").alias("terms"),
        F.sort_array(F.collect_list("sample_text")).alias("texts"))
    wanted = drawn.groupBy("cluster_id").agg(F.sort_array(F.collect_list("text")).alias("wanted"))
    return sizes.join(shown, "cluster_id", "full").join(wanted, "cluster_id", "full").agg(
        F.sum("size").alias("n_documents"),
        F.bool_and(F.col("told").isNotNull() & F.col("size").isNotNull()).alias("all_clusters"),
        F.bool_and((F.col("told") == F.col("size")) & (F.col("rows") == F.least(F.col("size"), F.lit(6)))).alias("right_size"),
        F.bool_and(F.col("texts") == F.col("wanted")).alias("first_by_digest"),
        F.bool_and(F.size(F.split("terms", ", ")) == 10).alias("ten_terms"))


def training_pool(t: Tables) -> DataFrame:
    return lb.exclude_ids(view(t, "labeled_docs"), view(t, "golden"))


_POOL = with_views("labeled_docs", "golden") + """, pool AS (SELECT * FROM labeled_docs
WHERE customer_tweet_id NOT IN (SELECT REGEXP_REPLACE(customer_tweet_id, '\\.0+$', '') FROM golden))
"""


@query("t6_class_weights", _POOL + """SELECT intent, COUNT(*) AS n,
  ROUND((SELECT COUNT(*) / COUNT(DISTINCT intent) FROM pool WHERE intent IS NOT NULL) / COUNT(*), 6) AS weight
FROM pool WHERE intent IS NOT NULL GROUP BY intent""")
def t6_weights(t: Tables) -> DataFrame:
    return cl.class_weights(training_pool(t)).withColumn("weight", F.round("weight", 6))


@query("t6_classifier_report")
def t6(t: Tables) -> DataFrame:
    model = cl.fit_classifier(training_pool(t), "customer_text", CLASSIFIER)
    golden = view(t, "golden").drop("pred").filter("gold_intent IS NOT NULL AND gold_intent <> 'other'")
    return ev.classification_report(model.predict(golden, "customer_text"), "gold_intent", "pred")


@query("t6_optimality_certificate", _POOL + """SELECT intent, COUNT(*) AS n, TRUE AS at_minimum FROM pool WHERE intent IS NOT NULL GROUP BY intent""")
def t6_certificate(t: Tables) -> DataFrame:
    """No derivative of the penalised loss by a fitted weight is larger than 1/1000."""
    train = cut_lineage(training_pool(t).select("customer_text", "intent"))
    model = cl.fit_classifier(train, "customer_text", CLASSIFIER)
    slopes = cl.gradient(model, train, "customer_text")
    return slopes.select("intent", "n", (F.col("steepest") < 1e-3).alias("at_minimum"))


@query("t7_prediction_certificate", with_views("golden") + """SELECT customer_tweet_id, gold_intent, TRUE AS largest_margin FROM golden""")
def t7_certificate(t: Tables) -> DataFrame:
    """The predicted intent of a saved and loaded classifier is the class with the largest margin."""
    path = scratch_path(t.spark, "classifier")
    cl.fit_classifier(training_pool(t), "customer_text", CLASSIFIER).save(t.spark, path)
    model = cl.IntentClassifier.load(t.spark, path)
    golden = view(t, "golden").select("customer_tweet_id", "customer_text", "gold_intent")
    both = model.margins(model.predict(golden, "customer_text"), "customer_text", "m")
    chosen = F.element_at("m", F.array_position(F.array(*[F.lit(name) for name in model.labels]), F.col("pred")).cast("int"))
    return both.select("customer_tweet_id", "gold_intent", (chosen >= F.array_max("m") - 1e-9).alias("largest_margin"))


@query("t7_predict_intents")
def t7(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "classifier")
    cl.fit_classifier(training_pool(t), "customer_text", CLASSIFIER).save(t.spark, path)
    model = cl.IntentClassifier.load(t.spark, path)
    golden = view(t, "golden").select("customer_tweet_id", "customer_text", "gold_intent")
    return model.predict(golden, "customer_text").drop("customer_text")


RETRIEVAL_SQL = """asked AS (
SELECT REGEXP_REPLACE(customer_tweet_id, '\\.0+$', '') AS id, customer_text AS text, {intent} AS intent FROM golden),
usable AS (SELECT customer_tweet_id AS id, customer_text AS text, intent FROM labeled_docs
  WHERE brand_text IS NOT NULL AND brand_text <> '' AND customer_tweet_id NOT IN (SELECT id FROM asked)),
both_sides AS (SELECT 'q' AS side, * FROM asked WHERE intent IS NOT NULL UNION ALL SELECT 'p', * FROM usable),
""" + _grams("both_sides", "id", "text", ", side, intent") + """, counted AS (
SELECT intent, term, COUNT(*) AS df, SUM(tf) AS total FROM terms WHERE side='p' GROUP BY intent, term),
vocab AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY intent ORDER BY total DESC, term) AS place FROM counted) WHERE place <= 5000),
sizes AS (SELECT intent, COUNT(*) AS n FROM usable GROUP BY intent),
raw AS (SELECT side, id, t.intent, t.term, tf * (LN((1 + n) / (1 + df)) + 1) AS w
  FROM terms t JOIN vocab v ON t.intent=v.intent AND t.term=v.term JOIN sizes s ON t.intent=s.intent),
unit AS (SELECT side, id, intent, term, w / SQRT(SUM(w * w) OVER (PARTITION BY side, id)) AS w FROM raw),
sims AS (SELECT q.id AS query_id, p.id AS pool_id, ROUND(SUM(q.w * p.w), 6) AS similarity
  FROM unit q JOIN unit p ON q.intent=p.intent AND q.term=p.term WHERE q.side='q' AND p.side='p' GROUP BY q.id, p.id HAVING SUM(q.w * p.w) > 0),
best AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY similarity DESC, pool_id) AS INT) AS rank FROM sims ),
top AS (SELECT * FROM best WHERE rank <= 3)
"""


def retrieval_sql(intent: str) -> str:
    """The best three messages per golden row, whose intent the expression gives."""
    return with_views("labeled_docs", "golden") + ", " + RETRIEVAL_SQL.replace("{intent}", intent)


@query("topics_plan_certificate", """SELECT COUNT(*) AS n_rows, TRUE AS all_assigned, TRUE AS right_intents, TRUE AS right_split, TRUE AS same_when_loaded
FROM documents""")
def topics_plan(t: Tables) -> DataFrame:
    """Discovery on a sample, saved, loaded and applied to all rows, with every third cluster excluded."""
    pairs, path = view(t, "labeled_docs").drop("intent"), scratch_path(t.spark, "topics")
    found = tp.discover_topics(pairs, Settings(brand="brand"), topic_options(), "customer_tweet_id")
    found.topics.save(t.spark, f"{path}/models")
    topics = tp.Topics.load(t.spark, f"{path}/models")
    k = topics.clusters.k
    rows = [(c, 0, "", f"intent {c}", c % 3 != 0, "") for c in range(k)]
    tp.label_pairs(pairs, topics, t.spark.createDataFrame(rows, TAXONOMY_SCHEMA), f"{path}/split")
    labeled, excluded = read_split(t.spark, f"{path}/split")
    every = labeled.withColumn("out", F.lit(False)).unionByName(excluded.withColumn("out", F.lit(True)))
    named = F.when(F.col("cluster_id") % 3 != 0, F.concat(F.lit("intent "), F.col("cluster_id").cast("string")))
    return every.agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_and(F.coalesce(F.col("cluster_id").between(0, k - 1), F.lit(False))).alias("all_assigned"),
        F.bool_and(F.col("intent").eqNullSafe(named)).alias("right_intents"),
        F.bool_and(F.col("out") == (F.col("cluster_id") % 3 == 0)).alias("right_split"),
    ).withColumn("same_when_loaded", F.lit(topics.clusters == found.topics.clusters))


def known_intents(t: Tables) -> DataFrame:
    return t.documents.select(F.col("lang").alias("intent")).dropna().distinct()


@query("baseline_plan_predictions", _POOL + """, majority AS (SELECT intent FROM pool WHERE intent IS NOT NULL GROUP BY intent ORDER BY COUNT(*) DESC, intent LIMIT 1)
SELECT customer_tweet_id, gold_intent, (SELECT intent FROM majority) AS trivial_pred, TRUE AS simple_is_known FROM golden
WHERE gold_intent IN (SELECT lang FROM documents)""")
def baseline_predictions(t: Tables) -> DataFrame:
    found = bl.evaluate_baselines(view(t, "labeled_docs"), view(t, "golden"), known_intents(t), CLASSIFIER)
    known = F.col("simple_pred").isin(list(found.classifier.labels)).alias("simple_is_known")
    return found.predictions.select("customer_tweet_id", "gold_intent", "trivial_pred", known)


@query("baseline_plan_counts", _POOL + """, marked AS (SELECT COALESCE(gold_intent IN (SELECT lang FROM documents), FALSE) AS inside FROM golden)
SELECT COUNT(*) FILTER (inside) AS scored, COUNT(*) FILTER (NOT inside) AS outside, ROUND(AVG(CAST(NOT inside AS DOUBLE)), 6) AS outside_share,
  (SELECT COUNT(*) FROM labeled_docs) - (SELECT COUNT(*) FROM pool) AS rows_removed, 2::BIGINT AS tiers FROM marked""")
def baseline_counts(t: Tables) -> DataFrame:
    found = bl.evaluate_baselines(view(t, "labeled_docs"), view(t, "golden"), known_intents(t), CLASSIFIER)
    return found.coverage.select(
        "scored", "outside", F.round("outside_share", 6).alias("outside_share"),
        found.removed.select("rows_removed").scalar().alias("rows_removed"),
        found.report.agg(F.count_distinct("tier")).scalar().alias("tiers"))


_RETRIEVAL = retrieval_sql("gold_intent")


def retriever(t: Tables) -> Retriever:
    return Retriever(
        view(t, "labeled_docs"), RETRIEVAL, key="customer_tweet_id", exclude=view(t, "golden"),
        exclude_on="customer_tweet_id",
    )


def questions(t: Tables) -> DataFrame:
    normal = lb.normalize_id(F.col("customer_tweet_id")).alias("query_id")
    return view(t, "golden").select(normal, F.col("customer_text").alias("question"), F.col("gold_intent").alias("asked_intent"))


@query("r1_similar_exemplars", _RETRIEVAL + "SELECT query_id, pool_id AS customer_tweet_id, similarity, rank FROM top")
def r1(t: Tables) -> DataFrame:
    return retriever(t).matches(questions(t), "query_id", "question", "asked_intent", 3)


@query("r1_exemplar_lists", _RETRIEVAL + """SELECT a.id AS query_id, CAST(COUNT(t.pool_id) AS BIGINT) AS n_exemplars,
  COALESCE(STRING_AGG(d.brand_text, '|' ORDER BY t.rank), '') AS replies
FROM asked a LEFT JOIN top t ON a.id=t.query_id LEFT JOIN labeled_docs d ON t.pool_id=d.customer_tweet_id GROUP BY a.id""")
def r1_lists(t: Tables) -> DataFrame:
    found = retriever(t).retrieve(questions(t), "query_id", "question", "asked_intent", 3)
    replies = F.transform("exemplars", lambda e: e["brand_text"])
    return found.select(
        "query_id", F.size("exemplars").cast("bigint").alias("n_exemplars"), F.array_join(replies, "|").alias("replies")
    )
