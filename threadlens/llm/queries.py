"""The registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm import (
    centroid_clustering, decontaminate, mixing, outliers, phrases, sharding, simhash, substring_dedup, token_counts, token_files, toxicity, url_templates, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKEN_LIMIT = 2048
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable:
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_token_files")
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_files(table(spark, folder, "documents"), path, end_id=0)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels, ~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op3_warc_salvage", """
WITH p AS (SELECT page_id, COALESCE(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(STRLEN(body) AS BIGINT) AS payload_bytes, SHA256(body) AS payload_digest FROM p),
f AS (SELECT *, MIN(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
""")
def op3_warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, folder, "pages"))


@query("op4_mix_sources", r"""
WITH sized AS (SELECT doc_id, source, CAST(LEN(REGEXP_EXTRACT_ALL(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
numbered AS (SELECT *, (ROW_NUMBER() OVER (ORDER BY ENCODE(source) NULLS LAST) - 1) % 3 AS turn FROM sources),
weighted AS (SELECT source, source_size, CASE turn WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2.0::DOUBLE * source_size AS cap FROM numbered),
ratios AS (SELECT *, cap / weight AS ratio FROM weighted),
running AS (
  SELECT ratio,
    1.5::DOUBLE * (SELECT SUM(source_size) FROM sources)::DOUBLE - (COALESCE(SUM(cap) OVER w, 0)) AS free,
    (SELECT SUM(weight) FROM weighted)::DOUBLE - COALESCE(SUM(weight) OVER w, 0)::DOUBLE AS free_weight
  FROM (SELECT ratio, SUM(cap) AS cap, SUM(weight) AS weight FROM ratios GROUP BY ratio)
  WINDOW w AS (ORDER BY ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT free, free_weight FROM running WHERE ratio * free_weight > free ORDER BY ratio LIMIT 1),
targets AS (
  SELECT r.source, r.source_size, CASE WHEN l.free IS NULL OR r.ratio <= l.free / l.free_weight THEN r.cap ELSE r.weight * l.free / l.free_weight END AS target
  FROM ratios r LEFT JOIN level l ON TRUE),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || SUBSTR(MD5('7:' || CAST(s.doc_id AS VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(FLOOR(rate) AS BIGINT) + CASE WHEN draw < rate - FLOOR(rate) THEN 1 ELSE 0 END AS copies,
  (CAST(FLOOR(rate) AS BIGINT) + CASE WHEN draw < rate - FLOOR(rate) THEN 1 ELSE 0 END) * size AS taken
FROM rated
""")
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.flag_long(token_counts.count_tokens(table(spark, folder, "documents"), path), TOKEN_LIMIT)


@query("op6_decontaminate", r"""
WITH d AS (SELECT doc_id, REGEXP_EXTRACT_ALL(TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, REGEXP_EXTRACT_ALL(TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bw AS (SELECT DISTINCT item, LEAST(LEN(words), 10) AS length, words[i : i + LEAST(LEN(words), 10) - 1] AS win
  FROM (SELECT item, words, UNNEST(RANGE(1, LEN(words) - LEAST(LEN(words), 10) + 2)) AS i FROM b WHERE LEN(words) > 0)),
lengths AS (SELECT DISTINCT length FROM bw),
dw AS (SELECT doc_id, length, i, words[i : i + length - 1] AS win
  FROM (SELECT doc_id, length, words, UNNEST(RANGE(1, LEN(words) - length + 2)) AS i FROM d JOIN lengths ON LEN(words) >= length)),
hits AS (SELECT dw.doc_id, dw.i, dw.length, bw.item FROM dw JOIN bw ON dw.length = bw.length AND dw.win = bw.win),
covered AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, UNNEST(RANGE(i, i + length)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, COUNT(*) AS n_items, STRING_AGG(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(LEN(words) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
  SHA256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_overlap(table(spark, folder, "documents"), table(spark, folder, "benchmark"), size=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op7_simhash")
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=3, radius=2)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op8_robust_outliers")
def op8_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    judged = outliers.judge(table(spark, folder, "documents"))
    return judged.select("doc_id", *outliers.STATISTICS, "base_failed", "kept")


@query("op9_url_templates")
def op9_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of a page: the quality of the document whose number its path ends in."""
    pages, labels = table(spark, folder, "pages"), table(spark, folder, "labels")
    _, path = url_templates.host_and_path("url")
    number = F.regexp_extract(path, r"([0-9]{1,18})[^0-9/]*/?$", 1)
    bad = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).select(
        "doc_id", (F.col("quality") == 0).cast("int").alias("bad"))
    urls = pages.select("page_id", "url", F.when(number != "", number.cast("bigint")).alias("number"))
    labelled = urls.join(bad, F.col("number") == F.col("doc_id"), "left").select("page_id", "url", "bad")
    return url_templates.judge_urls(labelled, RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op10_interleave_shards")
def op10_interleave_shards(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.interleave(table(spark, folder, "documents"), 8)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op11_substring_dedup", r"""
WITH d AS (SELECT doc_id, REGEXP_EXTRACT_ALL(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, i, words[i : i + 19] AS win FROM (SELECT doc_id, words, UNNEST(RANGE(1, LEN(words) - 18)) AS i FROM d WHERE LEN(words) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, ROW_NUMBER() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM w) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, UNNEST(RANGE(i, i + 20)) AS p FROM r),
each AS (SELECT doc_id, UNNEST(words) AS word, UNNEST(RANGE(1, LEN(words) + 1)) AS p FROM d),
kept AS (SELECT doc_id, COUNT(*) AS n_kept, STRING_AGG(word, ' ' ORDER BY p) AS text FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(LEN(words) AS BIGINT) AS n_words, LEN(words) - COALESCE(n_kept, 0) AS n_removed, SHA256(COALESCE(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""")
def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.find_repeats(table(spark, folder, "documents"), window=20, from_files=True)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def clustering_sql(rounds: int) -> str:
    """Assignments and centroids of each round as tables of their own."""
    steps = ["""
kept AS MATERIALIZED (
  SELECT vec_id, LIST_TRANSFORM(embedding, lambda x: CAST(FLOOR(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE LEN(embedding) = 64 AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0)""", """
c0 AS MATERIALIZED (
  SELECT ROW_NUMBER() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT SHA256('2:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h LIMIT 40))"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, v, c, distance FROM (
    SELECT vec_id, v, c, distance, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY distance, c) AS nth FROM (
      SELECT k.vec_id, k.v, m.c, LIST_SUM(LIST_TRANSFORM(LIST_ZIP(k.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
      FROM kept k, c{r} m)) WHERE nth = 1)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (SELECT c, j, SUM(x) AS s, COUNT(*) AS n FROM (SELECT c, UNNEST(v) AS x, UNNEST(RANGE(1, 65)) AS j FROM a{r}) GROUP BY c, j),
m{r} AS (SELECT c, LIST(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM s{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, COALESCE(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} ON c{r}.c = m{r}.c)""")
    return "WITH " + ",".join(steps) + f"""
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
  CAST(SUM(a.distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(SUM(a.distance) OVER () AS BIGINT) AS inertia,
  SHA256(ARRAY_TO_STRING(m.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} m ON a.c = m.c
"""


@query("op12_centroid_clustering", clustering_sql(5))
def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    found = centroid_clustering.cluster(table(spark, folder, "embeddings"), k=40, rounds=5, size=64, scale=256, seed=2)
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256"))


@query("op13_phrases", r"""
WITH p AS (SELECT doc_id, COALESCE(lang, 'und') AS lang, UNNEST(REGEXP_SPLIT_TO_ARRAY(
  TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, REGEXP_EXTRACT_ALL(piece, '[^\x20\x09]+') AS words FROM p),
g AS (SELECT lang, k, words[i : i + k - 1] AS g FROM (
  SELECT lang, k, words, UNNEST(RANGE(1, LEN(words) - k + 2)) AS i FROM w, (SELECT UNNEST(RANGE(1, 5)) AS k) WHERE LEN(words) >= k)),
f AS MATERIALIZED (SELECT lang, k, g, COUNT(*) AS f FROM g GROUP BY lang, k, g),
n AS (SELECT lang, CAST(SUM(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT * FROM f WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.k, c.g, c.f AS a, x.f AS l, y.f AS r, cut,
    CAST((2000000::HUGEINT * c.f) // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, UNNEST(RANGE(1, k)) AS cut FROM c) c
  JOIN f x ON x.lang = c.lang AND x.k = cut AND x.g = c.g[1 : cut]
  JOIN f y ON y.lang = c.lang AND y.k = c.k - cut AND y.g = c.g[cut + 1 : c.k]),
low AS (SELECT * FROM cuts QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, k, g ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, LEN(sub) AS k, sub AS g, MAX(f) AS longer FROM (
    SELECT lang, f, g[i : i + m - 1] AS sub FROM (
      SELECT lang, f, g, k, m, UNNEST(RANGE(1, k - m + 2)) AS i FROM (SELECT *, UNNEST(RANGE(2, k)) AS m FROM c)))
  GROUP BY lang, sub),
kept AS (
  SELECT low.lang, ARRAY_TO_STRING(low.g, ' ') AS phrase, a, l, r, score FROM low LEFT JOIN inside i ON i.lang = low.lang AND i.k = low.k AND i.g = low.g
  WHERE i.longer IS NULL OR 100 * i.longer < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, ENCODE(phrase)) AS rank FROM kept) JOIN n USING (lang)
WHERE rank <= 2000
""")
def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"), least=30, top=2000, from_files=True)


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
