"""Queries on the message table and its pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions import scalars as sc
from threadlens.functions.text import profile_tokens
from threadlens.functions.words import COMPLAINT_WORDS, PROFILE_STOP_WORDS, THANK_WORDS
from threadlens.operators import profile as pf
from threadlens.operators import threads as th
from threadlens.plans.reports import profile_report
from threadlens.session import scratch_path
from threadlens.sources import tables as io
from threadlens.sources import tweets as src
from workload.registry import Tables, query
from workload.views import BRAND, EPOCH, seconds, tweets, view, with_views

PAIRS = with_views("tweets", "pairs")
_PAIR_SQL = PAIRS + "SELECT * FROM pairs"

_STAMP = f"TIMESTAMP '1970-01-01' + INTERVAL 1 SECOND * (created_s + {EPOCH})"
RAW_SQL = with_views("tweets") + f""", raw AS (
SELECT tweet_id, author_id, created_s, text, response_tweet_id, in_response_to_tweet_id,
  CASE WHEN inbound THEN CASE WHEN created_s%2=0 THEN 'True' ELSE '1' END
       WHEN created_s%11=0 THEN NULL ELSE 'False' END AS inbound,
  CASE WHEN created_s%17=0 THEN 'last Tuesday' WHEN created_s%19=0 THEN NULL
       ELSE STRFTIME({_STAMP}, '%a %b %d %H:%M:%S +0000 %Y') END AS created_at
FROM tweets)
"""
_PARSED = "CAST(EPOCH(TRY_STRPTIME(created_at, '%a %b %d %H:%M:%S %z %Y')) AS BIGINT)"
_RAW_TYPED = f"""SELECT tweet_id, author_id, COALESCE(LOWER(inbound) IN ('true', '1'), FALSE) AS inbound,
  {_PARSED} AS created_at, text, response_tweet_id, in_response_to_tweet_id FROM raw"""


def raw_tweets(t: Tables) -> DataFrame:
    """The message table as text, with dates in the export's format and some of them damaged."""
    stamp = F.to_utc_timestamp(F.timestamp_seconds(F.col("created_s") + EPOCH), F.current_timezone())
    written = F.concat(F.date_format(stamp, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(stamp, "yyyy"))
    s = F.col("created_s")
    return view(t, "tweets").select(
        "tweet_id", "author_id",
        F.when(F.col("inbound"), F.when(s % 2 == 0, "True").otherwise("1"))
        .when(s % 11 == 0, None).otherwise("False").alias("inbound"),
        F.when(s % 17 == 0, "last Tuesday").when(s % 19 == 0, None).otherwise(written).alias("created_at"),
        "text", "response_tweet_id", "in_response_to_tweet_id",
    )


def pairs(t: Tables) -> DataFrame:
    return th.build_pairs(tweets(t), BRAND)


def flat(df: DataFrame) -> DataFrame:
    """Pairs with seconds in place of timestamps."""
    return df.select(
        "customer_tweet_id", "customer_text", seconds("customer_created_at").alias("customer_created_s"),
        "prior_context", "brand_tweet_id", "brand_text", seconds("brand_created_at").alias("brand_created_s"),
        "response_seconds", "followup_text",
    )


@query("s1_load_tweets", RAW_SQL + _RAW_TYPED)
def s1(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "raw")
    raw_tweets(t).select(*src.RAW_COLUMNS).write.options(**io.CSV_TEXT).csv(path)
    loaded = src.load_tweets(t.spark, path)
    return loaded.withColumn("created_at", F.unix_timestamp("created_at"))


@query("s2_undated_counts", RAW_SQL + f"""SELECT COUNT(*) AS n_rows, COUNT(*) FILTER ({_PARSED} IS NULL) AS undated,
  COUNT(*) FILTER (created_at IS NOT NULL AND {_PARSED} IS NULL) AS unparsed,
  COUNT(*) FILTER (created_at IS NULL) AS missing FROM raw""")
def s2(t: Tables) -> DataFrame:
    return src.undated_counts(raw_tweets(t))


@query("s3_write_pairs", PAIRS + """SELECT 'parquet' AS format, * FROM pairs UNION ALL SELECT 'csv' AS format, * FROM pairs""")
def s3(t: Tables) -> DataFrame:
    parquet, csv = scratch_path(t.spark, "pairs"), scratch_path(t.spark, "pairs-csv")
    built = pairs(t)
    io.write_pairs(built, parquet, csv)
    back = [io.read_parquet(t.spark, parquet), io.read_csv(t.spark, csv, built.schema)]
    named = [flat(df).select(F.lit(f).alias("format"), "*") for f, df in zip(("parquet", "csv"), back)]
    return named[0].unionByName(named[1])


@query("s4_read_table", "SELECT conv_id, turn, role, text FROM conversations")
def s4(t: Tables) -> DataFrame:
    return io.read_parquet(t.spark, f"{t.folder}/conversations.parquet").select("conv_id", "turn", "role", "text")


@query("p1_brand_replies", with_views("tweets") + """SELECT tweet_id, author_id, text FROM tweets
WHERE NOT inbound AND author_id='brand'""")
def p1(t: Tables) -> DataFrame:
    return th.brand_replies(tweets(t), BRAND).select("tweet_id", "author_id", "text")


@query("p2_text_lengths", PAIRS + """SELECT brand_tweet_id, LENGTH(customer_text) AS customer_len,
  LENGTH(brand_text) AS brand_len FROM pairs""")
def p2(t: Tables) -> DataFrame:
    return pf.with_lengths(pairs(t)).select("brand_tweet_id", "customer_len", "brand_len")


@query("j1_build_pairs", _PAIR_SQL)
def j1(t: Tables) -> DataFrame:
    return flat(pairs(t))


@query("j2_prior_context", PAIRS + "SELECT brand_tweet_id, prior_context FROM pairs")
def j2(t: Tables) -> DataFrame:
    return pairs(t).select("brand_tweet_id", "prior_context")


@query("j3_followup", PAIRS + "SELECT brand_tweet_id, followup_text FROM pairs")
def j3(t: Tables) -> DataFrame:
    return pairs(t).select("brand_tweet_id", "followup_text")


@query("j4_pair_drop_counts", with_views("tweets") + """SELECT COUNT(*) AS brand_tweets,
  COUNT(*) FILTER (c.tweet_id IS NULL) AS missing_parent,
  COUNT(*) FILTER (NOT c.inbound) AS parent_not_customer, COUNT(*) FILTER (c.inbound) AS valid_pairs
FROM tweets b LEFT JOIN tweets c ON b.in_response_to_tweet_id=c.tweet_id
WHERE NOT b.inbound AND b.author_id='brand'""")
def j4(t: Tables) -> DataFrame:
    return th.pair_drop_counts(tweets(t), BRAND)


@query("j5_first_of_duplicates", with_views("tweets") + """, twice AS (
SELECT * FROM tweets UNION ALL
SELECT tweet_id, author_id, inbound, created_s + LENGTH(text)%3, CONCAT('a copy of ', text), response_tweet_id, in_response_to_tweet_id
FROM tweets), first AS (
SELECT *, ROW_NUMBER() OVER (PARTITION BY tweet_id ORDER BY created_s, text) AS place FROM twice)
SELECT tweet_id, created_s, text, inbound FROM first WHERE place=1""")
def j5(t: Tables) -> DataFrame:
    one = tweets(t)
    later = F.timestamp_seconds(F.unix_timestamp("created_at") + F.length("text") % 3)
    copies = one.withColumns({"created_at": later, "text": F.concat(F.lit("a copy of "), "text")})
    first = th.unique_tweets(one.unionByName(copies), "created_at", "text", "inbound")
    return first.select("tweet_id", seconds("created_at").alias("created_s"), "text", "inbound")


@query("a1_response_time_stats", PAIRS + """SELECT QUANTILE_CONT(response_seconds, 0.5) AS median_seconds,
  QUANTILE_CONT(response_seconds, 0.9) AS p90_seconds, MAX(response_seconds) AS max_seconds FROM pairs""")
def a1(t: Tables) -> DataFrame:
    return pf.response_time_stats(pairs(t))


@query("a2_response_time_histogram", PAIRS + """, lim AS (SELECT QUANTILE_CONT(response_seconds, 0.95) AS p FROM pairs),
clipped AS (SELECT LEAST(response_seconds, p) AS v FROM pairs, lim WHERE response_seconds IS NOT NULL),
ends AS (SELECT MIN(v) AS lo, MAX(v) AS hi FROM clipped),
binned AS (SELECT CASE WHEN lo < hi THEN LEAST(CAST(FLOOR(40 * (v - lo) / (hi - lo)) AS INT) + 1, 40) ELSE 1 END AS bin, lo, hi
  FROM clipped, ends)
SELECT bin, ROUND(lo + (bin - 1) * (hi - lo) / 40, 6) AS lower_edge, ROUND(lo + bin * (hi - lo) / 40, 6) AS upper_edge,
  COUNT(*) AS n FROM binned GROUP BY bin, lo, hi""")
def a2(t: Tables) -> DataFrame:
    bins = pf.clipped_histogram(pairs(t))
    return bins.withColumns({c: F.round(c, 6) for c in ("lower_edge", "upper_edge")})


@query("a3_length_stats", PAIRS + """SELECT 'customer' AS side, ROUND(AVG(LENGTH(customer_text)), 6) AS mean_len,
  QUANTILE_CONT(CAST(LENGTH(customer_text) AS DOUBLE), 0.5) AS median_len FROM pairs
UNION ALL SELECT 'brand', ROUND(AVG(LENGTH(brand_text)), 6), QUANTILE_CONT(CAST(LENGTH(brand_text) AS DOUBLE), 0.5) FROM pairs""")
def a3(t: Tables) -> DataFrame:
    return pf.length_stats(pairs(t)).withColumn("mean_len", F.round("mean_len", 6))


@query("a4_context_shares", PAIRS + """SELECT COUNT(*) AS pairs, ROUND(AVG(CAST(prior_context IS NOT NULL AS DOUBLE)), 6) AS with_prior,
  ROUND(AVG(CAST(followup_text IS NOT NULL AS DOUBLE)), 6) AS with_followup FROM pairs""")
def a4(t: Tables) -> DataFrame:
    return pf.context_shares(pairs(t)).withColumns({c: F.round(c, 6) for c in ("with_prior", "with_followup")})


def _rates(thanks: str, complaints: str) -> str:
    return f"""SELECT ROUND(AVG(CAST(REGEXP_MATCHES(LOWER(followup_text), '{thanks}') AS DOUBLE)), 6) AS thankful,
  ROUND(AVG(CAST(REGEXP_MATCHES(LOWER(followup_text), '{complaints}') AS DOUBLE)), 6) AS unresolved FROM pairs"""


def _rounded_rates(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("thankful", "unresolved")})


@query("a5_followup_rates", PAIRS + _rates("|".join(THANK_WORDS), "|".join(COMPLAINT_WORDS)))
def a5(t: Tables) -> DataFrame:
    return _rounded_rates(pf.followup_rates(pairs(t)))


@query("a5_keyword_rates_other_words", PAIRS + _rates("the|que|der", "tion|los"))
def a5_other(t: Tables) -> DataFrame:
    return _rounded_rates(pf.followup_rates(pairs(t), ("the", "que", "der"), ("tion", "los")))


_STOP = ", ".join(f"'{w}'" for w in sorted(PROFILE_STOP_WORDS))
_TOKENS = f"""LIST_FILTER(REGEXP_EXTRACT_ALL(LOWER(COALESCE({{0}}, '')), '[a-z'']+'),
  lambda x: LENGTH(x) > 2 AND x NOT IN ({_STOP}))"""


@query("m6_top_tokens", PAIRS + f"""SELECT token, COUNT(*) AS n FROM (
  SELECT UNNEST({_TOKENS.format('customer_text')}) AS token FROM pairs)
GROUP BY token ORDER BY n DESC, token LIMIT 25""")
def m6(t: Tables) -> DataFrame:
    return pf.top_tokens(pairs(t), "customer_text")


@query("m6_top_tokens_documents", f"""SELECT token, COUNT(*) AS n FROM (
  SELECT UNNEST({_TOKENS.format('text')}) AS token FROM documents)
GROUP BY token ORDER BY n DESC, token LIMIT 25""")
def m6_documents(t: Tables) -> DataFrame:
    return pf.top_tokens(t.documents, "text")


@query("f1_parse_posted_at", RAW_SQL + f"SELECT tweet_id, {_PARSED} AS posted FROM raw")
def f1(t: Tables) -> DataFrame:
    return raw_tweets(t).select(
        "tweet_id", F.unix_timestamp(sc.parse_posted_at(F.col("created_at"))).alias("posted")
    )


@query("f2_parse_inbound", RAW_SQL + """SELECT tweet_id, COALESCE(LOWER(inbound) IN ('true', '1'), FALSE) AS inbound FROM raw""")
def f2(t: Tables) -> DataFrame:
    return raw_tweets(t).select("tweet_id", sc.parse_inbound(F.col("inbound")).alias("inbound"))


@query("f5_first_listed_id", with_views("tweets") + """SELECT tweet_id, TRIM(SPLIT_PART(response_tweet_id, ',', 1)) AS first_id FROM tweets""")
def f5(t: Tables) -> DataFrame:
    return view(t, "tweets").select("tweet_id", sc.first_listed_id(F.col("response_tweet_id")).alias("first_id"))


@query("f6_response_seconds", RAW_SQL + f""", t AS ({_RAW_TYPED})
SELECT b.tweet_id, CAST(b.created_at - c.created_at AS DOUBLE) AS response_seconds
FROM t b JOIN t c ON b.in_response_to_tweet_id=c.tweet_id""")
def f6(t: Tables) -> DataFrame:
    typed = src.typed(raw_tweets(t))
    parents = typed.select(F.col("tweet_id").alias("in_response_to_tweet_id"), F.col("created_at").alias("asked_at"))
    spent = sc.seconds_between(F.col("asked_at"), F.col("created_at"))
    return typed.join(parents, "in_response_to_tweet_id").select("tweet_id", spent.alias("response_seconds"))


@query("f7_tokenize", f"""SELECT doc_id, CAST(LEN({_TOKENS.format('text')}) AS BIGINT) AS n_tokens,
  MD5(ARRAY_TO_STRING({_TOKENS.format('text')}, ' ')) AS digest FROM documents""")
def f7(t: Tables) -> DataFrame:
    words = t.documents.select("doc_id", profile_tokens(F.col("text")).alias("w"))
    return words.select(
        "doc_id", F.size("w").cast("bigint").alias("n_tokens"), F.md5(F.array_join("w", " ")).alias("digest")
    )


@query("s9_profile_report", PAIRS + """SELECT 'response_time' AS section, '' AS label, metric, ROUND(value, 6) AS value FROM (
  SELECT UNNEST(['median_seconds', 'p90_seconds', 'max_seconds']) AS metric,
    UNNEST([QUANTILE_CONT(response_seconds, 0.5), QUANTILE_CONT(response_seconds, 0.9), MAX(response_seconds)]) AS value FROM pairs)
UNION ALL SELECT 'length', side, metric, ROUND(value, 6) FROM (
  SELECT side, UNNEST(['mean_len', 'median_len']) AS metric, UNNEST([AVG(len), QUANTILE_CONT(len, 0.5)]) AS value FROM (
    SELECT 'customer' AS side, CAST(LENGTH(customer_text) AS DOUBLE) AS len FROM pairs
    UNION ALL SELECT 'brand', CAST(LENGTH(brand_text) AS DOUBLE) FROM pairs) GROUP BY side)
UNION ALL SELECT 'context', '', metric, ROUND(value, 6) FROM (
  SELECT UNNEST(['pairs', 'with_prior', 'with_followup']) AS metric,
    UNNEST([CAST(COUNT(*) AS DOUBLE), AVG(CAST(prior_context IS NOT NULL AS DOUBLE)), AVG(CAST(followup_text IS NOT NULL AS DOUBLE))]) AS value FROM pairs)
UNION ALL SELECT 'followup', '', metric, ROUND(value, 6) FROM (
  SELECT UNNEST(['thankful', 'unresolved']) AS metric,
    UNNEST([AVG(CAST(REGEXP_MATCHES(LOWER(followup_text), '""" + "|".join(THANK_WORDS) + """') AS DOUBLE)),
      AVG(CAST(REGEXP_MATCHES(LOWER(followup_text), '""" + "|".join(COMPLAINT_WORDS) + """') AS DOUBLE))]) AS value FROM pairs)""")
def s9_profile(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "pairs")
    io.write_pairs(pairs(t), path)
    return profile_report(io.read_parquet(t.spark, path)).withColumn("value", F.round("value", 6))
