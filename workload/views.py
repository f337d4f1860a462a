"""Views over the given tables that have the shape of the operators' inputs.

Each view is one SQL text that Spark and DuckDB both run. All rows and whole texts go in; the
conditions on ids only choose a value for a row, never which rows there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workload.registry import Tables

BRAND = "brand"
EPOCH = 1704067200  # 2024-01-01 UTC; created_s counts from here

TWEETS = """
SELECT CAST(conv_id*1000000000+turn AS STRING) AS tweet_id,
       CASE WHEN role='user' THEN CONCAT('cust', CAST(conv_id AS STRING)) ELSE 'brand' END AS author_id,
       role='user' AS inbound,
       conv_id*3600 + turn*600 + LENGTH(text)%600 AS created_s,
       text,
       CASE WHEN role<>'user' AND LENGTH(text)%5=0 THEN NULL
            WHEN conv_id%5=0 THEN CONCAT(CAST(conv_id*1000000000+turn+1 AS STRING), ',', CAST(conv_id*1000000000+turn+3 AS STRING))
            ELSE CAST(conv_id*1000000000+turn+1 AS STRING) END AS response_tweet_id,
       CASE WHEN turn=0 THEN NULL
            WHEN role='assistant' AND conv_id%7=0 AND turn<=2 THEN '999999999'
            WHEN role='assistant' AND conv_id%11=0 AND turn>=3 THEN CAST(conv_id*1000000000+turn-2 AS STRING)
            WHEN role='user' AND conv_id%3=0 AND turn>=2 THEN CAST(conv_id*1000000000+turn-2 AS STRING)
            ELSE CAST(conv_id*1000000000+turn-1 AS STRING) END AS in_response_to_tweet_id
FROM {conversations}
"""

LABELED_DOCS = """
SELECT CAST(doc_id AS STRING) AS customer_tweet_id, text AS customer_text, lang AS intent,
  CASE WHEN doc_id%13=0 THEN NULL WHEN doc_id%17=0 THEN '' ELSE CONCAT('reply ', CAST(doc_id AS STRING)) END AS brand_text,
  CASE WHEN doc_id%3=0 THEN CONCAT('earlier ', lang) END AS prior_context,
  CASE WHEN doc_id%4=0 THEN CONCAT('later ', lang) END AS followup_text
FROM {documents}
"""

GOLDEN = """
SELECT CONCAT(CAST(l.doc_id AS STRING), CASE WHEN l.doc_id%4=0 THEN '.0' ELSE '' END) AS customer_tweet_id,
  d.text AS customer_text,
  CASE WHEN l.doc_id%3=0 THEN CONCAT('earlier ', d.lang) END AS prior_context,
  CASE WHEN l.doc_id%19=0 THEN NULL WHEN l.doc_id%10=0 THEN 'other' ELSE d.lang END AS gold_intent,
  CASE WHEN l.doc_id%7=0 THEN 'other' WHEN l.doc_id%6=0 THEN 'en' ELSE d.lang END AS pred,
  CASE WHEN l.doc_id%23=0 THEN 'maybe' WHEN l.doc_id%2=0 THEN CASE WHEN l.quality=0 THEN ' True ' ELSE 'FALSE' END
       ELSE CASE WHEN l.quality=0 THEN '1.0' ELSE '0' END END AS gold_escalate,
  CASE WHEN l.doc_id%29=0 THEN NULL WHEN l.toxic=1 THEN 'true' ELSE 'false' END AS escalate,
  CONCAT('reason ', d.source) AS escalate_reason
FROM {labels} l JOIN {documents} d ON l.doc_id=d.doc_id
"""

RATINGS = """
SELECT doc_id AS example_id, CAST(1+n_chars%5 AS INT) AS correctness,
  CAST(CASE WHEN doc_id%15=0 THEN NULL ELSE 1+(n_chars+doc_id)%5 END AS INT) AS tone,
  CAST(1+doc_id%5 AS INT) AS actionability,
  CAST(CASE WHEN doc_id%9=0 THEN NULL ELSE 1+(n_chars+doc_id%2)%5 END AS INT) AS human_correctness,
  CAST(1+(n_chars+doc_id)%4 AS INT) AS human_tone, CAST(1+(doc_id*7)%5 AS INT) AS human_actionability,
  text AS customer_text,
  CASE WHEN doc_id%8=0 THEN NULL WHEN doc_id%8=1 THEN '' ELSE CONCAT('reply to ', source) END AS reply
FROM {documents}
"""

RESPONSES = """
SELECT doc_id AS example_id, CASE doc_id%12
  WHEN 0 THEN CONCAT('```json', CHR(10), '{{"reply":"', lang, '","escalate":true}}', CHR(10), '```')
  WHEN 1 THEN CONCAT('{{"reply":"ok","escalate":false,"escalate_reason":"', source, '"}}')
  WHEN 2 THEN 'sorry, no' WHEN 3 THEN '' WHEN 4 THEN CONCAT(' I think it is ', UPPER(lang), '. ')
  WHEN 5 THEN CONCAT('{{"correctness":', CAST(1+n_chars%5 AS STRING), ',"tone":4,"actionability":2,"rationale":"', lang, '"}}')
  WHEN 6 THEN CONCAT('{{"reply":"', lang, '","escalate":false}} Hope that helps!')
  WHEN 7 THEN CONCAT('{{''reply'':''', lang, ''',''escalate'':false}}')
  WHEN 8 THEN CONCAT('```json', CHR(10), '{{"reply":"r","escalate":false}}', CHR(10), '```', CHR(10), 'Let me know')
  WHEN 9 THEN CONCAT('{{"correctness":4.0,"tone":', CAST(1+n_chars%4 AS STRING), '.5,"actionability":3,"rationale":"', lang, '"}}')
  WHEN 10 THEN '{{"reply":"r","escalate":false'
  ELSE 'Battery Drain' END AS raw,
  CASE WHEN doc_id%11=0 THEN NULL WHEN doc_id%11=1 THEN '' ELSE CONCAT('reply to ', source) END AS reply
FROM {documents}
"""

TAXONOMY = """
SELECT label AS cluster_id, CAST(COUNT(*) AS INT) AS cluster_size,
  CONCAT('terms of ', CAST(label AS STRING)) AS top_terms,
  CASE WHEN label%3=0 THEN 'battery_drain' WHEN label%3=1 THEN 'screen_issue' ELSE 'update_bug' END AS intent,
  label NOT IN (6, 8) AS include_in_training,
  CONCAT('note "', CAST(label AS STRING), '", checked') AS notes
FROM {embeddings}
GROUP BY label
HAVING label <> 9
"""

CLUSTERED = "SELECT vec_id, label AS cluster_id FROM {embeddings}"

HAND_LABELS = """
SELECT CAST(doc_id AS STRING) AS example_id, CASE WHEN quality=0 THEN 'other' ELSE 'known' END AS gold_intent,
  CASE WHEN toxic=1 THEN 'True' ELSE 'False' END AS gold_escalate,
  CONCAT('reason ', CAST(quality AS STRING)) AS escalate_reason, '' AS labeler_notes
FROM {labels}
"""

SHEET = """
SELECT CAST(doc_id AS STRING) AS example_id, text AS customer_text, lang AS suggested_intent,
  '' AS gold_intent, '' AS gold_escalate, '' AS escalate_reason, '' AS labeler_notes
FROM {documents}
"""

_VIEWS = {
    "tweets": (TWEETS, ("conversations",)),
    "labeled_docs": (LABELED_DOCS, ("documents",)),
    "golden": (GOLDEN, ("labels", "documents")),
    "ratings": (RATINGS, ("documents",)),
    "responses": (RESPONSES, ("documents",)),
    "taxonomy": (TAXONOMY, ("embeddings",)),
    "clustered": (CLUSTERED, ("embeddings",)),
    "hand_labels": (HAND_LABELS, ("labels",)),
    "sheet": (SHEET, ("documents",)),
}

# What the thread operators should give for TWEETS, in SQL.
_DERIVED = {
    "pairs": """
SELECT c.tweet_id AS customer_tweet_id, c.text AS customer_text, c.created_s AS customer_created_s,
  p.text AS prior_context, b.tweet_id AS brand_tweet_id, b.text AS brand_text, b.created_s AS brand_created_s,
  CAST(b.created_s - c.created_s AS DOUBLE) AS response_seconds, f.text AS followup_text
FROM tweets b
JOIN tweets c ON b.in_response_to_tweet_id=c.tweet_id AND c.inbound
LEFT JOIN tweets p ON c.in_response_to_tweet_id=p.tweet_id AND p.inbound
LEFT JOIN tweets f ON TRIM(SPLIT_PART(b.response_tweet_id, ',', 1))=f.tweet_id AND f.inbound
WHERE NOT b.inbound AND b.author_id='brand'
""",
}


def view(tables: Tables, name: str) -> DataFrame:
    """A view as a Spark table."""
    sql, sources = _VIEWS[name]
    return tables.spark.sql(sql, **{s: getattr(tables, s) for s in sources})


def with_views(*names: str) -> str:
    """The same views as the WITH clause of a DuckDB query."""
    parts = []
    for name in names:
        if name in _DERIVED:
            sql = _DERIVED[name]
        else:
            text, sources = _VIEWS[name]
            sql = text.format(**{s: s for s in sources})
        parts.append(f"{name} AS ({sql})")
    return "WITH " + ",\n".join(parts) + "\n"


def tweets(tables: Tables) -> DataFrame:
    """The message table as the thread operators take it, with timestamps."""
    dated = F.timestamp_seconds(F.col("created_s") + EPOCH)
    return view(tables, "tweets").withColumn("created_at", dated).drop("created_s")


def seconds(column: str):
    """Seconds since ``EPOCH`` of a timestamp."""
    return F.unix_timestamp(column) - F.lit(EPOCH)
