"""Reading raw message tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.functions.scalars import parse_inbound, parse_posted_at
from threadlens.sources.quoted_csv import QUOTED, read_quoted_csv

RAW_COLUMNS = (
    "tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id", "in_response_to_tweet_id",
)
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])


def read_raw(spark: SparkSession, path: str, quoted_newlines: bool = True) -> DataFrame:
    """Raw CSV, all columns as text; large files are split.

    Where no text has a line break, ``quoted_newlines`` = False saves a pass over the files.
    """
    if quoted_newlines:
        return read_quoted_csv(spark, path, RAW_SCHEMA)
    return spark.read.schema(RAW_SCHEMA).options(**QUOTED, header=True).csv(path)


def typed(raw: DataFrame) -> DataFrame:
    """Tolerant flags and UTC timestamps instead of text; a date that does not match is null."""
    return raw.withColumns({
        "inbound": parse_inbound(F.col("inbound")),
        "created_at": parse_posted_at(F.col("created_at")),
    })


def load_tweets(spark: SparkSession, path: str, quoted_newlines: bool = True) -> DataFrame:
    """Raw CSV as a typed table."""
    return typed(read_raw(spark, path, quoted_newlines))


def undated_counts(raw: DataFrame) -> DataFrame:
    """Rows without a timestamp: dates that do not match, and missing ones (one row)."""
    text = F.col("created_at")
    parsed = parse_posted_at(text)
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(parsed.isNull()).alias("undated"),
        F.count_if(text.isNotNull() & parsed.isNull()).alias("unparsed"),
        F.count_if(text.isNull()).alias("missing"),
    )
