"""Reading and writing the tables that stages hand to each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.operators.labels import split_excluded
from threadlens.sources.quoted_csv import read_quoted_csv

CSV_TEXT = {
    "header": True, "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
TIMESTAMP = "yyyy-MM-dd HH:mm:ssXXX"


def write_pairs(pairs: DataFrame, parquet: str, csv: str | None = None) -> None:
    """Write Parquet and, if asked, the same rows as CSV (from the Parquet, not computed again)."""
    pairs.write.mode("overwrite").parquet(parquet)
    if csv:
        written = pairs.sparkSession.read.parquet(parquet)
        written.write.mode("overwrite").options(**CSV_TEXT, timestampFormat=TIMESTAMP).csv(csv)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table."""
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, quoted_newlines: bool = True) -> DataFrame:
    """A CSV table of a known schema with doubled quotes and, unless told otherwise, line breaks inside quotes."""
    if quoted_newlines:
        return read_quoted_csv(spark, path, schema, timestampFormat=TIMESTAMP)
    return spark.read.schema(schema).options(**CSV_TEXT, timestampFormat=TIMESTAMP).csv(path)


def write_split(assigned: DataFrame, path: str) -> None:
    """Write labeled and excluded rows in one pass, as partitions of one table."""
    assigned.write.mode("overwrite").partitionBy("is_excluded").parquet(path)


def read_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Labeled and excluded rows of a split table; each reads its own partition only."""
    # Spark reads the partition value as text.
    written = spark.read.parquet(path)
    return split_excluded(written.withColumn("is_excluded", F.col("is_excluded").cast("boolean")))
