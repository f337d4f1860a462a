"""Documents to token files in five stages: each is stored as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm import decontaminate, mixing, simhash, token_files, toxicity
from threadlens.llm.common import short_batches, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7; the model learns from the documents that came in."""
    short_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    usable = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels, usable), reject=0.7)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each component of fingerprints that differ in at most two bits."""
    short_batches(spark)
    return simhash.drop_near_duplicates(docs, words=3, radius=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten benchmark words."""
    short_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark, size=10)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources come near their targets; ids repeat with them."""
    return mixing.repeat_documents(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in seekable files; the rows are read back from the files."""
    short_batches(spark)
    return token_files.token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, units_kept=200_000)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing_sources", mixing_stage),
    ("token_files", token_stage),
]

#: The toxicity model, the fingerprints and the token ids are not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return last(spark, docs, sf_dir)
