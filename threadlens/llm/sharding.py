"""Proportional stratified interleaving of rows into shards, in DataFrame expressions only.

The rows of each source are shuffled by a seeded hash and numbered; a row's fractional rank is its number
(and a half) over the source's rows. All rows sorted by fractional rank are cut into shards of equal
counts, so each shard holds every source in its share of the whole. Both numberings are by range: a source
with a third of all rows is spread over many tasks. Only keys, sizes and hashes are sorted, not texts.

Null texts have size 1 and the checksum of the empty text. Null sources are a source. Repeated rows are
rows of their own. An empty table gives no rows. With fewer rows than shards some shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import global_positions, stored, unit_hash


def interleave(
    docs: DataFrame, shards: int = 8, *, seed: int = 11, key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """Key, ``size``, ``text_crc32``, ``shard`` and ``slot`` of each row; shard counts differ by one at most."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        unit_hash(seed, key).alias("shuffle"),
    )
    shuffled = ["source", "shuffle", "key", "text_crc32"]
    numbered = global_positions(rows, shuffled, "at")
    sources = stored(
        numbered.groupBy("source").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows")), "source-rows")
    of = sources.withColumnRenamed("source", "of")
    ranked = numbered.join(of, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "rank", (F.col("at") - F.col("first") + 0.5) / F.col("rows"))
    # equal ranks: the order of the first numbering, which is one of a kind
    placed = global_positions(ranked.select("key", "size", "text_crc32", "rank", "at"), ["rank", "at"], "position")
    n = placed.count()
    cut = placed.withColumn("shard", F.expr(f"position * {shards} div {max(n, 1)}"))
    begin = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return cut.select(
        F.col("key").alias(key), "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
        (F.col("position") - begin).alias("slot"),
    )
