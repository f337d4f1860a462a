"""Helpers shared by the text operators: per-text Arrow stages, stored tables, native global ranks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.session import scratch_path

SLICE_ROWS = 250
ARROW_TYPES = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def free_name(table: DataFrame, stem: str) -> str:
    """A column name that the table does not have (Spark compares names without case)."""
    taken = {c.lower() for c in table.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def stored(table: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: later reads do not repeat its work."""
    spark = table.sparkSession
    path = scratch_path(spark, name)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


_held: list = [None, None, None]


def held(kind: str, mark: object, make: Callable[[], object]) -> object:
    """A table that a worker process keeps between tasks; it keeps one at a time and drops the one before."""
    same = _held[1] is mark or (isinstance(mark, str) and isinstance(_held[1], str) and _held[1] == mark)
    if _held[0] != kind or not same:
        release()
        _held[:] = [kind, mark, make()]
    return _held[2]


def release() -> None:
    """Drop the table that the worker process keeps, for work that needs none, and hand back unused Arrow memory."""
    _held[:] = [None, None, None]
    pa.default_memory_pool().release_unused()


def short_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Let Spark send texts to Python in batches of so few rows: executors hold several whole batches at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, so that what is made from texts at a time stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def per_text(
    table: DataFrame, keep: Sequence[str], text: str, fields: dict[str, str],
    make: Callable[[], Callable[[list], Sequence[Sequence]]], *, binary: bool = False,
) -> DataFrame:
    """The ``keep`` columns and what ``make()``'s function returns for each batch of whole texts.

    ``make`` runs once in each task. Its function gets a list of texts (UTF-8 bytes if ``binary``;
    null is the empty text) and returns one list per entry of ``fields`` (name to Spark type). Spark
    cuts the batches at spark.sql.execution.arrow.maxBytesPerBatch, so long texts come in small ones.
    """
    name = free_name(table, "_text")
    value = F.coalesce(F.col(text), F.lit(""))
    narrow = table.select(*keep, (value.cast("binary") if binary else value).alias(name))
    kept = [narrow.schema[c] for c in keep]
    schema = T.StructType(kept + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items()])
    types = [ARROW_TYPES[t] for t in fields.values()]
    names, width = schema.names, len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in slices(batches):
            found = work(batch.column(width).to_pylist())
            made = [pa.array(values, type=t) for values, t in zip(found, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(width)] + made, names=names)

    return narrow.mapInArrow(run, schema)


def text_column(text: str, kind: str, make: Callable[[], Callable[[list], Sequence]], *, binary: bool = False) -> Column:
    """A column made from whole texts as in ``per_text``; only the text goes to Python, the row stays."""

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        work = make()
        for batch in batches:
            made: list = []
            for start in range(0, len(batch), SLICE_ROWS):
                made.extend(work(batch.iloc[start:start + SLICE_ROWS].tolist()))
            yield pd.Series(made)

    value = F.coalesce(F.col(text), F.lit(""))
    return run(value.cast("binary") if binary else value)


def row_mark(table: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits of hash of the columns' values, nulls told apart from values."""
    values = [F.col(c) if t != "void" else F.lit(None).cast("string") for c, t in table.dtypes if c in columns]
    nulls = [F.col(c).isNull() for c in columns]
    return F.concat(*[F.hex(F.xxhash64(F.lit(seed), *values, *nulls)) for seed in (1, 2)])


def unit_hash(seed: int, *columns: str) -> Column:
    """A number in [0, 1) from the md5 of the seed and the columns, the same in every run and engine."""
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(2**52))


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def global_positions(table: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Stored rows with their position (from 0) in the order of the columns, without one task for all.

    Rows are range-partitioned and sorted; each gets its partition's number and its place in it.
    The only small table is one row per partition, whose running sum gives the offsets.
    """
    placed = stored(
        table.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "positions",
    )
    part = F.shiftright(F.col("_place"), 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # a row per partition of one shuffle
        .withColumn(out, F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_before", "_place")
    )
