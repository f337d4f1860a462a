"""Runs that continue where an earlier one has stopped.

Output is kept in parts by a hash of the id, ``_part=0`` and so on; their number is written down with the first rows.
A run deals its rows to the same parts once, reads each part's finished ids once and no others, and notes
a part in the manifest when its rows are written. A run that is started again after a stop skips the parts that the
stopped one has noted, and of the part it was in does what is not in the output yet.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.session import scratch_path

Work = Callable[[DataFrame], DataFrame]

PARTS = 16
MANIFEST = "_manifest"  # Spark's readers pass over names that begin so
_NOTES = "run string, part int, parts int"


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A table, or nothing if there is none yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def output(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the output so far, or nothing if there are none."""
    found = _read(spark, path)
    return None if found is None else found.drop("_part")


def finished(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """Ids in the output so far, or nothing if there is no output yet."""
    found = output(spark, path)
    return None if found is None else found.select(key)


def pending(rows: DataFrame, done: DataFrame | None, key: str) -> DataFrame:
    """Rows whose id is not in the output yet; ids are compared as text, and no id is an id as well."""
    if done is None:
        return rows
    seen = done.select(F.col(key).cast("string").alias("_done"))
    return rows.join(seen, F.col(key).cast("string").eqNullSafe(F.col("_done")), "left_anti")


def once(rows: DataFrame, key: str) -> DataFrame:
    """One row per id, so that a repeated id is worked on once: the first in the order of all columns but maps."""
    ordered = [c for c, kind in rows.dtypes if "map<" not in kind]
    first = F.row_number().over(W.partitionBy(key).orderBy(*ordered))
    return rows.withColumn("_nth", first).filter("_nth = 1").drop("_nth")


def part_of(key: str, parts: int) -> F.Column:
    """The part of an id."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)).cast("int")


def _parts(spark: SparkSession, path: str, wanted: int) -> int:
    """In how many parts the output is kept; the first run decides."""
    notes = _read(spark, f"{path}/{MANIFEST}", _NOTES)
    known = None if notes is None else notes.agg(F.max("parts")).first()[0]
    return known or wanted


def append_new(
    rows: DataFrame, path: str, key: str, work: Work, restart: bool = False, commits: int = PARTS, run: str | None = None,
) -> None:
    """Do the work for new rows and append the results; ``restart`` drops earlier output.

    ``commits`` is the number of parts of a new output: each is written before the next one begins. ``run``
    names a run over the same rows: started again under its name, it skips the parts that it has finished. A name is
    not used for other rows.
    """
    spark = rows.sparkSession
    name = run or uuid.uuid4().hex
    parts = commits if restart else _parts(spark, path, commits)
    notes = None if restart or run is None else _read(spark, f"{path}/{MANIFEST}", _NOTES)
    noted = set() if notes is None else {r["part"] for r in notes.filter(F.col("run") == run).collect()}
    dealt = rows
    if parts > 1:
        staged = scratch_path(spark, "dealt")
        spread = rows.withColumn("_part", part_of(key, parts))
        # By id too: a part's rows come from many tasks, however few the parts are.
        spread.repartition("_part", key).write.partitionBy("_part").parquet(staged)
        dealt = spark.read.schema(spread.schema).parquet(staged)
    for number in range(parts):
        if number in noted:
            continue
        todo = dealt.filter(F.col("_part") == number).drop("_part") if parts > 1 else dealt
        fresh = restart and number == 0  # drops all parts
        done = None if restart else finished(spark, f"{path}/_part={number}", key)
        made = work(once(pending(todo, done, key), key)).withColumn("_part", F.lit(number))
        made.write.mode("overwrite" if fresh else "append").partitionBy("_part").parquet(path)
        spark.createDataFrame([(name, number, parts)], _NOTES).coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")


def append_stream(
    spark: SparkSession, source: str, schema: T.StructType | str, path: str, key: str, work: Work,
    checkpoint: str, files_per_batch: int = 1000,
) -> None:
    """The same for a folder that receives files: handle all files not seen before, then stop.

    The checkpoint remembers the files, and the state kept with it the ids, so earlier output is not read again. A
    batch has a folder of its own, which a repeated batch overwrites. Rows of one id in one batch: any of them. For
    very many ids let the session keep state in RocksDB (spark.sql.streaming.stateStore.providerClass).
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{path}/_part={number}")

    query = (
        stream.dropDuplicates([key]).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
