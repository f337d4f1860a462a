"""Exact ranks, quantiles and numbering without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threadlens.session import cut_lineage

GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
PRE_SPLITS = 256


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value (and group), column ``n``; null values are left out."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias(value))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def in_ranges(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, GroupedData]:
    """The rows in ranges of the order, with ``_range`` and ``_at`` (their place in it), stored; and the ranges.

    Spark draws the borders from a sample of the rows, so ranges have about the same number of rows whatever the
    values are. There are no more ranges than partitions of one shuffle: a table of them may always be broadcast.
    """
    number = F.monotonically_increasing_id()  # the partition in the high bits, the row's place in the low 33
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_number", number))
    low = F.lit((1 << 33) - 1)
    rows = placed.withColumns({"_range": F.shiftright("_number", 33), "_at": F.col("_number").bitwiseAND(low)}).drop("_number")
    return rows, rows.groupBy("_range")


def _offsets(totals: DataFrame, total: str, out: str) -> DataFrame:
    """The sum of all earlier ranges' totals."""
    before = F.sum(total).over(W.orderBy("_range")) - F.col(total)  # a row per range
    return F.broadcast(totals.select("_range", before.alias(out)))


def running_counts(counts: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Add ``before`` (rows with a smaller value) and ``total`` to value counts.

    The distinct values are dealt to ranges; the running sum inside a range is a window over its values alone.
    Groups without a name (null) are left out.
    """
    named = counts.dropna(subset=list(by)) if by else counts
    rows, ranges = in_ranges(named, [*by, value])
    inside = F.sum("n").over(W.partitionBy("_range").orderBy("_at")) - F.col("n")
    running = rows.join(_offsets(ranges.agg(F.sum("n").alias("_rows")), "_rows", "_offset"), "_range").withColumn(
        "_running", F.col("_offset") + inside)
    if not by:
        total = rows.agg(F.sum("n")).scalar()
        return running.withColumn("before", F.col("_running")).withColumn("total", total).drop("_range", "_at", "_offset", "_running")
    groups = running.groupBy(*by).agg(F.min("_running").alias("_first"), F.sum("n").alias("total"))
    return (
        running.join(groups, list(by)).withColumn("before", F.col("_running") - F.col("_first"))
        .drop("_range", "_at", "_offset", "_running", "_first")
    )


def count_quantiles(
    counts: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Interpolated quantiles and the mean from value counts, one row per group."""
    ranked = running_counts(counts, value, by)

    def at(position: Column) -> Column:
        return F.max(F.when(F.col("before") <= position, F.col(value)))

    parts = [(F.sum(F.col(value) * F.col("n")) / F.sum("n")).alias("mean")]
    for name, p in probabilities.items():
        position = (F.col("total") - 1) * F.lit(float(p))
        parts += [
            at(F.floor(position)).alias(f"_lo_{name}"),
            at(F.ceil(position)).alias(f"_hi_{name}"),
            F.max(position - F.floor(position)).alias(f"_part_{name}"),
        ]
    found = ranked.groupBy(*by).agg(*parts)
    return found.select(*by, "mean", *[
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}")).alias(n)
        for n in probabilities
    ])


def quantiles(df: DataFrame, value: str, probabilities: dict[str, float]) -> DataFrame:
    """Interpolated quantiles of the non-null values, one row with one column per name.

    The counts are read twice, so they are stored rather than computed again.
    """
    return count_quantiles(cut_lineage(value_counts(df, value)), value, probabilities).drop("mean")


def top_n_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "_rank"
) -> DataFrame:
    """First ``n`` rows of each group, with their position in ``rank``.

    Spark cuts each map task's rows to ``n`` per group before the shuffle as long as ``n`` is
    within its group-limit threshold. Beyond it the groups are cut in hashed parts first.
    """
    threshold = int(df.sparkSession.conf.get(GROUP_LIMIT_CONF, "1000"))
    if n > threshold:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(PRE_SPLITS))
        pre = W.partitionBy(*by, "_part").orderBy(*order)
        df = (
            df.withColumn("_part", part)
            .withColumn("_pre", F.row_number().over(pre))
            .filter(F.col("_pre") <= n)
            .drop("_part", "_pre")
        )
    final = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(final)).filter(F.col(rank) <= n)


def number_by_hash(df: DataFrame, digest: str, tie: str, out: str) -> DataFrame:
    """Consecutive numbers from 0 in the order of a digest column, then of ``tie``.

    A row's number is the number of rows in all earlier ranges plus its place in its own.
    """
    rows, ranges = in_ranges(df, [digest, tie])
    offsets = _offsets(ranges.agg(F.count(F.lit(1)).alias("_rows")), "_rows", "_before")
    return rows.join(offsets, "_range").withColumn(out, (F.col("_before") + F.col("_at")).cast("bigint")).drop("_range", "_at", "_before")
