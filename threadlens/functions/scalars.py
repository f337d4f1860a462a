"""Column expressions for ids, flags, dates and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Textual dates look like "Tue Oct 31 22:10:47 +0000 2017".
POSTED_AT_FORMAT = "MMM dd HH:mm:ss Z yyyy"
WEEKDAY_PREFIX = r"^(?i:mon|tue|wed|thu|fri|sat|sun) +(.+)$"


def parse_posted_at(value: Column) -> Column:
    """Timestamp of a textual date, null where it does not match.

    Spark cannot parse weekday names, so the name is checked by pattern and taken off.
    """
    return F.try_to_timestamp(F.regexp_extract(value, WEEKDAY_PREFIX, 1), F.lit(POSTED_AT_FORMAT))


def parse_inbound(value: Column) -> Column:
    """True for ``true`` or ``1`` in any case, false for all else and for null."""
    return F.coalesce(F.lower(value).isin("true", "1"), F.lit(False))


def strip_space(text: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def to_bool(value: Column) -> Column:
    """Tolerant boolean: null where the text is none of the known spellings."""
    text = F.lower(strip_space(value.cast("string")))
    return (
        F.when(text.isin("true", "1", "1.0"), F.lit(True))
        .when(text.isin("false", "0", "0.0"), F.lit(False))
    )


def normalize_id(value: Column) -> Column:
    """Id text without the ``.0`` a spreadsheet adds; null stays null."""
    return F.regexp_replace(value.cast("string"), r"\.0+$", "")


def first_listed_id(value: Column) -> Column:
    """First entry of a comma-separated id list."""
    return strip_space(F.split_part(value, F.lit(","), F.lit(1)))


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` as double, null if either is null."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)).cast("double")


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean of the non-null values of a row, null if all are null."""
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))
    filled = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
    return F.when(filled > 0, total / filled)


def score_bin(average: Column) -> Column:
    """Right-closed bins (0, 2], (2, 3.5] and (3.5, 5]; null outside of them."""
    return (
        F.when((average > 0) & (average <= 2), "low")
        .when((average > 2) & (average <= 3.5), "mid")
        .when((average > 3.5) & (average <= 5), "high")
    )


def seeded_order(seed: int, key: Column) -> Column:
    """Reproducible random order: md5 of the seed and the row key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
