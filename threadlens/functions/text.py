"""Tokens, word n-grams and per-row term counts, all as JVM expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.words import PROFILE_STOP_WORDS, PROFILE_TOKEN


def tokens(text: Column, pattern: str, stop: Iterable[str] = (), min_length: int = 1) -> Column:
    """Lower-case matches of ``pattern`` without stop words; null text gives no tokens."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))
    drop = sorted(set(stop))

    def keep(word: Column) -> Column:
        wanted = F.length(word) >= min_length
        return wanted & ~word.isin(drop) if drop else wanted

    return F.filter(found, keep) if drop or min_length > 1 else found


def profile_tokens(text: Column) -> Column:
    """Tokens of three or more letters for the token ranking."""
    return tokens(text, PROFILE_TOKEN, PROFILE_STOP_WORDS, min_length=3)


def word_pairs(words: Column) -> Column:
    """Neighbouring words joined by a blank; none for fewer than two words."""
    rest = F.size(words) - 1
    return F.when(
        rest > 0,
        F.zip_with(
            F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest),
            lambda word, following: F.concat(word, F.lit(" "), following),
        ),
    ).otherwise(F.array().cast("array<string>"))


def with_grams(
    df: DataFrame, text: str, out: str, pattern: str, stop: Iterable[str] = (), pairs: bool = True
) -> DataFrame:
    """Add the words and, if asked, the word pairs of a text as one array column."""
    df = df.withColumn(out, tokens(F.col(text), pattern, stop))
    if pairs:
        df = df.withColumn(out, F.concat(F.col(out), word_pairs(F.col(out))))
    return df


def with_marked_terms(df: DataFrame, grams: str, out: str) -> DataFrame:
    """Add structs (term, first) in order; ``first`` is 1 for the first of equal terms, else 0.

    Counting rows and adding up ``first`` by term gives occurrences and documents in one
    aggregation, with no shuffle by document.
    """
    ordered = F.col(out)  # a column of its own, so that the sort runs once
    before = F.concat(F.array(F.lit(None).cast("string")), ordered)
    marked = F.zip_with(
        ordered, before,
        lambda term, previous: F.struct(
            term.alias("term"), F.when(term.eqNullSafe(previous), 0).otherwise(1).alias("first")
        ),
    )
    # The shifted array is one longer.
    first = F.slice(marked, F.lit(1), F.size(ordered))
    return df.withColumn(out, F.sort_array(grams)).withColumn(out, first)
