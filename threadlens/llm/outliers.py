"""Quality rules: text statistics, and robust multivariate outliers per language and source.

Statistics of each whole text are transformed to a vector: shrunken mean word length, and square roots of the rates
of symbols, repeated lines and repeated words. For each (language, source) the minimum covariance determinant
estimate of centre and scatter comes from concentration steps: the rows nearest to the last centre, by the last
scatter, give the next. Vectors too far by Mahalanobis distance are rejected.

All rows take part: a step is one aggregation of counts, sums and products per group with partial sums before
the shuffle, and the distance that holds the nearest ``share`` of a group comes from a mergeable quantile summary.
So a group with a third of all rows is no burden. Estimates are one row per group. A group's estimate is blended
with that of all rows with the weight of ``prior`` rows, and each scatter gets a floor, so that small groups and
statistics that hardly vary have a distance as well.

Null texts have no words and fail the base rule. Null languages and sources are groups. Repeated rows count as often
as they come. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import per_text, stored

SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
STATISTICS = {c: "bigint" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
VECTOR = ("x0", "x1", "x2", "x3")
#: Standard deviations that a statistic is taken to have at least: a letter's fifth in mean word length, a symbol
#: in 200 words, a repeated line in 100 lines' worth of words, 2 repeated words in 100.
FLOORS = (0.2, 0.07, 0.1, 0.15)


def repeated_words(ids: np.ndarray, size: int = 5) -> int:
    """Words in windows of ``size`` words that the text has twice or more."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    code = ids[:n].astype(np.int64)
    for i in range(1, size):  # exact numbers for windows of 2, 3 … words
        _, code = np.unique(code * (len(ids) + 1) + ids[i:i + n], return_inverse=True)
    again = np.bincount(code)[code] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:n] += again
    edge[size:] -= again
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics_of(text: bytes) -> tuple[int, int, int, int, int]:
    """The STATISTICS of a UTF-8 text."""
    words = text.split()  # bytes are split at the six ASCII white-space characters
    chars = len(text.decode()) - sum(text.count(s.encode()) for s in SPACES)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.split()] if b"\n" in text else []
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    repeats = repeated_words(ids) if len(numbers) < len(words) else 0
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats


def text_statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns and the STATISTICS of each row's whole text."""

    def make() -> Callable[[list[bytes]], list[list[int]]]:
        def work(texts: list[bytes]) -> list[list[int]]:
            rows = [statistics_of(t) for t in texts]
            return [list(c) for c in zip(*rows)] if rows else [[] for _ in STATISTICS]

        return work

    return per_text(docs, keep, text, STATISTICS, make, binary=True)


def vector() -> list[Column]:
    """The transformed statistics; ratios are shrunk so that short texts do not stray by chance."""
    n = F.col("n_words").cast("double")
    return [
        ((F.col("word_chars") + 150.0) / (n + 30.0)).alias("x0"),
        F.sqrt(F.col("n_symbols") / (n + 10.0)).alias("x1"),
        F.sqrt(10.0 * F.col("n_dup_lines") / (n + 100.0)).alias("x2"),
        F.sqrt(F.col("n_repeat_words") / (n + 30.0)).alias("x3"),
    ]


def _moments(weight: Column) -> list[Column]:
    """Count, sums and products of the rows that the condition picks."""
    pairs = [(a, b) for i, a in enumerate(VECTOR) for b in VECTOR[i:]]
    return [
        F.sum(weight.cast("bigint")).alias("n"),
        *[F.sum(F.when(weight, F.col(a))).alias(f"s_{a}") for a in VECTOR],
        *[F.sum(F.when(weight, F.col(a) * F.col(b))).alias(f"p_{a}_{b}") for a, b in pairs],
    ]


def estimate(n: float, sums: np.ndarray, products: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Centre and scatter from moments; scale makes a truncated scatter consistent."""
    centre = sums / n
    scatter = (products / n - np.outer(centre, centre)) * scale
    return centre, scatter


def _square(values: np.ndarray) -> np.ndarray:
    k = len(VECTOR)
    out = np.zeros((k, k))
    out[np.triu_indices(k)] = values
    return out + out.T - np.diag(np.diag(out))


def _gamma_half(k: int, x: float) -> float:
    """Regularised lower incomplete gamma function at half-integer or integer k/2, by its series."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    for i in range(1, 500):
        term *= z / (a + i)
        total += term
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a)) if z > 0 else 0.0


def chi_square_quantile(p: float, k: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _gamma_half(k, middle) < p else (low, middle)
    return (low + high) / 2


def consistency(share: float, k: int) -> float:
    """What the scatter of the nearest ``share`` of normal rows must be multiplied with."""
    return 1.0 if share >= 1 else share / _gamma_half(k + 2, chi_square_quantile(share, k))


def _solve(moments: DataFrame, groups: list[str], pooled: np.ndarray, prior: float, scale: float) -> DataFrame:
    """Per group the centre and the inverse scatter, from its moments blended with those of all rows."""
    k = len(VECTOR)
    names = ["n", *(f"s_{a}" for a in VECTOR), *(f"p_{a}_{b}" for i, a in enumerate(VECTOR) for b in VECTOR[i:])]
    made = [*(f"m{i}" for i in range(k)), *(f"w{i}{j}" for i in range(k) for j in range(i, k))]
    schema = ", ".join([*(f"`{g}` {t}" for g, t in moments.select(*groups).dtypes), *(f"{n} double" for n in made)])
    floor = np.diag(np.square(FLOORS))
    all_centre, all_scatter = estimate(pooled[0], pooled[1:1 + k], _square(pooled[1 + k:]), scale) if pooled[0] else (
        np.zeros(k), np.zeros((k, k)))

    def run(tables: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            values = table[names].fillna(0).to_numpy(float)
            rows = np.zeros((len(table), len(made)))
            for i, v in enumerate(values):
                n = v[0]
                centre, scatter = estimate(n, v[1:1 + k], _square(v[1 + k:]), scale) if n else (all_centre, all_scatter)
                own = n / (n + prior)
                centre = own * centre + (1 - own) * all_centre
                scatter = own * scatter + (1 - own) * all_scatter + floor
                rows[i] = np.concatenate([centre, np.linalg.inv(scatter)[np.triu_indices(k)]])
            yield pd.concat([table[groups].reset_index(drop=True), pd.DataFrame(rows, columns=made)], axis=1)

    return stored(moments.mapInPandas(run, schema), "estimates")


def distance() -> Column:
    """Squared Mahalanobis distance from the estimates beside the vector."""
    k = len(VECTOR)
    d = [F.col(VECTOR[i]) - F.col(f"m{i}") for i in range(k)]
    total = F.lit(0.0)
    for i in range(k):
        for j in range(i, k):
            total = total + d[i] * d[j] * F.col(f"w{i}{j}") * (1.0 if i == j else 2.0)
    return total


def _with(vectors: DataFrame, table: DataFrame, groups: list[str]) -> DataFrame:
    """Each row beside its group's row of a stored table (many rows to one, which Spark can split)."""
    renamed = table.select(*[F.col(g).alias(f"of_{g}") for g in groups], *[c for c in table.columns if c not in groups])
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"of_{g}"))
    return vectors.join(renamed, same).drop(*[f"of_{g}" for g in groups])


def minimum_covariance(
    vectors: DataFrame, groups: list[str], *, share: float = 0.75, steps: int = 3, prior: float = 50.0,
) -> DataFrame:
    """Estimates per group: the first from the medians, then ``steps`` concentration steps over all rows."""
    k = len(VECTOR)
    middle = vectors.groupBy(*groups).agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"m{i}") for i, x in enumerate(VECTOR)])
    start = [
        F.lit((1 / FLOORS[i] ** 2) if i == j else 0.0).alias(f"w{i}{j}") for i in range(k) for j in range(i, k)
    ]
    found = stored(middle.select(*groups, *[f"m{i}" for i in range(k)], *start), "estimates")
    for _ in range(steps):
        near = _with(vectors, found, groups).withColumn("d2", distance()).select(*groups, *VECTOR, "d2")
        limit = stored(near.groupBy(*groups).agg(F.percentile_approx("d2", share, 1000).alias("limit")), "limits")
        moments = stored(
            _with(near, limit, groups).groupBy(*groups).agg(*_moments(F.col("d2") <= F.col("limit"))), "moments")
        pooled = moments.agg(*[F.sum(c) for c in moments.columns if c not in groups]).first()
        found = _solve(moments, groups, np.array([v or 0.0 for v in pooled], float), prior, consistency(share, k))
    return found


def judge(
    docs: DataFrame, *, groups: tuple[str, ...] = ("lang", "source"), reject: float = 1e-5, key: str = "doc_id",
    text: str = "text", share: float = 0.75, steps: int = 3, prior: float = 50.0,
) -> DataFrame:
    """Each row's key, STATISTICS, ``base_failed``, squared ``distance`` and ``kept``.

    ``reject`` is the share of normal rows that the distance's bound would reject. Rows that fail the base rule
    are not kept and do not take part in the estimates.
    """
    names = [f"_group{i}" for i in range(len(groups))]
    rows = docs.select(F.col(key).alias("_key"), *[F.col(g).alias(n) for g, n in zip(groups, names)], F.col(text).alias("_body"))
    counted = text_statistics(rows, ("_key", *names), "_body")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counted = stored(counted.withColumn("base_failed", failed).select("*", *vector()), "statistics")
    good = counted.filter(~F.col("base_failed")).select(*names, *VECTOR)
    found = minimum_covariance(good, names, share=share, steps=steps, prior=prior)
    bound = chi_square_quantile(1 - reject, len(VECTOR))
    # groups in which every row failed have no estimates
    renamed = found.select(*[F.col(n).alias(f"of{n}") for n in names], *[c for c in found.columns if c not in names])
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"of{n}"))
    judged = counted.join(renamed, same, "left").withColumn("distance", distance())
    return judged.select(
        F.col("_key").alias(key), *STATISTICS, "base_failed", "distance",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= bound)).alias("kept"),
    )
