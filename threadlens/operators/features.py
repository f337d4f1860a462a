"""Vocabulary and TF-IDF with a smooth idf, on Spark ML's sparse vectors."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.functions.text import tokens, with_grams, with_marked_terms
from threadlens.functions.words import WORD, stop_words
from threadlens.operators.ranking import top_n_per_group
from threadlens.operators.term_counts import BUCKETS, COUNTS, GROUPED, count_group_pairs, count_pairs, tally, tally_groups, weigh
from threadlens.session import cut_lineage

MOST_GROUPS = 10_000  # whose bounds the driver holds


@dataclass(frozen=True)
class TextOptions:
    """How texts become terms, and which terms a vocabulary keeps.

    ``stop`` lists the words left out: English ones if None, none if empty.
    """

    max_features: int = 10_000
    min_df: int = 2
    pattern: str = WORD
    stop: Sequence[str] | None = None
    pairs: bool = True

    def grams(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """Add the terms of a text, in order."""
        return with_grams(df, text, out, self.pattern, self._left_out(), self.pairs)

    def words(self, text: str) -> Column:
        """The words of a text, in order."""
        return tokens(F.col(text), self.pattern, self._left_out())

    def _left_out(self) -> Sequence[str]:
        return stop_words() if self.stop is None else self.stop


def _term_counts(df: DataFrame, text: str, options: TextOptions, *by: str) -> DataFrame:
    """Documents (``df``) and occurrences (``total``) of each term that is in enough documents."""
    grams = options.grams(df, text, "_grams")
    return (
        with_marked_terms(grams, "_grams", "_terms")
        # The outer form: for the plain one Spark adds a filter that makes all terms once more.
        .select(*by, F.inline_outer("_terms"))
        .filter(F.col("term").isNotNull())
        .groupBy(*by, "term")
        .agg(F.sum("first").alias("df"), F.count(F.lit(1)).alias("total"))
        .filter(F.col("df") >= options.min_df)
    )


def vocabulary(df: DataFrame, text: str, options: TextOptions) -> DataFrame:
    """The most frequent terms: term, df (documents), total (occurrences), ties by term.

    A first pass, which runs at once, counts words and how many pairs each hash bucket has. Where enough
    words are found, a pair in a bucket of fewer occurrences than the last of these words has cannot be
    among the terms; a second pass counts the others.
    """
    words = df.select(options.words(text).alias("_words"))
    tallied = cut_lineage(
        words.mapInArrow(tally(options.pairs), COUNTS).groupBy("term", "bucket")
        .agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
        .filter(F.col("term").isNull() | (F.col("df") >= options.min_df) | F.contains("term", F.lit(" ")))
    )
    single = tallied.filter(F.col("term").isNotNull())
    # Distinct numbers of occurrences: at most about the root of twice the number of words.
    sizes = single.groupBy("total").agg(F.count(F.lit(1)).alias("terms"), F.max(F.contains("term", F.lit(" "))).alias("blank"))
    sizes = sorted(sizes.collect(), reverse=True)
    if options.pairs and any(r.blank for r in sizes):  # such a word may equal a pair
        counts = _term_counts(df, text, options)
        return counts.orderBy(F.desc("total"), "term").limit(options.max_features)
    least = next((r.total for r, n in zip(sizes, accumulate(r.terms for r in sizes)) if n >= options.max_features), 1)
    counts = single.filter(F.col("df") >= options.min_df).select("term", "df", "total")
    if options.pairs:
        enough = F.col("bucket").isNotNull() & (F.col("total") >= max(least, options.min_df))
        buckets = tallied.filter(enough).select("bucket").toArrow()["bucket"].to_numpy()
        pairs = words.mapInArrow(count_pairs(buckets), COUNTS).groupBy("term")
        pairs = pairs.agg(F.sum("df").alias("df"), F.sum("total").alias("total")).filter(F.col("df") >= options.min_df)
        counts = counts.unionByName(pairs)
    return counts.filter(F.col("total") >= least).orderBy(F.desc("total"), "term").limit(options.max_features)


def vocabulary_union(*columns: tuple[DataFrame, str], extra: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null values of columns of several tables and of a list, as ``word``."""
    spark = columns[0][0].sparkSession
    words = spark.createDataFrame([(w,) for w in extra], "word string")
    for table, column in columns:
        words = words.unionByName(table.select(F.col(column).cast("string").alias("word")))
    return words.filter(F.col("word").isNotNull()).distinct()


def grouped_vocabulary(df: DataFrame, text: str, group: str, options: TextOptions) -> DataFrame:
    """A vocabulary per group, each with up to ``max_features`` terms.

    As in ``vocabulary``, a first pass counts words and how many pairs each bucket has, and a second one the pairs that
    can be among the terms of their group. With more than ``MOST_GROUPS`` groups all terms are counted in one aggregation,
    and so they are where groups are no strings.
    """
    order = [F.desc("total"), F.col("term")]
    if not isinstance(df.schema[group].dataType, T.StringType):
        counts = _term_counts(df, text, options, group)
        return top_n_per_group(counts, [group], order, options.max_features).drop("_rank")
    words = df.select(F.col(group).alias("group"), options.words(text).alias("_words"))
    tallied = cut_lineage(
        words.mapInArrow(tally_groups(options.pairs), GROUPED).groupBy("group", "term", "bucket")
        .agg(F.sum("df").alias("df"), F.sum("total").alias("total")))
    single = tallied.filter(F.col("term").isNotNull())
    sizes = single.groupBy("group", "total").agg(F.count(F.lit(1)).alias("terms"), F.max(F.contains("term", F.lit(" "))).alias("blank"))
    held = F.sum("terms").over(W.partitionBy("group").orderBy(F.desc("total")))
    enough = F.max(F.when(F.col("held") >= options.max_features, F.col("total"))).alias("least")
    needed = sizes.withColumn("held", held).groupBy("group").agg(enough, F.max("blank").alias("blank")).limit(MOST_GROUPS + 1).collect()
    if options.pairs and (len(needed) > MOST_GROUPS or any(r.blank for r in needed)):  # such a word may equal a pair
        counts = _term_counts(df, text, options, group)
        return top_n_per_group(counts, [group], order, options.max_features).drop("_rank")
    counts = single.select("group", "term", "df", "total")
    if options.pairs:
        filled, loads = tallied.filter("bucket IS NOT NULL").select("bucket", "total").toArrow(), np.zeros(BUCKETS, np.int64)
        loads[filled["bucket"].to_numpy()] = filled["total"].to_numpy()
        pairs = words.mapInArrow(count_group_pairs(loads, {r.group: r.least or 1 for r in needed}), GROUPED).groupBy("group", "term")
        counts = counts.unionByName(pairs.agg(F.sum("df").alias("df"), F.sum("total").alias("total")))
    counts = counts.filter(F.col("df") >= options.min_df).withColumnRenamed("group", group)
    return top_n_per_group(counts, [group], order, options.max_features).drop("_rank")


def smooth_idf(documents, df) -> float:
    """Inverse document frequency ln((1 + n) / (1 + df)) + 1."""
    return math.log((1 + documents) / (1 + df)) + 1


@dataclass(frozen=True)
class Weights:
    """A known vocabulary with its idf; turns arrays of terms into unit tf * idf vectors."""

    counter: CountVectorizerModel
    idf: tuple[float, ...]

    @staticmethod
    def of(spark: SparkSession, idf: dict[str, float]) -> Weights:
        """The given terms; their order is the one Spark gives them and is kept from then on."""
        known = spark.createDataFrame([(list(idf),)], "_grams array<string>")
        counter = CountVectorizer(inputCol="_grams", outputCol="_tf", vocabSize=len(idf), minDF=1).fit(known)
        return Weights(counter, tuple(idf[term] for term in counter.vocabulary))

    def apply(self, df: DataFrame, out: str) -> DataFrame:
        """Vectors of the terms in ``_grams``, row by row."""
        scale = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_tfidf")
        unit = Normalizer(p=2.0, inputCol="_tfidf", outputCol=out)
        return unit.transform(scale.transform(self.counter.transform(df))).drop("_tf", "_tfidf")


@dataclass(frozen=True)
class TextModel:
    """A fitted vocabulary; documents are turned into unit vectors row by row.

    Holds at most ``max_features`` terms, which is what makes it small enough to ship.
    """

    options: TextOptions
    weighing: Weights

    @property
    def terms(self) -> list[str]:
        """Terms by their position in a vector."""
        return list(self.weighing.counter.vocabulary)

    def vectors(self, df: DataFrame, text: str, out: str = "features") -> DataFrame:
        """Add the TF-IDF vector of a text; a text without known terms gets a zero vector."""
        grams = self.options.grams(df, text, "_grams")
        return self.weighing.apply(grams, out).drop("_grams")

    def weights(self, df: DataFrame, text: str, key: str) -> DataFrame:
        """Long form of the vectors: key, term, weight."""
        spark = df.sparkSession
        names = F.broadcast(spark.createDataFrame(list(enumerate(self.terms)), "position int, term string"))
        words = df.select(key, self.options.words(text).alias("_words"))
        schema = T.StructType([words.schema[key]])
        schema.add("_positions", T.ArrayType(T.IntegerType())).add("_weights", T.ArrayType(T.DoubleType()))
        return (
            words.mapInArrow(weigh(self.terms, self.weighing.idf, self.options.pairs), schema)
            .select(key, F.inline_outer(F.arrays_zip(
                F.col("_positions").alias("position"), F.col("_weights").alias("weight"))))
            .join(names, "position")
            .select(key, "term", "weight")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the vocabulary, its idf and its settings below ``path``."""
        o = self.options
        self.weighing.counter.write().overwrite().save(f"{path}/counter")
        row = (list(self.weighing.idf), o.max_features, o.min_df, o.pattern, None if o.stop is None else list(o.stop), o.pairs)
        schema = (
            "idf array<double>, max_features int, min_df int, pattern string, stop array<string>, pairs boolean"
        )
        spark.createDataFrame([row], schema).write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TextModel:
        """Read a saved vocabulary; nothing is fitted again."""
        row = spark.read.parquet(f"{path}/settings").first()
        options = TextOptions(row.max_features, row.min_df, row.pattern, None if row.stop is None else tuple(row.stop), row.pairs)
        return TextModel(options, Weights(CountVectorizerModel.load(f"{path}/counter"), tuple(row.idf)))


def fit_text_model(df: DataFrame, text: str, options: TextOptions) -> TextModel:
    """Fit vocabulary and idf. The driver receives ``max_features`` rows at most."""
    documents = df.count()
    rows = vocabulary(df, text, options).collect()
    if not rows:
        raise ValueError("no term is in min_df documents; the vocabulary would be empty")
    idf = {r.term: smooth_idf(documents, r.df) for r in rows}
    return TextModel(options, Weights.of(df.sparkSession, idf))
