"""Topic discovery from pairs to labelled tables: sample, vectors, sweep, sheet to name the topics, then all pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.config import Settings
from threadlens.operators.cluster import ClusterModel, cluster_samples, sweep_kmeans, top_terms
from threadlens.operators.features import TextModel, TextOptions, fit_text_model
from threadlens.operators.labels import assign_intents, with_text
from threadlens.operators.profile import group_shares
from threadlens.operators.sampling import random_rows
from threadlens.session import cut_lineage
from threadlens.sources.tables import read_split, write_split


@dataclass(frozen=True)
class Topics:
    """What discovery has fitted; ``assign`` applies it without fitting anything again."""

    text_model: TextModel
    clusters: ClusterModel

    def assign(self, rows: DataFrame, text: str = "customer_text") -> DataFrame:
        """Add ``cluster_id``; a missing text counts as an empty one."""
        vectors = self.text_model.vectors(with_text(rows, text), text, self.clusters.features)
        return self.clusters.transform(vectors).select(*rows.columns, "cluster_id")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write both models below ``path``."""
        self.text_model.save(spark, f"{path}/text")
        self.clusters.save(spark, f"{path}/clusters")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Topics:
        """Read saved topics."""
        return Topics(TextModel.load(spark, f"{path}/text"), ClusterModel.load(spark, f"{path}/clusters"))


@dataclass(frozen=True)
class Discovery:
    """Fitted topics, the sheet of samples by which a person names them, and the scores of all candidates."""

    topics: Topics
    sheet: DataFrame
    scores: DataFrame


def discover_topics(
    pairs: DataFrame, settings: Settings, options: TextOptions, key: str = "brand_tweet_id", text: str = "customer_text",
    samples: int = 6,
) -> Discovery:
    """Fit topics on ``settings.cluster_rows`` random messages that have a text."""
    spark, seed = pairs.sparkSession, settings.seed
    known = pairs.filter(F.col(text).isNotNull()).select(key, text)
    drawn = cut_lineage(random_rows(known, key, settings.cluster_rows, seed))
    text_model = fit_text_model(drawn, text, options)
    vectors = cut_lineage(text_model.vectors(drawn, text))
    found = sweep_kmeans(vectors, "features", key, settings.k_candidates, seed, sample=settings.silhouette_rows)
    topics = Topics(text_model, found.model)
    assigned = cut_lineage(found.model.transform(vectors).select(key, text, "cluster_id"))
    sheet = cluster_samples(assigned, top_terms(found.model, text_model.terms, pairs), key, text, samples, seed)
    rows = [(k, cost, score, k == found.k) for k, cost, score in found.scores]
    return Discovery(topics, sheet, spark.createDataFrame(rows, "k int, cost double, silhouette double, selected boolean"))


def label_pairs(pairs: DataFrame, topics: Topics, taxonomy: DataFrame, path: str, text: str = "customer_text") -> DataFrame:
    """Write all pairs with their cluster and intent, labeled and excluded ones apart; returns the intents' shares."""
    write_split(assign_intents(topics.assign(pairs, text), taxonomy), path)
    labeled, _ = read_split(pairs.sparkSession, path)
    return group_shares(labeled, "intent")
