"""The hand-edited mapping from clusters to intents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.operators.labels import intent_names
from threadlens.sources.tables import read_csv

TAXONOMY_SCHEMA = (
    "cluster_id int, cluster_size int, top_terms string, intent string, "
    "include_in_training boolean, notes string"
)


@dataclass(frozen=True)
class Taxonomy:
    """Mapping table with the views later stages need; one row per cluster."""

    table: DataFrame

    @property
    def cluster_intents(self) -> DataFrame:
        """Clusters in use with their intent."""
        return self.table.filter("include_in_training").select("cluster_id", "intent")

    @property
    def excluded_clusters(self) -> DataFrame:
        """Clusters that are no intent."""
        return self.table.filter(~F.col("include_in_training")).select("cluster_id")

    @property
    def intents(self) -> DataFrame:
        """Distinct intents, in order."""
        return intent_names(self.table)


def load_taxonomy(spark: SparkSession, path: str) -> Taxonomy:
    """Read the mapping CSV."""
    return Taxonomy(read_csv(spark, path, TAXONOMY_SCHEMA))
