"""Connected components of a stored edge list by rounds of minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (smallest node of its component) for each node of the edges ``a``, ``b``.

    Each round every node takes the smallest label among its own and its neighbours', then the label of
    that label. Rounds are few where components are near-stars, as forests of near copies are; the jump
    makes them far fewer than the longest path elsewhere. Each round is stored in the shared folder, so a lost executor costs
    one round at most. The labels meet the edges in plain many-to-one joins, which Spark can split for
    a node with very many edges; minima are combined before each shuffle. Only one count per round
    comes to the driver.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b"), "edges")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        .select("node", F.least("node", "near").alias("label")),
        "labels",
    )
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), F.col("label")), "b").select(F.col("a").alias("node"), "label")
        lower = seen.groupBy("node").agg(F.min("label").alias("near"))
        own = labels.join(lower, "node").select("node", "label", F.least("label", "near").alias("next"))
        own = stored(own, "labels")
        up = own.select(F.col("node").alias("next"), F.col("next").alias("higher"))
        jumped = stored(
            own.join(up, "next", "left")
            .select("node", F.least("next", "higher").alias("new"), (F.col("label") != F.least("next", "higher")).alias("moved")),
            "labels",
        )
        moved = jumped.filter("moved").count()
        labels = jumped.select("node", F.col("new").alias("label"))
        if not moved:
            return labels
