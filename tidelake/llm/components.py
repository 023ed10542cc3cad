"""Connected components of links, by labels that shrink until they stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its smallest node.

    In each round a node takes the smallest label around it, and then the label of
    its label, so paths halve.  A hub's links meet its one label in a join that can
    be split, and the smallest label is aggregated before the shuffle.  Each round
    is a table in the shared folder.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "labels")
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("_n"), "component"), F.col("b") == F.col("_n"))
            .groupBy(F.col("a").alias("_a"))
            .agg(F.min("component").alias("_around"))
        )
        nearer = labels.join(around, F.col("node") == F.col("_a")).select(
            "node", F.col("component").alias("_old"), F.least("component", "_around").alias("_new")
        )
        own = labels.select(F.col("node").alias("_m"), F.col("component").alias("_far"))
        moved = written(
            nearer.join(own, F.col("_new") == F.col("_m"), "left").select(
                "node", F.least("_new", F.coalesce("_far", "_new")).alias("component"), "_old"
            ),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.where("component <> _old").isEmpty():
            return labels
