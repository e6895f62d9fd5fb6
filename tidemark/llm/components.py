"""Connected components of a large edge list, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.control import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, label)`` of every vertex of ``edges (a, b)``; ``label`` is the
    smallest id of its component.

    Each round takes the least label among the neighbours and then follows the
    label's own label, so the number of rounds grows with the logarithm of the
    longest path. A round is written to the shared folder: it cuts the lineage
    and survives lost executors. Vertices with many edges are pre-aggregated.
    """
    both = materialize(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a != b").distinct(), "cc-edges"
    )
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "cc-labels")
    while True:
        around = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("label").alias("around"))
        hooked = labels.join(around, labels.id == around.a).select("id", F.col("label").alias("old"), F.least("label", "around").alias("label"))
        of = labels.select(F.col("id").alias("label"), F.col("label").alias("next"))
        stepped = materialize(
            hooked.join(of, "label", "left").select("id", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "cc-labels"
        )
        labels = stepped.select("id", "label")
        if stepped.where("old != label").isEmpty():
            return labels
