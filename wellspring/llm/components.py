"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node.

    Each round takes the smallest label among a node and its neighbours and then
    the label of that label, so long chains shrink by halves; it ends when
    no label changes.  All steps are joins and partial aggregates, and the labels
    are written once a round, so hubs are pre-aggregated and lost executors cost one round.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both.where("a <> b").distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")))
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        step = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("label")
        )
        onward = labels.select(F.col("node").alias("label"), F.col("component").alias("onward"))
        new = cut_lineage(step.join(onward, "label").select("node", "before", F.least("label", "onward").alias("component")))
        if new.where("before <> component").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")
