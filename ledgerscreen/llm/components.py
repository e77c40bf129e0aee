"""Connected components of a link table by repeated smallest-neighbour steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscreen.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the
    smallest node that can be reached.

    Each step takes the smallest label among a node and its neighbours and then
    the label of that label, so chains halve.  State is written every step."""
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = written(both.where("a <> b"), "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m"))
                     .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
                .withColumnRenamed("a", "node"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        hop = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        new = written(step.join(hop, "next", "left")
                      .select("node", F.col("label").alias("was"), F.least("next", "far").alias("label")), "labels")
        if new.where("was <> label").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
