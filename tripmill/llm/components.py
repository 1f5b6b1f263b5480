"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of (a, b) edges; the label is the component's smallest node.

    Each round takes the smallest label among the neighbours and then the label of the label, so
    long chains shorten fast. Rounds are written to the shared folder. A hot node's labels are
    added up before the shuffle, and its edges are split by the skewed join.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "component-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "component-labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("heard")), "b")
        least = heard.groupBy(F.col("a").alias("node")).agg(F.min("heard").alias("heard"))
        met = labels.join(least, "node").select("node", "label", F.least("label", "heard").alias("met"))
        beyond = labels.select(F.col("node").alias("met"), F.col("label").alias("beyond"))
        moved = met.join(beyond, "met").select("node", F.least("met", "beyond").alias("label"), F.col("label").alias("old"))
        moved = stored(moved, "component-labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels
