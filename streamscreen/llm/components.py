"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamscreen.session import discard, durable


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component, for every node of the edges (a, b).

    Each round takes the smallest label among a node and its neighbours, then the label of that label, so paths shorten
    by doubling. Labels are aggregated before they are shuffled; the neighbours of a node are never gathered.
    Edges with a null end are ignored.
    """
    known = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = durable(known.union(known.select("b", "a")).distinct(), "graph-edges")
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("root")), "graph-labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("_near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("root").alias("_was"), F.least("root", "_near").alias("_root"))
        above = labels.select(F.col("node").alias("_above"), F.col("root").alias("_next"))
        before, labels = labels, durable(lower.join(above, F.col("_root") == F.col("_above")).select(
            "node", F.least("_root", "_next").alias("root"), "_was"), "graph-labels")
        discard(before)
        if labels.where(F.col("root") != F.col("_was")).limit(1).count() == 0:
            discard(both)
            return labels.select("node", "root")
