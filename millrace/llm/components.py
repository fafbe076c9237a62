"""Connected components of a graph of links, by contraction; no part of the graph ever goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """links: a, b (long). Returns node, label: the least node of its component, for every node that has a link.

    Each round every node takes the least of itself and its neighbours as its parent, parents are followed once more, and the
    links between parents are the next round's graph. Every component at least halves a round, so rounds grow as the
    logarithm of its size; stars, which is what the callers make, end after one or two."""
    # Both directions come from one written table: links that are computed twice may be other ones the second time (a star has another
    # centre when its rows come in another order), and a graph that holds only one direction of a link falls apart.
    links = materialize(links.where("a <> b").select("a", "b"), "given")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    graph = materialize(both.distinct(), "links")
    label = None
    while True:
        parent = graph.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up"))
        parent = materialize(parent, "parents")
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        parent = materialize(parent.join(above, "up").select("node", "top"), "tops")
        if label is None:
            label = parent.select("node", F.col("top").alias("label"))
        else:
            label = label.join(parent.select(F.col("node").alias("label"), "top"), "label", "left").select("node", F.coalesce("top", "label").alias("label"))
        label = materialize(label, "labels")
        to = parent.select(F.col("node").alias("a"), F.col("top").alias("ta"))
        fro = parent.select(F.col("node").alias("b"), F.col("top").alias("tb"))
        graph = graph.join(to, "a").join(fro, "b").where("ta <> tb").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct()
        graph = materialize(graph, "links")
        if graph.isEmpty():
            return label
