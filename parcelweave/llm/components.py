"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelweave.llm.common import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected ``edges`` (a, b); the root is the smallest node.

    Each round a node takes the smallest label among its neighbours, passes it on to the node that its
    own label names, and then skips to its label's label; long chains halve in every round.  Rounds end
    when no label changes.  State is written to the shared folder each round; a hub's edges are reduced
    before they meet.  No edges give no rows.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both.distinct())
    labels = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
    before = _total(labels)
    while before is not None:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("m"))
        met = near.join(labels, F.col("a") == F.col("node")).select("node", "root", "m")
        told = met.select(F.explode(F.array(F.struct("node", F.least("root", "m").alias("root")), F.struct(F.col("root").alias("node"), F.col("m").alias("root")))).alias("x"))
        lower = told.select("x.*").groupBy("node").agg(F.min("root").alias("root"))
        over = lower.select(F.col("node").alias("root"), F.col("root").alias("top"))
        labels = cut_lineage(lower.join(over, "root").select("node", F.col("top").alias("root")), labels)
        now = _total(labels)
        if now == before:
            break
        before = now
    return labels


def _total(labels: DataFrame):
    """Labels only ever fall, so an equal sum means equal labels."""
    return labels.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
