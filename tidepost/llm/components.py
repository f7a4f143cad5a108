"""Connected components of a table of links, by repeated joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for links ``a, b`` (bigint): the smallest node reachable is the label.

    Alternating large and small stars: each node hands its larger neighbours to the smallest one
    it sees, until nothing changes. Each step is one self-join-free aggregation over links and is
    written to the shared folder. Nodes without a link are not listed. The smallest neighbour of a
    node is found by a partial aggregation, written, and joined back by merging, which Spark splits
    at run time where a node has very many, so no task holds a large star.
    """
    edges = cut(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")), "lowest").hint("merge")
        # Large star: larger neighbours of a node move to the smallest node around it.
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b")
        large = cut(large.distinct(), "large-star")
        # Small star: smaller neighbours and the node itself move to the smallest neighbour.
        low = cut(large.groupBy("a").agg(F.min("b").alias("low")), "lowest").hint("merge")
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        edges = cut(small.where("a != b").distinct(), "small-star")
        state = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint"))).first()
        if state == before:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
        before = state
