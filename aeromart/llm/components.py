"""Connected components by alternating large-star and small-star steps, as joins and aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromart.llm.staging import staged


def _stars(pairs: DataFrame) -> DataFrame:
    """(node, other, least): the pairs with the smallest of the node and its others. A node with many pairs is only aggregated and joined."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return pairs.join(least, "node")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of the links (a, b); the component is its smallest node.

    Each step writes its links to the shared folder; the steps end when the links are stars around
    the smallest nodes, after a number of steps that grows with the logarithm of the longest path.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct()
    state = None
    while True:
        both = links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _stars(both).where("other > node").select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()
        stars = _stars(large.where("node <> other"))
        small = stars.select(F.explode(F.array("node", "other")).alias("node"), F.col("least").alias("other"))
        links = staged(small.where("node <> other").distinct(), "links")
        found = links.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "other")), F.max("other")).first()
        if found == state:
            return links.select("node", F.col("other").alias("component"))
        state = found
