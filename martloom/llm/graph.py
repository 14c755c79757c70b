"""Connected components of an undirected graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    moved = joined.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; the component is its smallest node.

    Large-star and small-star steps in turn until nothing changes, each stored in the shared folder. Minima are taken
    before the shuffle, so a node with very many links is no task of its own. Without links there are no rows.
    """
    current = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        # Sums of halves of the hash, so that no sum leaves 64 bits.
        mark = F.xxhash64("a", "b")
        seen = current.agg(F.count("*"), F.sum(F.shiftright(mark, 32)), F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF)))).head()
        if seen == state or not seen[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state = seen
        current = stored(_small_star(_large_star(current)), "links")
