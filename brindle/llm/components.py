"""Connected components of a graph of edges, by alternating large and small stars.

Each round is two joins and two map-side combined minima; no node's neighbours are gathered. The number of rounds
grows with the logarithm of the number of nodes. Each round is kept in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for each node of edges (a long, b long). Loops and repeats are fine; none null."""
    e = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    n, total = e.count(), None
    while n:
        # large star: greater neighbours of a node go to the least of its neighbourhood
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, both["a"] == least["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: smaller neighbours of a node, and itself, go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(low, large["a"] == low["u"]).select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        e = settle(small.where("a <> b").distinct())
        sums = e.agg(F.count("*"), F.sum(F.col("b") % 1_000_003), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if tuple(sums) == total:
            break
        total = tuple(sums)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
