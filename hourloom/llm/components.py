"""Connected components of a table of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.session import durable


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b): root is the smallest node reachable.

    Rounds of large stars and small stars hang every node onto the smallest neighbour known, until nothing
    changes; the number of rounds grows with the logarithm of the longest chain. Each round is written to the checkpoint
    folder. A node with very many neighbours is split by adaptive skew joins, since minima are combined before the
    shuffle. No links give no rows; links from a node to itself and repeated links do no harm.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = durable(pairs)
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        pairs = durable(small.where("a <> b").distinct())
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
