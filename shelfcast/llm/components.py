"""Connected components of a graph given as an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b); the root is the smallest node of its component.

    Each round hangs every node's larger neighbours under its smallest one, then does the same among the
    smaller neighbours; the number of rounds grows with the logarithm of the nodes. Minima are combined before
    the shuffle, and joins on a node with very many edges are split by adaptive execution. Every round is
    written to the shared folder, which cuts the lineage. Loops are ignored.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    pairs = edges.where(F.col("a") != F.col("b")).select(high.alias("u"), low.alias("v")).distinct()
    pairs = written(pairs, "links")
    seen = _sign(pairs)
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = written(hung.distinct(), "links")
        lowest = hung.groupBy("u").agg(F.min("v").alias("m"))
        rest = hung.join(lowest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), "m")
        pairs = written(lowest.union(rest).distinct().withColumnRenamed("m", "v"), "links")
        now = _sign(pairs)
        if now == seen:
            break
        seen = now
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _sign(pairs: DataFrame) -> tuple:
    """Count and hash sum of the pairs: equal signs mean that a round changed nothing."""
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
