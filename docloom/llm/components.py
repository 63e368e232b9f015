"""Connected components of a table of links, by random contraction.

In each round every node picks, of itself and its neighbours, the one with the smallest random number (a hash of node
and round), and links move to the picked nodes. Links inside a group vanish, the others halve in expectation, whatever
the shape of the graph: chains need no more rounds than stars. Nodes and links stay in tables; only the number of links
left comes to the driver. All tables are stored, so joins on a node with very many links are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import pinned


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row per node that has links to others: node, root. Nodes have the same root if links connect them.

    Direction, repeats and order of links don't matter; links of a node to itself, or to null, are ignored.
    """
    left = pinned(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    labels, rounds = None, 0
    while left.head() is not None:
        rounds += 1
        ways = left.union(left.select("b", "a"))
        number = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(rounds)).alias("h"), F.col(c).alias("n"))
        picks = pinned(
            ways.groupBy("a")
            .agg(F.min(number("b")).alias("near"))
            .select(F.col("a").alias("node"), F.least("near", number("a")).getField("n").alias("to"))
        )
        if labels is None:
            labels = picks.select("node", F.col("to").alias("root"))
        else:
            moved = labels.join(picks.withColumnRenamed("node", "root"), "root", "left")
            labels = pinned(moved.select("node", F.coalesce("to", "root").alias("root")))
        left = pinned(
            left.join(picks.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
            .join(picks.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
            .where("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct()
        )
    return left.select(F.col("a").alias("node"), F.col("b").alias("root")) if labels is None else labels
