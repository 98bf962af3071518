"""Connected components of a graph given as links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` of every node that has a link; the component is its smallest node.

    ``links`` has two columns, ``a`` and ``b``, of long numbers, in any direction,
    repeated or not. Large-star and small-star in turn: first every larger neighbour
    of a node, then every smaller one, is linked to the smallest of them, until all
    links go from a node to its component. Each round reads a written table, and the
    only groups are sums of one row per key, so a node with very many links is
    no single task's work. Raises if ``rounds`` do not suffice, which takes a chain of
    more than 2 to the power of a third of them.
    """
    links = staged(
        links.filter("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct()
    )
    before = None
    for _ in range(rounds):
        both = links.union(links.select("b", "a")).toDF("a", "b")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m")
        )
        large = (
            both.filter("b > a")
            .join(least, F.col("a") == F.col("n"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = staged(large)
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("n")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).filter("a <> b").union(least.select("n", "m"))
        links = staged(small.distinct())
        now = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.min("a")
        ).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                links.select("b", "b").distinct()
            )
        before = now
    raise RuntimeError(f"components not found in {rounds} rounds")
