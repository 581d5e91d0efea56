"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.sources.staging import stage


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node reachable.

    Turns of large star (what is larger than a node is linked to the least of its
    neighbourhood) and small star (what is smaller is) until the links are stars. Each turn is
    written to the shared folder. The least neighbour is a sum of partial ones, and joined
    back from a written table, so a hub's links are split by the join.
    """
    links = stage(_both_ways(links).filter("a > b").distinct())
    before = _print(links)
    for _ in range(rounds):
        both = _both_ways(links)
        least = stage(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct())
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a")
        links = stage(
            small.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        after = _print(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components are not found after {rounds} rounds")
    roots = links.select("b").distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )


def _both_ways(links: DataFrame) -> DataFrame:
    pair = links.select("a", "b")
    return pair.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _print(links: DataFrame) -> tuple:
    # Equal for equal sets of links, one row whatever their number.
    h = F.xxhash64("a", "b")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(h % 1_000_003), F.bit_xor(h)).first())
