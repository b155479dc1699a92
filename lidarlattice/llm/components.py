"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lidarlattice.llm._common import cut


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One star step on links (a, b): neighbours of each node point to the least of them and the node itself.

    The large step moves the greater neighbours, the small step the lesser ones and the
    node. The minimum per node is combined before the shuffle, and nodes with very many
    neighbours meet it in a plain equi-join whose large partitions AQE can split.
    """
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sided = both if large else both.where("b < a")
    least = sided.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    joined = sided.join(least, F.col("a") == F.col("n"))
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Links (a, b) of longs -> (node, root): the least node reachable, for every node that has a link.

    Each round costs a few shuffles of the links that are left; the number of rounds grows
    with the logarithm of the longest path. Rounds are cut by checkpoints, so a lost
    executor never repeats more than one. Self links and nulls are ignored; no links give
    an empty table.
    """
    links = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now["n"] == 0 or now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = now
        links = cut(_stars(_stars(links, large=True), large=False))
    raise RuntimeError(f"components are not done after {max_rounds} rounds")
