"""Connected components of a link table as a loop of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley import session


def components(links: DataFrame) -> DataFrame:
    """node and component (the least node reachable) of every node of ``links`` (a, b); order and repeats do not matter.

    Alternating large-star and small-star steps: each node hands its greater, then its lesser neighbours on to the least
    one it knows, until no edge moves; the number of rounds grows with the logarithm of the longest path. Every round is a
    grouped minimum with map-side combining and a join, and is written to the shared folder, so no links reach the driver
    and a lost executor costs one round at most. A null end or a link of a node to itself is left out.
    """
    pairs = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = session.materialise(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        edges = session.materialise(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(edges.select(F.col("b").alias("n"), F.col("a").alias("m")))
    least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least"))
    return both.join(least, "n").where("m > n").select(F.col("m").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge points from its greater to its lesser end
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
