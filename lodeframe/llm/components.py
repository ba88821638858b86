"""Connected components of an edge table, by alternating large and small stars.

Each round is two grouped minima and two joins over the edges; a graph of n
nodes needs about log n rounds.  Edges are written to the shared folder after
every round, so lineage stays short and a lost executor costs one round; the
table before is deleted then.  Minima are partial before they are shuffled.  Of
more than ``HUB_EDGES`` edges (counted) they are written before they are joined: both
sides of the join then come straight from an exchange, so the edges of a hub, which
all meet its one minimum, are split over tasks (as skewed partitions of the join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import forget, write_shared


#: Edges that one task can hold at a hub.
HUB_EDGES = 1_000_000


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _minima(links: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours."""
    return _both_ways(links).groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _round(links: DataFrame, least: DataFrame) -> DataFrame:
    """Every node hung to the smallest of its neighbours, first the larger neighbours, then the smaller ones."""
    both = _both_ways(links)
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    # used twice below: one exchange serves both
    joined = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
    return joined.select("a", F.col("m").alias("b")).unionByName(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame, name: str) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is named by its smallest node."""
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    spark = edges.sparkSession
    links, path = write_shared(links, name)
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen, before = state, path
        least, least_path = _minima(links), None
        if state[0] > HUB_EDGES:
            least, least_path = write_shared(least, name)
        links, path = write_shared(_round(links, least), name)
        for gone in (before, least_path):
            if gone:
                forget(spark, gone)
    named = links.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return named.unionByName(roots)
