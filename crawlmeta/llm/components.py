"""Connected components of a link table, by alternating large and small stars.

Each round is a few joins and minimum aggregates over the links, so no task
holds a component; the links of a round are written to the shared folder, which
cuts lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmeta.llm.common import written


def _large_star(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """Every larger neighbour of a node links to the node's least neighbour. The
    least neighbours are a table of their own, so that both sides of the join are
    shuffled for it and adaptive execution splits a node with many neighbours."""
    both = edges.select("u", "v").union(edges.select("v", "u"))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), folder, name)
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame, folder: str) -> DataFrame:
    """(u, v) links to (node, component): the least node reachable, for every
    node that is not its component's least. Links of a node to itself and null
    ends are ignored; no links give no rows."""
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    edges = written(edges, folder, "links-0")
    rounds = 0
    while True:
        heads = edges.select(F.col("v").alias("u")).distinct()
        chained = edges.join(heads, "u", "left_semi").limit(1).count()
        forked = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        if not chained and not forked:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        rounds += 1
        edges = written(_small_star(_large_star(edges, folder, f"least-{rounds}").distinct()).distinct(), folder, f"links-{rounds}")
