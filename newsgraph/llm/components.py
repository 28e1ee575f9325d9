"""Connected components of a table of links, in Spark jobs that end after a few rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.scratch import materialise


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(links: DataFrame, left: str, right: str, node: str = "node", component: str = "component") -> DataFrame:
    """`node` and `component` (its smallest reachable node) of every node that has a link to another one.

    Two kinds of steps alternate until nothing changes. A large step ties each node's greater neighbours to its least
    neighbour, a small step does so for the lesser ones; both only replace links, so their number never grows, and paths
    shorten by more than half each round. Minima combine before the shuffle; the joins back to a node with very many
    links are left to the optimiser's skew handling. Each round is written to the shared folder, which cuts lineage.
    Links from a node to itself, null ends and repeated links are ignored; an empty table has no components.
    """
    edges = (
        links.select(F.least(left, right).alias("u"), F.greatest(left, right).alias("v"))
        .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
        .distinct()
    )
    edges = materialise(edges, "links")
    state = _fingerprint(edges)
    while state[0]:
        both = _both_ways(edges)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        larger = larger.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        larger = materialise(larger, "links")
        # u < v: v's lesser neighbours and v itself go to the least of them
        lowest = larger.groupBy("v").agg(F.min("u").alias("m"))
        tied = larger.join(lowest, "v").select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b"))
        smaller = materialise(tied.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "links")
        edges, before, state = smaller, state, _fingerprint(smaller)
        if state == before:
            break
    found = edges.select(F.col("v").alias(node), F.col("u").alias(component))
    roots = edges.select(F.col("u").alias(node), F.col("u").alias(component)).distinct()
    return found.unionByName(roots)
