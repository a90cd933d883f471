"""Connected components of a distributed list of links.

Alternating large-star and small-star steps: every node's larger (smaller)
neighbours are hung below the least node it sees, until the links form one
star a component. A step is an aggregate with map-side combine and a join of
the pairs with each node's least neighbour. Nodes with more pairs than a
bound, of which there can be at most ``BROADCAST_NODES``, meet their pairs by
broadcast, where these lie: no pair of a hub is shuffled by the hub, and what is
shuffled by node has small groups only. Each round is written to the shared
folder, so lineage stays short and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import materialise

BROADCAST_NODES = 500_000  # rows of two ids


def _with_least(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every pair (u, v) with u's least neighbour m, and a row (u, m) for every u."""
    least = materialise(pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
    row = least.agg(F.count("*").alias("nodes"), F.sum("n").alias("pairs")).first()
    # Fewer than BROADCAST_NODES nodes can have more than a BROADCAST_NODES-th of all pairs.
    bound = 0 if row["nodes"] <= BROADCAST_NODES else row["pairs"] // BROADCAST_NODES
    hubs = F.broadcast(least.where(F.col("n") > bound).select("u", "m"))
    met = pairs.join(hubs, "u")
    if bound:
        rest = least.where(F.col("n") <= bound).select("u", "m")
        met = met.unionByName(pairs.join(hubs, "u", "left_anti").join(rest, "u"))
    return met, least.select("u", "m")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    met, _ = _with_least(both)
    return met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    met, least = _with_least(down)
    below = met.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 100) -> DataFrame:
    """Rows (node, component) for every node of ``links`` but the least of each component.

    ``links`` holds pairs of non-NULL ids; pairs may repeat and may name one
    node twice. The component is its least node; a node that does not occur in
    the result is its own.
    """
    edges = materialise(links.select(F.col(a).alias("u"), F.col(b).alias("v"))
                        .where(F.col("u") != F.col("v")).distinct(), "links")
    signature = None
    for _ in range(most_rounds):
        edges = materialise(_small_star(_large_star(edges)), "links")
        row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (row["n"], row["s"]) == signature or not row["n"]:
            break
        signature = row["n"], row["s"]
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
