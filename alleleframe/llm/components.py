"""Connected components by alternating large-star and small-star.

Every round replaces each link by links to the smallest node around: large-star
links the larger neighbours of a node to the smallest node of its neighbourhood,
small-star does the same for the smaller neighbours and the node itself. Rounds
end when the links stay as they are; then each node has one link, to the
smallest node of its component. Minima are grouped with partial results, so a
node with very many links is no hot group, and links join minima with a join
that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alleleframe.llm.common import staged


def _with_smallest(links: DataFrame) -> DataFrame:
    """``links`` of (node, other) with ``least``: the smallest of node and its others."""
    smallest = links.groupBy(F.col("node").alias("of")).agg(F.min("other").alias("least"))
    smallest = smallest.withColumn("least", F.least("of", "least"))
    return links.join(smallest, F.col("node") == F.col("of")).drop("of")


def large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    found = _with_smallest(both).where("other > node")
    return found.select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """``links`` have the larger node first."""
    found = _with_smallest(links)
    kept = found.select("node", F.col("least").alias("other"))
    moved = found.where("other > least").select(F.col("other").alias("node"), F.col("least").alias("other"))
    return kept.unionByName(moved).distinct()


def _state(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), total).first())


def components(links: DataFrame) -> DataFrame:
    """node, component for every node that has a link to another; component is its smallest node.

    ``links`` has columns node and other of one orderable type, in any
    direction, with repeats and self-links allowed; nulls link nothing.
    """
    current = staged(
        links.where("node != other")
        .select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
        .distinct(),
        "links",
    )
    before = _state(current)
    while True:
        current = staged(small_star(large_star(current)), "links")
        after = _state(current)
        if after == before:
            stars = current.withColumnRenamed("other", "component")
            centres = stars.select(F.col("component").alias("node"), "component").distinct()
            return stars.unionByName(centres)
        before = after
