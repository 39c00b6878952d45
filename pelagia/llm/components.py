"""Connected components of a graph of any size, by joins.

Edges are rewired in turns. In a large-star turn every larger neighbour of a node is
linked to the least of the node and its neighbours; in a small-star turn the
node and its smaller neighbours are linked to the least of them. When two turns change
nothing, every node points at the least node of its component. A node with very many
edges is never gathered in one group: the least neighbour comes from an aggregation
and is joined back, which adaptive execution splits under skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """Nodes with edges, and the least node of the component of each.

    ``edges`` has the long columns ``a`` and ``b`` in any direction; loops, nulls and
    repeated edges do no harm. Returns ``node`` and ``component``; nodes without an edge
    to another node do not appear.
    """
    pairs = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        pairs = stored(_small_star(_large_star(pairs)))


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
