"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payguard.session import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with an edge; the root is the component's smallest node.

    ``edges`` has two long columns ``u, v``. Each round links every node's larger neighbours to
    its smallest one (large star) and then its smaller neighbours (small star), until nothing
    changes, which takes a number of rounds logarithmic in the size. The smallest neighbours come from an aggregate
    with map-side combine and are checkpointed before they meet the edges: as a table of its own, a row a node, that
    side of the join leaves adaptive execution free to split the edges of a node with very many neighbours,
    such as a root in the last rounds. Between rounds the edges are checkpointed.
    """
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
        large = cut(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = cut(small.select("e.u", "e.v").where("u <> v").distinct())
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
