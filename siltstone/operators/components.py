"""Connected components by alternating star contraction (for D52).

The large-star / small-star scheme of Kiveris et al. (2014): every round points
each vertex at a smaller neighbour, and the number of rounds grows with the
logarithm of the graph, not with its diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import cut_lineage, skew_join


def _relink(neighbours: DataFrame, keep_self: bool) -> DataFrame:
    """Point the neighbours of each vertex at the smallest of them.

    `neighbours(u, v)`: a vertex and one neighbour.  The minimum is combined
    map-side; a hub that holds much of the edges is salted in the join.
    """
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = skew_join(neighbours, least, "u", spread=["v"])
    if keep_self:
        # Small star: smaller neighbours and the vertex itself move to the minimum.
        moved = joined.select(F.col("v").alias("src"), F.col("m").alias("dst"))
        own = least.select(F.col("u").alias("src"), F.col("m").alias("dst"))
        edges = moved.unionByName(own)
    else:
        # Large star: larger neighbours move.
        edges = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("src"), F.col("m").alias("dst"))
    return edges.where(F.col("src") != F.col("dst")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Has every vertex one parent at most, and no parent a parent of its own?

    Edges lead to smaller ids, so then each component is a star around its smallest.
    """
    roles = edges.select(F.col("src").alias("v"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
        edges.select(F.col("dst").alias("v"), F.lit(0).alias("child"), F.lit(1).alias("parent"))
    )
    seen = roles.groupBy("v").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return seen.where(F.col("child") + F.col("parent") * F.least("child", F.lit(1)) > 1).isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component) for every vertex that has an edge; `component` is the smallest id."""
    current = cut_lineage(
        edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .where(F.col("src") != F.col("dst"))
        .distinct(),
        "edges",
    )
    rounds = 0
    while not _settled(current):
        if rounds == max_rounds:
            raise RuntimeError("components did not settle")
        rounds += 1
        both = current.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(
            current.select(F.col("dst").alias("u"), F.col("src").alias("v"))
        )
        large = cut_lineage(_relink(both, keep_self=False), "edges")
        small = _relink(large.select(F.col("src").alias("u"), F.col("dst").alias("v")), keep_self=True)
        current = cut_lineage(small, "edges")
    roots = current.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct()
    return current.select(F.col("src").alias("id"), F.col("dst").alias("component")).unionByName(roots)
