"""Connected components by alternating large-star and small-star rounds
(Kiveris et al., 2014), as joins and aggregates on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.session import materialize

MAX_ROUNDS = 60


def _directed(edges: DataFrame) -> DataFrame:
    """(u, v), both ways."""
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node id reachable, for every node of
    an edge (u, v).  Each round is one aggregate and one join on the node; a
    node with very many edges is folded map-side in the aggregate and split
    by AQE in the join.  The table of a round is written to the shared
    folder, so no round recomputes an earlier one."""
    current = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                          .distinct(), "cc-edges")
    for _ in range(MAX_ROUNDS):
        both = _directed(current)
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = materialize(large, "cc-large")
        # every edge of `large` already points from a node to a smaller one
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lowest, "u")
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u <> v").distinct())
        following = materialize(small, "cc-small")
        n = following.count()
        same = n == current.count() and following.join(current, ["u", "v"], "left_anti").isEmpty()
        current = following
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("v").alias("node")).distinct()
    return (current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))
