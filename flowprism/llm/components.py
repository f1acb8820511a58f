"""Connected components of a distributed edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowprism.llm.common import cut


def _both(e: DataFrame) -> DataFrame:
    return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _state(e: DataFrame):
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v long) -> (node, root) for every node of an edge, root being the smallest node reachable.

    Each round joins every neighbourhood to its minimum, so long chains halve; rounds stop when the edge set no longer
    changes. Every round is checkpointed, and a hub's neighbours are spread by AQE's skew join. Self loops and repeated
    edges do no harm; an empty table gives an empty table.
    """
    e = cut(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u <> v").distinct())
    state = _state(e)
    while state[0]:
        # large star: neighbours above a node move to the smallest member of its neighbourhood
        near = _both(e)
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e1 = (near.join(low, "u").filter("v > u").select(F.col("m").alias("u"), "v").filter("u <> v").distinct())
        # small star: neighbours below a node (and the node) move to the smallest of them
        down = e1.select(F.col("v").alias("u"), F.col("u").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        e2 = (down.join(low, "u").select(F.col("m").alias("u"), "v")
              .union(low.select(F.col("m").alias("u"), F.col("u").alias("v"))).filter("u <> v").distinct())
        e = cut(e2)
        now = _state(e)
        if now == state:
            break
        state = now
    return (e.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root"))
            .union(e.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()))
