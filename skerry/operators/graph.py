"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _is_star(edges: DataFrame) -> bool:
    """Whether no node has two parents, or a parent and children: then every parent is its component's smallest node."""
    roles = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return roles.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up > 0 and down > 0").isEmpty()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(u, v)`` edges of longs -> ``(id, component)`` for every node on an edge.

    ``component`` is the smallest id that can be reached; the result is a table of
    its own (see ``materialize``).  Self-loops and nulls
    are ignored as edges (a node that only has a self-loop has no row), repeated
    edges count once, an empty input gives an empty result.  Each round is
    written to the shared folder; only a yes or no comes back to the driver.  The
    rounds grow with the logarithm of the number of nodes, not the diameter.
    """
    now = edges.filter("u <> v").select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    now = materialize(_small_star(now), "cc")
    for _ in range(max_rounds):
        if _is_star(now):
            break
        now = materialize(_small_star(_large_star(now)), "cc", drop=(now,))
    else:
        raise RuntimeError("components did not converge")
    roots = now.select(F.col("v").alias("id")).distinct()
    out = materialize(now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots.select("id", F.col("id").alias("component"))), "component")
    discard(now)
    return out
