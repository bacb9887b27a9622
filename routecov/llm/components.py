"""Connected components by alternating large-star and small-star.

Large-star hangs every larger neighbour of a node on the smallest node that it
knows, small-star every smaller one; repeated, each component becomes a star
around its smallest node (Kiveris et al., "Connected Components in MapReduce
and Beyond").  A node's smallest neighbour comes from a partial aggregate and
is joined back, so a hub's edges are never gathered in one row, and the skewed
side of the join can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


#: Edges that one task takes at least; fewer are not spread over more tasks, however many partitions a shuffle has.
EDGES_PER_TASK = 1 << 15


def _both(x: str, y: str, u: str, v: str) -> Column:
    """Two rows (u, v) for each row: the pairs x and y of columns."""
    return F.inline(F.array(*[F.struct(F.col(a).alias(u), F.col(b).alias(v)) for a, b in (x, y)]))


def _large_star(edges: DataFrame) -> DataFrame:
    near = edges.select(_both("ab", "ba", "u", "v"))
    least = near.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return near.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(_both("vm", "um", "a", "b")).where("a != b")


def star_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the
    smallest node reachable.  Loops and nulls are dropped, repeated edges and
    either direction allowed; no edges give no rows.

    Edges never become more, so their first count bounds the tasks of every
    round: a small graph costs few tasks and the driver has few to keep account of."""
    edges = cut_lineage(edges.where("a != b").select("a", "b").distinct())
    tasks = 2 + edges.count() // EDGES_PER_TASK
    edges = edges.coalesce(tasks)
    mark = None
    for _ in range(max_rounds):
        hung = cut_lineage(_large_star(edges).coalesce(tasks))
        edges = cut_lineage(_small_star(hung).coalesce(tasks).distinct().coalesce(tasks))
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            return edges.select(_both("ab", "bb", "node", "component")).distinct().coalesce(tasks)
        mark = seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
