"""Connected components (the reference's union-find) by contraction.

Each round every node that still has edges picks its neighbour of least
priority (a hash of the id that changes with the round).  Following picks leads
to ever smaller priorities, so they end in pairs that pick each other.  A node
moves to its pick's pick, the two of such a pair to the smaller id of both, and
the graph is contracted along these moves: an edge becomes one between the
places its ends moved to and goes if they agree.  Hubs vanish in a round or
two, chains lose more than half of their nodes each round, so only the
remaining edges move, in about log2(nodes) rounds at most.  The moves of the
rounds are then put together backwards, smallest round first, and each
component is named by its smallest node id.

A component table can also be kept and extended: ``union`` contracts the new
edges to the labels of their ends, finds the components of those few labels,
and changes only the rows whose label went.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecov.operators.sizing import BROADCAST_MAX_ROWS, is_small
from routecov.operators.skew import skew_join
from routecov.session import cut_lineage


def _look_up(rows: DataFrame, table: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Rows joined to a materialised table of one row a key: broadcast once
    proven small (two numbers a row), else hot keys of ``rows`` split."""
    if is_small(table, BROADCAST_MAX_ROWS):
        return rows.join(F.broadcast(table), on, how)
    return skew_join(rows, table, on, how)


def _undirected(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    a, b = F.col(src).cast("bigint"), F.col(dst).cast("bigint")
    return edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where((a != b)).distinct()


def connected_components(edges: DataFrame, nodes: DataFrame | None = None, max_rounds: int = 500) -> DataFrame:
    """(node, component) with component = smallest node id of the
    undirected component; ``nodes`` adds edge-less nodes.  Edges with a null
    end connect nothing; their other end is no node by that."""
    ends = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    named = ends.select(F.col("src").cast("bigint").alias("node")).union(ends.select(F.col("dst").cast("bigint")))
    if nodes is not None:
        named = named.union(nodes.select(F.col("node").cast("bigint")).where("node is not null"))
    left = cut_lineage(_undirected(ends))
    picks: list[DataFrame] = []
    for r in range(max_rounds):
        if left.isEmpty():
            break
        near = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut_lineage(near.groupBy(F.col("a").alias("node")).agg(F.min_by("b", F.xxhash64("b", F.lit(r))).alias("next")))
        after = least.select(F.col("node").alias("next"), F.col("next").alias("_after"))
        pick = cut_lineage(_look_up(least, after, ["next"]).select(
            "node", F.when(F.col("_after") == F.col("node"), F.least("node", "next")).otherwise(F.col("_after")).alias("pick")))
        picks.append(pick)
        moved = _look_up(left, pick.select(F.col("node").alias("a"), F.col("pick").alias("pa")), ["a"])
        moved = _look_up(moved, pick.select(F.col("node").alias("b"), F.col("pick").alias("pb")), ["b"])
        left = cut_lineage(_undirected(moved, "pa", "pb"))
    else:
        raise RuntimeError(f"connected_components did not end in {max_rounds} rounds")
    if not picks:
        return named.distinct().select("node", F.col("node").alias("component"))
    root = picks[-1]
    for pick in reversed(picks[:-1]):
        higher = root.select(F.col("node").alias("pick"), F.col("pick").alias("_root"))
        root = cut_lineage(_look_up(pick, higher, ["pick"], "left").select("node", F.coalesce("_root", "pick").alias("pick")))
    smallest = cut_lineage(root.groupBy("pick").agg(F.min("node").alias("component")))
    labels = _look_up(root, smallest, ["pick"]).select("node", "component")
    alone = named.distinct().join(labels, "node", "left_anti").select("node", F.col("node").alias("component"))
    return labels.unionByName(alone)


def find(components: DataFrame, nodes: DataFrame) -> DataFrame:
    """``find`` for a table of nodes: (node, component), one row each; a node
    that the components do not hold is a class of its own."""
    asked = nodes.select(F.col("node").cast("bigint")).where("node is not null").distinct()
    return (asked.join(components.select("node", "component"), "node", "left")
            .select("node", F.coalesce("component", "node").alias("component")))


def union(components: DataFrame, new_edges: DataFrame) -> DataFrame:
    """``union`` for a table of edges (src, dst): the components with these
    edges added; ends that were not there come in.

    Equal to ``connected_components`` over all edges so far when ``components``
    came from it, but the work follows the new edges: they are contracted to
    the labels of their ends, and only labels that change meet the rows."""
    known = components.select("node", "component")
    ends = new_edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select(
        F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"))
    named = ends.select(F.col("src").alias("node")).union(ends.select(F.col("dst").alias("node"))).distinct()
    found = cut_lineage(find(known, named))
    at = [found.select(F.col("node").alias(end), F.col("component").alias(f"_{end}")) for end in ("src", "dst")]
    labels = _look_up(_look_up(ends, at[0], ["src"]), at[1], ["dst"]).select(F.col("_src").alias("src"), F.col("_dst").alias("dst"))
    merged = connected_components(labels.distinct())
    changed = cut_lineage(merged.where("node != component").select(F.col("node").alias("component"), F.col("component").alias("_now")))
    new = found.join(known, "node", "left_anti")
    if changed.isEmpty():
        return known.unionByName(new)
    rows = known.unionByName(new)
    return _look_up(rows, changed, ["component"], "left").select("node", F.coalesce("_now", "component").alias("component"))


def component_sizes(components: DataFrame) -> DataFrame:
    """(component, size)."""
    return components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
