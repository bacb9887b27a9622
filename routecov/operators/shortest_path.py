"""Deterministic weighted shortest paths as an iterative Spark job.

The reference runs a driver-style Dijkstra once per (pick-up, drop-off) row
inside executor tasks.  Here all sources advance together, one more edge a
round, and only what improved moves:

    state(source, node, cost, path, at)     a table bucketed by (source, node)
    round r: rows with at = r - 1  ⋈ edges -> candidates
             least (cost, path) per (source, node), shuffled to the buckets
             state ⟗ candidates in place -> the next version of the state

``cost`` is one number that orders by distance, then by the number of edges:
each edge costs weight * S + 1, S being above any number of edges on a path.
Among equal costs the smaller id sequence wins.  A row that improves in round r
has r edges, so all candidates of one cost meet in one round and the order
(dist, hops, path) is total: the result does not depend on partitioning or
arrival order.  A state of more than ``BUCKET_ROWS`` rows never goes through a
shuffle: it is joined where it lies and written from the same tasks.  With non-negative weights the loop stops
after (most edges of a best path + 1) rounds; some rounds share one write, and
the loop ends when the last of them improved no row (observed during the write).  Each version is a table in the
shared scratch folder, so a lost executor repeats part of one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from routecov.operators.sizing import BROADCAST_MAX_ROWS
from routecov.operators.skew import heavy_keys, shuffle_tasks, skew_join
from routecov.session import cut_lineage
from routecov.sinks.bucketed import Rounds

_LONG = 1 << 62
#: A state of at most so many rows is one bucket.  Spark deals sides of fewer
#: buckets than shuffle partitions anew, so any larger state has as many as those.
BUCKET_ROWS = 500_000


def _costed(edges: DataFrame) -> tuple[DataFrame, int, str, int, int]:
    """Edges (src, dst, step), the factor S, the type of costs, and the numbers of edges and nodes reached."""
    e = cut_lineage(edges.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"),
                                 F.col("weight").cast("bigint").alias("weight")))
    # one pass over the materialised edges: weight check, bounds of a path and size proof together
    seen = e.agg(F.min("weight").alias("least"), F.max("weight").alias("most"), F.count(F.lit(1)).alias("rows"),
                 F.count_distinct("dst").alias("nodes")).first()
    if seen["least"] is not None and seen["least"] < 0:
        raise ValueError("shortest_paths needs non-negative edge weights")
    factor = 1 << (seen["nodes"] + 1).bit_length()  # a best path enters no node twice
    fits = ((seen["most"] or 0) * (seen["nodes"] + 1) + 1) * factor < _LONG
    kind = "bigint" if fits else "decimal(38,0)"
    costed = e.where("weight is not null").select(
        "src", "dst", (F.col("weight").cast(kind) * F.lit(factor).cast(kind) + F.lit(1).cast(kind)).cast(kind).alias("step"))
    return costed, factor, kind, seen["rows"], seen["nodes"]


def shortest_paths(edges: DataFrame, sources: DataFrame, source_col: str = "source",
                   max_rounds: int = 100_000, max_dist: int | None = None, rounds_a_write: int = 2) -> DataFrame:
    """N8+N9: best path from every listed source to every reachable node.

    Returns (source, node, dist, hops, path array<bigint>); the source itself
    is included with dist 0.  Unreachable nodes have no row (the reference
    returns a one-element path there, see SURVEY Q3).  ``max_dist`` bounds the
    state on large graphs: nodes farther than it from a source get no row.

    A small edge table is broadcast; beyond the bound frontier and edges are
    joined by a shuffle of both, nodes with very many edges split."""
    e, factor, kind, n_edges, n_nodes = _costed(edges)
    small, hubs = n_edges <= BROADCAST_MAX_ROWS, None  # three numbers a row
    if small:
        e = F.broadcast(e)
    else:
        hubs = heavy_keys(e, ["src"])
    seed = (sources.select(F.col(source_col).cast("bigint").alias("source"))
            .where(F.col("source").isNotNull()).distinct())
    n_rows = seed.count() * (n_nodes + 1)
    rounds = Rounds(seed.sparkSession, "shortest_paths", ["source", "node"], 1 if n_rows <= BUCKET_ROWS else shuffle_tasks(seed))
    state = rounds.put(seed.select("source", F.col("source").alias("node"), F.lit(0).cast(kind).alias("cost"),
                                   F.array("source").alias("path"), F.lit(0).alias("at")), dealt=False)
    r = 0
    while r < max_rounds:
        for _ in range(max(1, rounds_a_write)):
            r += 1
            frontier = state.where(F.col("at") == r - 1).select("source", F.col("node").alias("src"), "cost", "path")
            reached = frontier.join(e, "src") if small else skew_join(e, frontier, ["src"], heavy=hubs)
            reached = reached.select("source", F.col("dst").alias("node"), (F.col("cost") + F.col("step")).cast(kind).alias("cost"),
                                     F.concat("path", F.array("dst")).alias("path"))
            if max_dist is not None:
                reached = reached.where(F.expr(f"cost div {factor}") <= max_dist)
            found = reached.groupBy("source", "node").agg(F.min(F.struct("cost", "path")).alias("_new"))
            better = F.col("_new").isNotNull() & (F.col("cost").isNull() | (F.col("_new.cost") < F.col("cost")))
            state = (state.join(found, ["source", "node"], "full_outer")
                     .select("source", "node", *[F.when(better, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in ("cost", "path")],
                             F.when(better, F.lit(r)).otherwise(F.col("at")).alias("at")))
        seen = Observation()
        state = rounds.put(state.observe(seen, F.count(F.when(F.col("at") == r, 1)).alias("improved")))
        if not seen.get["improved"]:
            break
    else:
        raise RuntimeError(f"shortest_paths did not converge in {max_rounds} rounds")

    return rounds.last().select("source", "node", F.expr(f"cast(cost div {factor} as bigint)").alias("dist"),
                                F.expr(f"cast(cost % {factor} as int)").alias("hops"), "path")


def path_frequency(freq: DataFrame, edges: DataFrame) -> DataFrame:
    """Trip frequency per pair -> (trip_path, frequency), see ``path_frequency_and_rest``."""
    return path_frequency_and_rest(freq, edges)[0]


def path_frequency_and_rest(freq: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trip frequency per pair -> (trip_path, frequency), and the pairs without a path.

    Same-zone pairs are skipped; shortest paths run once per distinct pick-up
    zone (not once per pair); pairs without a path (pu_location_id,
    do_location_id, frequency) come apart, so their trips can be counted.  The pair table (at most zones² rows) is
    materialised once, so the trip aggregation is not recomputed for the
    final join."""
    pairs = cut_lineage(freq.where(F.col("pu_location_id") != F.col("do_location_id"))
                        .select("pu_location_id", "do_location_id", "frequency"))
    sp = shortest_paths(edges, pairs.select(F.col("pu_location_id").alias("source")))
    found = (pairs.join(sp, (pairs.pu_location_id == sp.source) & (pairs.do_location_id == sp.node))
             .select(F.col("path").alias("trip_path"), F.col("frequency").cast("bigint").alias("frequency")))
    return found, unreachable_pairs(pairs, sp)


def unreachable_pairs(freq: DataFrame, paths: DataFrame) -> DataFrame:
    """Trip pairs that have no path in ``paths`` (output of ``shortest_paths``)."""
    pairs = freq.where(F.col("pu_location_id") != F.col("do_location_id"))
    return pairs.join(paths, (pairs.pu_location_id == paths.source) & (pairs.do_location_id == paths.node),
                      "left_anti")
