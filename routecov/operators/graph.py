"""The zone graph as DataFrames: an edge table ``(src, dst, weight)``.

The reference keeps an in-memory adjacency map on the driver and ships it as
a broadcast variable; here the graph is a table, so building, extending and
querying it are ordinary Spark jobs and its size is never a driver limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecov import schemas
from routecov.functions.geo import haversine_m
from routecov.operators.sizing import broadcast_if_small


def neighbor_distance(pairs: DataFrame, centroids: DataFrame) -> DataFrame:
    """(location_id, neighbor_location_id) -> + distance (int metres)
    between the two zone centroids; two equi-joins on the centroid table."""
    centroids = broadcast_if_small(centroids)
    start = centroids.select(F.col("location_id").alias("_s"),
                             F.col("avg_lat").alias("_slat"), F.col("avg_lon").alias("_slon"))
    end = centroids.select(F.col("location_id").alias("_e"),
                           F.col("avg_lat").alias("_elat"), F.col("avg_lon").alias("_elon"))
    return (pairs.join(start, pairs.location_id == start._s)
            .join(end, pairs.neighbor_location_id == end._e)
            .select(F.col("location_id").cast("bigint").alias("location_id"),
                    F.col("neighbor_location_id").cast("bigint").alias("neighbor_location_id"),
                    haversine_m("_slat", "_slon", "_elat", "_elon").alias("distance")))


def missing_centroids(pairs: DataFrame, centroids: DataFrame) -> DataFrame:
    """Zones named by the neighbour relation but without a centroid (the
    reference fails on these; here they are reported)."""
    ends = (pairs.select(F.col("location_id").alias("zone"))
            .union(pairs.select(F.col("neighbor_location_id").alias("zone"))).distinct())
    return ends.join(centroids, ends.zone == centroids.location_id, "left_anti")


def build_graph(neighbor_dist: DataFrame) -> DataFrame:
    """Neighbour-distance rows -> edge table (src, dst, weight)."""
    return neighbor_dist.select(F.col("location_id").cast("bigint").alias("src"),
                                F.col("neighbor_location_id").cast("bigint").alias("dst"),
                                F.col("distance").cast("bigint").alias("weight"))


def empty_graph(spark: SparkSession) -> DataFrame:
    """Zero-row edge table with the declared schema."""
    return spark.createDataFrame([], schemas.EDGE)


def nodes(edges: DataFrame, extra_nodes: DataFrame | None = None) -> DataFrame:
    """nodes = edge sources (adjacency keys), plus optional listed nodes."""
    n = edges.select(F.col("src").alias("node"))
    if extra_nodes is not None:
        n = n.union(extra_nodes.select(F.col("node").cast("bigint")))
    return n.distinct()


def edge_list(edges: DataFrame, weighted: bool = True) -> DataFrame:
    """All edges."""
    return edges.select("src", "dst", "weight") if weighted else edges.select("src", "dst")


def neighbours(edges: DataFrame, node: int, with_weights: bool = False) -> DataFrame:
    """Out-neighbours of one node (empty for an unknown node)."""
    sel = ["dst", "weight"] if with_weights else ["dst"]
    return edges.where(F.col("src") == F.lit(node).cast("bigint")).select(*sel)


def add_edges(edges: DataFrame, new_edges: DataFrame, default_weight: int = 0) -> DataFrame:
    """Graph with extra edges; missing weight defaults to 0.  Re-adding an
    existing (src, dst) replaces its weight by the new one."""
    if "weight" not in new_edges.columns:
        new_edges = new_edges.withColumn("weight", F.lit(default_weight))
    new = new_edges.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint"),
                           F.coalesce(F.col("weight").cast("bigint"), F.lit(default_weight).cast("bigint"))
                           .alias("weight"))
    kept = edges.join(new.select("src", "dst"), ["src", "dst"], "left_anti")
    return kept.select("src", "dst", "weight").unionByName(new)


def undirected(edges: DataFrame) -> DataFrame:
    """Every edge in both directions (one row per ordered pair; if the two
    directions carry different weights the smaller one is kept)."""
    both = edges.select("src", "dst", "weight").union(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return both.groupBy("src", "dst").agg(F.min("weight").alias("weight"))


def from_adjacency(adjacency: DataFrame) -> DataFrame:
    """Adjacency view (src, neighbours array<struct<dst,weight>>) -> edges."""
    return (adjacency.select("src", F.explode("neighbours").alias("e"))
            .select(F.col("src").cast("bigint"), F.col("e.dst").cast("bigint").alias("dst"),
                    F.col("e.weight").cast("bigint").alias("weight")))


def adjacency(edges: DataFrame) -> DataFrame:
    """Adjacency list per node, neighbours sorted by id."""
    return edges.groupBy("src").agg(
        F.array_sort(F.collect_list(F.struct("dst", "weight"))).alias("neighbours"))


def graph_check(edges: DataFrame, zones: DataFrame) -> DataFrame:
    """One row: node count, zone count, whether they agree, and how many
    listed zones have no outgoing edge (isolated)."""
    n = nodes(edges)
    z = zones.select(F.col("location_id").cast("bigint").alias("node")).distinct()
    node_count = n.select(F.count(F.lit(1))).scalar()
    zone_count = z.select(F.count(F.lit(1))).scalar()
    iso = z.join(n, "node", "left_anti").select(F.count(F.lit(1))).scalar()
    return (edges.sparkSession.range(1)
            .select(node_count.alias("node_count"), zone_count.alias("zone_count"),
                    (node_count == zone_count).alias("counts_match"),
                    iso.alias("isolated_count")))

