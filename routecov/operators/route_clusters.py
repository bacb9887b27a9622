"""Clusters of routes that run through mostly the same zones.

Two routes overlap when the Jaccard similarity of their zone sets reaches a
threshold; a cluster is a connected component of that relation.  Routes of one
zone set are one set of the join (``overlap.similar_sets``), so repeated and
reversed routes cost one comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecov.operators.components import connected_components
from routecov.operators.overlap import similar_sets
from routecov.operators.skew import skew_join
from routecov.session import cut_lineage


def zone_sets(path_freq: DataFrame, m: int = 1) -> DataFrame:
    """(id, items, first_path, routes, frequency): the distinct zone sets of
    the paths with at least ``m`` different zones; null zones do not count."""
    items = F.array_sort(F.array_distinct(F.filter("trip_path", lambda z: z.isNotNull())))
    return cut_lineage(
        path_freq.select(items.alias("items"), "trip_path", "frequency").where(F.size("items") >= max(1, m))
        .groupBy("items").agg(F.min("trip_path").alias("first_path"), F.count_distinct("trip_path").alias("routes"),
                              F.sum("frequency").cast("bigint").alias("frequency"))
        .withColumn("id", F.monotonically_increasing_id()))


def similar_routes(path_freq: DataFrame, percent: int = 75, m: int = 1) -> DataFrame:
    """(route, other, shared): pairs of zone sets that overlap, each named by
    the smallest of its paths, route < other."""
    sets = zone_sets(path_freq, m)
    names = sets.select(F.col("id"), F.col("first_path"))
    pairs = similar_sets(sets.select("id", "items"), percent)
    named = (pairs.join(names.select(F.col("id").alias("a"), F.col("first_path").alias("_a")), "a")
             .join(names.select(F.col("id").alias("b"), F.col("first_path").alias("_b")), "b"))
    return named.select(F.least("_a", "_b").alias("route"), F.greatest("_a", "_b").alias("other"), "shared")


def route_clusters(path_freq: DataFrame, percent: int = 75, m: int = 1) -> DataFrame:
    """(trip_path, cluster, cluster_routes, cluster_frequency), a row for
    each distinct path with at least ``m`` different zones.

    ``cluster`` is the smallest path of the cluster; the other two are its
    distinct paths and the sum of all frequencies in it.  A path without a
    similar one is its own cluster; null and empty paths have none."""
    sets = zone_sets(path_freq, m)
    links = cut_lineage(similar_sets(sets.select("id", "items"), percent).select(F.col("a").alias("src"), F.col("b").alias("dst")))
    labels = connected_components(links, sets.select(F.col("id").alias("node")))
    placed = cut_lineage(sets.join(labels, sets.id == labels.node).select("items", "first_path", "routes", "frequency", "component"))
    clusters = placed.groupBy("component").agg(
        F.min("first_path").alias("cluster"), F.sum("routes").alias("cluster_routes"),
        F.sum("frequency").alias("cluster_frequency"))
    # a cluster may hold most sets, a set most paths: split those
    named = skew_join(placed.select("items", "component"), clusters, ["component"]).drop("component")
    paths = (path_freq.select(F.col("trip_path")).where(F.col("trip_path").isNotNull()).distinct()
             .withColumn("items", F.array_sort(F.array_distinct(F.filter("trip_path", lambda z: z.isNotNull())))))
    return (skew_join(paths, cut_lineage(named), ["items"])
            .select("trip_path", "cluster", F.col("cluster_routes").cast("bigint").alias("cluster_routes"),
                    F.col("cluster_frequency").cast("bigint").alias("cluster_frequency")))
