"""Shared building blocks of the registered queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecov.operators import frequency as fq
from routecov.operators import graph as gr
from routecov.operators import shortest_path as sp
from routecov.operators.sizing import broadcast_if_small
from routecov.sources import testdata as td


def neighbor_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 over the fixture: neighbour pairs + haversine of centroids."""
    return gr.neighbor_distance(td.neighbor_pairs(spark, sf_dir), td.centroids(spark, sf_dir))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighted zone graph."""
    return gr.build_graph(neighbor_distance(spark, sf_dir))


def graph_zones(spark: SparkSession, sf_dir: str, e: DataFrame | None = None) -> DataFrame:
    e = edges(spark, sf_dir) if e is None else e
    return gr.nodes(e).select(F.col("node").alias("location_id"))


def trip_frequency(spark: SparkSession, sf_dir: str, e: DataFrame | None = None) -> DataFrame:
    """A1 as the pipeline runs it: both ends graph nodes, none isolated."""
    return fq.trip_frequency(td.trips(spark, sf_dir), zones=graph_zones(spark, sf_dir, e),
                             isolated=td.isolated_zones(spark, sf_dir))


def path_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N10 over the pipeline's trip frequency (the edge table is built once)."""
    e = edges(spark, sf_dir)
    return sp.path_frequency(trip_frequency(spark, sf_dir, e), e)


def edges_in_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph restricted to edges whose ends share a borough (region):
    five separate components, so most zone pairs are unreachable."""
    z = broadcast_if_small(td.zones(spark, sf_dir).select("location_id", "borough"))
    a = z.select(F.col("location_id").alias("_a"), F.col("borough").alias("_ba"))
    b = z.select(F.col("location_id").alias("_b"), F.col("borough").alias("_bb"))
    e = edges(spark, sf_dir)
    return (e.join(a, e.src == a._a).join(b, e.dst == b._b)
            .where(F.col("_ba") == F.col("_bb")).select("src", "dst", "weight"))


def parsed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 over the fixture polygons."""
    from routecov.operators.zones import parse_zones
    return parse_zones(td.raw_zone_polygons(spark, sf_dir))


def pair_frequency_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 without zone filters (every trip pair)."""
    return fq.trip_frequency(td.trips(spark, sf_dir))
