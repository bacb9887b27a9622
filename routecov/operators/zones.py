"""Zone polygons, centroids, boundary statistics and the zone lookup.

Polygon text is parsed with column expressions (regexp + nested
``transform(split(...))``); each row is independent, so parsing is a narrow
map over the input partitions with no shuffle and no UDF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routecov.functions.geo import boundary_is_valid, multipolygon_body, parse_multipolygon, ring_mean
from routecov.operators.sizing import BROADCAST_MAX_ROWS, is_small
from routecov.operators.skew import skew_join
from routecov.session import cut_lineage

_BOROUGH_TEXT = r"^[a-zA-Z ]+$"


def _parsed(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("borough"), F.col("LocationID").alias("_id"), F.col("the_geom"),
                      parse_multipolygon("the_geom").alias("boundary"))


def _accepted() -> F.Column:
    return ((F.col("_id") >= 1) & F.col("borough").rlike(_BOROUGH_TEXT)
            & (multipolygon_body("the_geom") != "") & boundary_is_valid("boundary"))


def parse_zones(raw: DataFrame) -> DataFrame:
    """G1: raw (the_geom, LocationID, borough) -> (borough, location_id,
    boundary array<array<struct<x,y>>>), largest sub-region first."""
    return (_parsed(raw).where(_accepted())
            .select("borough", F.col("_id").cast("bigint").alias("location_id"), "boundary"))


def rejected_zones(raw: DataFrame) -> DataFrame:
    """Rows ``parse_zones`` does not accept (bad id, borough or polygon text)."""
    return (_parsed(raw).where(~F.coalesce(_accepted(), F.lit(False)))
            .select("the_geom", F.col("_id").alias("LocationID"), "borough"))


def zone_centroids(zones: DataFrame, axis_order: str = "xy") -> DataFrame:
    """Centroid approximation = mean vertex of the largest sub-region.

    ``axis_order='xy'`` reads WKT as (longitude, latitude); ``'yx'`` reads the
    first coordinate as latitude, as the reference does (SURVEY Q7)."""
    if axis_order not in ("xy", "yx"):
        raise ValueError("axis_order must be 'xy' or 'yx'")
    lat_axis, lon_axis = ("y", "x") if axis_order == "xy" else ("x", "y")
    ring = F.col("boundary")[0]
    return zones.select("borough", "location_id",
                        ring_mean(ring, lat_axis).alias("avg_lat"),
                        ring_mean(ring, lon_axis).alias("avg_lon"))


def boundary_stats(zones: DataFrame) -> DataFrame:
    """Per zone: total vertices, sub-region count, largest sub-region
    size, and the sub-region sizes joined by spaces."""
    sizes = F.transform("boundary", lambda r: F.size(r))
    return zones.select(
        "borough", "location_id",
        F.aggregate(sizes, F.lit(0), lambda acc, n: acc + n).alias("total_coordinate_count"),
        F.size("boundary").alias("total_sub_region_count"),
        F.array_max(sizes).alias("max_sub_region_coordinate_count"),
        F.array_join(F.transform(sizes, lambda n: n.cast("string")), " ").alias("sub_region_coordinate_counts"))


def zones_per_borough(zones: DataFrame) -> DataFrame:
    """A5: (borough, location_count)."""
    return zones.groupBy("borough").agg(F.count(F.lit(1)).alias("location_count"))


def clean_zone_lookup(raw: DataFrame) -> DataFrame:
    """Zone lookup cleaning: drop service_zone (P5), rename (P2), cast (P4),
    drop the 'Unknown' borough (F12)."""
    return (raw.drop("service_zone")
            .select(F.col("LocationID").cast("bigint").alias("location_id"),
                    F.col("Zone").alias("zone"), F.col("Borough").alias("borough"))
            .where(F.col("borough") != "Unknown"))


def borough_zone_lists(zone_ids: DataFrame, boroughs: DataFrame) -> DataFrame:
    """(borough, location_ids) with the ids of each borough sorted and
    comma-joined; boroughs without ids keep an empty string.  The per-borough
    list is bounded by the number of zones in a borough."""
    lists = (zone_ids.groupBy("borough")
             .agg(F.array_join(F.sort_array(F.collect_set(F.col("location_id").cast("bigint"))), ",")
                  .alias("location_ids")))
    all_b = boroughs.select("borough").distinct()
    return (all_b.join(lists, "borough", "left")
            .select("borough", F.coalesce("location_ids", F.lit("")).alias("location_ids")))


def zone_points(zones: DataFrame) -> DataFrame:
    """Distinct (location_id, x, y) over all rings of every zone."""
    return (zones.select("location_id", F.explode(F.flatten("boundary")).alias("p"))
            .select("location_id", F.col("p.x").alias("x"), F.col("p.y").alias("y")).distinct())


def shared_point_neighbours(zones: DataFrame, min_shared: int = 2) -> DataFrame:
    """Zones whose boundaries share at least ``min_shared`` identical
    points, both directions: (location_id, neighbor_location_id).

    A zone's points are ordered by the number of zones they belong to, rarest
    first.  Two zones that share ``min_shared`` points share one that is not
    among the last ``min_shared - 1`` of either, so only those points are
    joined: a point that thousands of zones share is the last of each and pairs
    nobody.  Shared points among the last ones are then looked up for the pairs
    found, by (zone, point), which is unique."""
    if min_shared < 1:
        raise ValueError("min_shared must be at least 1")
    inc = cut_lineage(zone_points(zones))
    degree = cut_lineage(inc.groupBy("x", "y").agg(F.count(F.lit(1)).alias("_deg")))
    if is_small(degree, BROADCAST_MAX_ROWS):
        ranked = inc.join(F.broadcast(degree), ["x", "y"])  # three numbers a row
    else:
        ranked = skew_join(inc, degree, ["x", "y"])
    own = Window.partitionBy("location_id").orderBy(F.desc("_deg"), "x", "y")
    ranked = cut_lineage(ranked.withColumn("_last", F.row_number().over(own) < min_shared).select("location_id", "x", "y", "_last"))
    head, tail = ranked.where("not _last").drop("_last"), ranked.where("_last").drop("_last")
    a, b = (head.select(F.col("location_id").alias(z), "x", "y") for z in ("a", "b"))
    pairs = cut_lineage(a.join(b, ["x", "y"]).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
    few = pairs.where(F.col("n") < min_shared).select("a", "b")

    def among_last(one: str, other: str, points: DataFrame) -> DataFrame:
        """Points among the last of ``one`` that are ``points`` of ``other``."""
        asked = few.join(tail.withColumnRenamed("location_id", one), one)
        return asked.join(points.withColumnRenamed("location_id", other), [other, "x", "y"], "left_semi").select("a", "b", F.lit(1).alias("n"))

    # the last of a against all of b, the last of b against the others of a: no point twice
    counts = (pairs.select("a", "b", "n").unionByName(among_last("a", "b", ranked.drop("_last"))).unionByName(among_last("b", "a", head))
              .groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= min_shared))
    return (counts.select(F.col("a").alias("location_id"), F.col("b").alias("neighbor_location_id"))
            .union(counts.select(F.col("b").alias("location_id"), F.col("a").alias("neighbor_location_id"))))
