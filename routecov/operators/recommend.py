"""Route recommendation: top-k paths, human-readable names, coverage share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecov.functions.paths import short_zone_name
from routecov.operators.coverage import SUBSEQUENCE, contained_pairs, unique_paths
from routecov.operators.sizing import broadcast_if_small
from routecov.session import cut_lineage


def top_k_paths(coverage: DataFrame, k: int, m: int) -> DataFrame:
    """The k paths with at least m stops and the highest coverage count.

    Total order (coverage desc, length desc, path asc) makes the cut at k
    deterministic; Spark plans ``orderBy().limit()`` as TakeOrderedAndProject
    (a per-partition top-k, then a merge of k rows per partition)."""
    return (coverage.where(F.size("trip_path") >= m)
            .orderBy(F.desc("coverage_count"), F.desc(F.size("trip_path")), F.asc("trip_path"))
            .limit(k))


def zone_names(lookup: DataFrame, short_names: bool = True) -> DataFrame:
    """(location_id, name) from a lookup (location_id, zone); with
    ``short_names`` the text before the first '/' is kept."""
    name = short_zone_name("zone") if short_names else F.col("zone")
    return lookup.select(F.col("location_id").cast("bigint").alias("location_id"), name.alias("name"))


def readable_paths(df: DataFrame, names: DataFrame, path_col: str = "trip_path",
                   missing: str = "NA", sep: str = ",") -> DataFrame:
    """Add ``route`` = the path's zone names in path order, ``missing``
    for ids without a name.

    Distinct paths are exploded with their positions, left-joined to the
    names, and re-assembled in position order; the result joins back on the
    path.  No UDF and no driver-side map."""
    names = broadcast_if_small(names)
    paths = df.select(F.col(path_col).alias("_p")).distinct()
    stops = paths.select("_p", F.posexplode("_p").alias("_pos", "_id"))
    named = (stops.join(names, stops._id == names.location_id, "left")
             .select("_p", "_pos", F.coalesce(F.col("name"), F.lit(missing)).alias("_name")))
    routes = (named.groupBy("_p")
              .agg(F.array_sort(F.collect_list(F.struct("_pos", "_name"))).alias("_stops"))
              .select("_p", F.array_join(F.transform("_stops", lambda s: s["_name"]), sep).alias("route")))
    return df.join(routes, df[path_col] == routes._p).drop("_p")


def top_k_routes(coverage: DataFrame, lookup: DataFrame, k: int, m: int,
                 short_names: bool = True) -> DataFrame:
    """Top-k paths as human-readable routes (route, coverage_count, trip_path).

    The top-k table (at most k rows) is checkpointed once: the route
    assembly reads it twice, and it sits on top of the whole coverage job."""
    top = cut_lineage(top_k_paths(coverage, k, m))
    return readable_paths(top, zone_names(lookup, short_names)).select("route", "coverage_count", "trip_path")


def coverage_percentage(routes: DataFrame, path_freq: DataFrame, unreachable: DataFrame | None = None) -> DataFrame:
    """R2: coverage_percentage = round(coverage_count / total * 100, 2), total
    = sum of all path frequencies (a scalar subquery, evaluated once) and, if
    given, of the trips (frequency) of pairs without a path."""
    counted = path_freq.select("frequency")
    if unreachable is not None:
        counted = counted.union(unreachable.select("frequency"))
    total = counted.select(F.sum("frequency")).scalar()
    return routes.withColumn(
        "coverage_percentage", F.round(F.try_divide(F.col("coverage_count"), total) * 100.0, 2))


def overall_coverage(chosen: DataFrame, path_freq: DataFrame,
                     containment: str = SUBSEQUENCE) -> DataFrame:
    """One row: trips whose path lies inside at least one chosen route,
    all trips, and the percentage."""
    pairs = contained_pairs(path_freq, containment, chosen.select("trip_path").distinct())
    covered = pairs.select("child", "frequency").distinct()
    covered_trips = covered.select(F.coalesce(F.sum("frequency"), F.lit(0)).cast("bigint")).scalar()
    total = unique_paths(path_freq).select(F.coalesce(F.sum("frequency"), F.lit(0)).cast("bigint")).scalar()
    return (path_freq.sparkSession.range(1)
            .select(covered_trips.alias("covered_trips"), total.alias("total_trips"),
                    F.round(F.try_divide(covered_trips * 100.0, total), 2).alias("coverage_percentage")))
