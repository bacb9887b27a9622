"""

Each query takes (spark, sf_dir) and returns a DataFrame whose columns match
the twin in ``routecov.plans.oracle``; paths and lists are emitted as
comma-joined text so both engines hash them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecov.functions.geo import haversine_km
from routecov.functions.paths import path_text, short_zone_name
from routecov.operators import clean as cl
from routecov.operators import components as comp
from routecov.operators import coverage as cov
from routecov.operators import file_moments as fm
from routecov.operators import frequency as fq
from routecov.operators import graph as gr
from routecov.operators import profile as pf
from routecov.operators import recommend as rec
from routecov.operators import route_clusters as rc
from routecov.operators import shortest_path as sp
from routecov.operators import zones as zn
from routecov import schemas
from routecov.plans import fixture_plans as fx
from routecov.session import cut_lineage, scratch_path
from routecov.sinks import bucketed as bk
from routecov.sinks import writers as wr
from routecov.sources import drift as dr
from routecov.sources import readers as rd
from routecov.plans.pipeline import recommend_routes
from routecov.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def _text(df: DataFrame, col: str = "trip_path") -> DataFrame:
    return df.withColumn(col, path_text(col))


# --- aggregations -----------------------------------------------------------

@query("a1_trip_frequency")
def a1_trip_frequency(spark, sf):
    return fx.trip_frequency(spark, sf)


@query("a3_from_zone_distribution")
def a3_from_zone_distribution(spark, sf):
    return fq.from_zone_distribution(fx.trip_frequency(spark, sf))


# --- graph / paths ----------------------------------------------------------

@query("n10_path_frequency")
def n10_path_frequency(spark, sf):
    return _text(fx.path_frequency(spark, sf))


@query("a9_coverage_count")
def a9_coverage_count(spark, sf):
    return _text(cov.coverage_count(fx.path_frequency(spark, sf)))


# --- recommendation ---------------------------------------------------------

@query("r6_route_recommendation")
def r6_route_recommendation(spark, sf):
    report = recommend_routes(td.trips(spark, sf), fx.edges(spark, sf), td.zones(spark, sf),
                              isolated=td.isolated_zones(spark, sf))
    return _text(report.route_percentage)


def _round(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round float aggregates whose last bits depend on summation order."""
    for c in cols:
        df = df.withColumn(c, F.round(c, digits))
    return df


def _paths_text(col: str, sep: str = ";"):
    return F.array_join(F.transform(col, lambda p: F.array_join(p, ",")), sep)


# --- aggregations and profiles ---------------------------------------------

@query("a2_same_zone_distribution")
def a2_same_zone_distribution(spark, sf):
    return fq.same_zone_distribution(fx.trip_frequency(spark, sf))


@query("a4_to_zone_distribution")
def a4_to_zone_distribution(spark, sf):
    return fq.to_zone_distribution(fx.trip_frequency(spark, sf))


@query("a5_zones_per_borough")
def a5_zones_per_borough(spark, sf):
    return zn.zones_per_borough(fx.parsed_zones(spark, sf))


@query("a6_mean_stddev")
def a6_mean_stddev(spark, sf):
    return _round(pf.mean_stddev(td.outlier_values(spark, sf), "value"), "mean", "stddev")


@query("a7_total_trips")
def a7_total_trips(spark, sf):
    return fq.total_trips(fx.trip_frequency(spark, sf))


@query("a8_adjacency")
def a8_adjacency(spark, sf):
    adj = gr.adjacency(fx.edges(spark, sf))
    return adj.select("src", F.array_join(F.transform(
        "neighbours", lambda n: F.concat_ws(":", n.dst.cast("string"), n.weight.cast("string"))), ",")
        .alias("neighbours"))


@query("a10_covered_sub_paths")
def a10_covered_sub_paths(spark, sf):
    return (cov.covered_sub_paths(fx.path_frequency(spark, sf))
            .select(path_text("trip_path").alias("trip_path"), _paths_text("sub_paths").alias("sub_paths")))


@query("a11_distinct_pickup_zones")
def a11_distinct_pickup_zones(spark, sf):
    return pf.distinct_values(td.trips(spark, sf), "pu_location_id")


@query("a12_column_summary")
def a12_column_summary(spark, sf):
    return _round(pf.column_summary(td.metered_trips(spark, sf), "passenger_count"), "mean", "stddev")


@query("a12_column_percentiles")
def a12_column_percentiles(spark, sf):
    return pf.exact_percentiles(td.metered_trips(spark, sf), "passenger_count")


@query("a12_column_percentiles_approx")
def a12_column_percentiles_approx(spark, sf):
    """Approximate quartiles (Spark's sketch): no SQL twin, rows-only check;
    tests bound the rank error against exact quartiles."""
    return pf.column_percentiles(td.metered_trips(spark, sf), "passenger_count")


@query("a13_top_pickup_zones")
def a13_top_pickup_zones(spark, sf):
    return pf.top_value_counts(cl.clean_metered_trips(td.metered_trips(spark, sf)), "pulocationID", 5)


@query("a14_top_undirected_route")
def a14_top_undirected_route(spark, sf):
    top = pf.top_undirected_routes(cl.clean_metered_trips(td.metered_trips(spark, sf)))
    return top.withColumn("trip_route", path_text("trip_route"))


@query("a15_boundary_stats")
def a15_boundary_stats(spark, sf):
    return zn.boundary_stats(fx.parsed_zones(spark, sf))


@query("a16_row_count")
def a16_row_count(spark, sf):
    return pf.row_count(td.trips(spark, sf))


# --- geospatial -------------------------------------------------------------

def _boundary_text(col: str = "boundary"):
    return F.array_join(F.transform(col, lambda ring: F.array_join(F.transform(
        ring, lambda p: F.concat_ws(" ", p.x.cast("bigint").cast("string"), p.y.cast("bigint").cast("string"))),
        ",")), ";")


@query("g1_parse_zones")
def g1_parse_zones(spark, sf):
    z = fx.parsed_zones(spark, sf)
    return z.select("borough", "location_id", _boundary_text().alias("boundary"))


@query("g6_shared_point_neighbours")
def g6_shared_point_neighbours(spark, sf):
    """Neighbours derived from two shared boundary points on the grid polygons,
    a third of which also share one common point."""
    return zn.shared_point_neighbours(zn.parse_zones(td.grid_zone_polygons(spark, sf)), min_shared=2)


@query("g6_shared_point_neighbours_default")
def g6_shared_point_neighbours_default(spark, sf):
    """The same with the default number of points."""
    return zn.shared_point_neighbours(zn.parse_zones(td.grid_zone_polygons(spark, sf)))


@query("g1_rejected_zones")
def g1_rejected_zones(spark, sf):
    return zn.rejected_zones(td.raw_zone_polygons(spark, sf)).select("LocationID", "borough")


@query("g2_zone_centroids")
def g2_zone_centroids(spark, sf):
    return zn.zone_centroids(fx.parsed_zones(spark, sf))


@query("g5_neighbor_distance")
def g5_neighbor_distance(spark, sf):
    return fx.neighbor_distance(spark, sf)


@query("g4_distance_km")
def g4_distance_km(spark, sf):
    c = td.centroids(spark, sf)
    p = td.neighbor_pairs(spark, sf)
    a = c.select(F.col("location_id").alias("_a"), F.col("avg_lat").alias("lat1"), F.col("avg_lon").alias("lon1"))
    b = c.select(F.col("location_id").alias("_b"), F.col("avg_lat").alias("lat2"), F.col("avg_lon").alias("lon2"))
    return (p.join(a, p.location_id == a._a).join(b, p.neighbor_location_id == b._b)
            .select("location_id", "neighbor_location_id",
                    haversine_km("lat1", "lon1", "lat2", "lon2").alias("distance_km")))


# --- graph ------------------------------------------------------------------

@query("n1_graph_edges")
def n1_graph_edges(spark, sf):
    return gr.edge_list(fx.edges(spark, sf))


@query("n2_graph_nodes")
def n2_graph_nodes(spark, sf):
    return gr.nodes(fx.edges(spark, sf))


@query("n3_edge_pairs")
def n3_edge_pairs(spark, sf):
    return gr.edge_list(fx.edges(spark, sf), weighted=False)


@query("n4_neighbours")
def n4_neighbours(spark, sf):
    return gr.neighbours(fx.edges(spark, sf), 7, with_weights=True)


@query("n5_add_edges")
def n5_add_edges(spark, sf):
    new = td.isolated_zones(spark, sf).select(F.col("location_id").alias("src"), F.lit(0).alias("dst"))
    return gr.add_edges(fx.edges(spark, sf), new)


@query("n6_undirected")
def n6_undirected(spark, sf):
    return gr.undirected(fx.edges(spark, sf).where(F.col("src") < F.col("dst")))


@query("n7_from_adjacency")
def n7_from_adjacency(spark, sf):
    return gr.from_adjacency(gr.adjacency(fx.edges(spark, sf)))


@query("n8_shortest_paths")
def n8_shortest_paths(spark, sf):
    e = fx.edges(spark, sf)
    out = sp.shortest_paths(e, gr.nodes(e).select(F.col("node").alias("source")))
    return out.withColumn("path", path_text("path"))


@query("n9_unreachable_pairs")
def n9_unreachable_pairs(spark, sf):
    e = fx.edges_in_borough(spark, sf)
    freq = fx.pair_frequency_all(spark, sf)
    paths = sp.shortest_paths(e, freq.select(F.col("pu_location_id").alias("source")))
    return sp.unreachable_pairs(freq, paths)


@query("n11_connected_components")
def n11_connected_components(spark, sf):
    return comp.connected_components(fx.edges_in_borough(spark, sf))


@query("n11_find")
def n11_find(spark, sf):
    """The components of the trips' zones, of which some have no edge."""
    asked = td.trips(spark, sf).select((F.col("pu_location_id") * 2).alias("node"))
    return comp.find(comp.connected_components(fx.edges_in_borough(spark, sf)), asked)


@query("n11_union")
def n11_union(spark, sf):
    """Components of the edges within boroughs, extended by the pairs that most
    trips of a zone go to, where the zone's id is a multiple of 6."""
    kept = cut_lineage(comp.connected_components(fx.edges_in_borough(spark, sf)))
    freq = fx.pair_frequency_all(spark, sf).where("pu_location_id % 6 = 0 and pu_location_id != do_location_id")
    new = freq.groupBy(F.col("pu_location_id").alias("src")).agg(
        F.max_by("do_location_id", F.struct("frequency", "do_location_id")).alias("dst"))
    return comp.union(kept, new)


@query("n12_graph_check")
def n12_graph_check(spark, sf):
    return gr.graph_check(fx.edges(spark, sf), td.zones(spark, sf))


# --- paths and recommendation ----------------------------------------------

@query("j2_readable_paths")
def j2_readable_paths(spark, sf):
    names = rec.zone_names(td.zones(spark, sf))
    return _text(rec.readable_paths(fx.path_frequency(spark, sf), names).select("trip_path", "route"))


@query("j3_contained_pairs")
def j3_contained_pairs(spark, sf):
    pairs = cov.contained_pairs(fx.path_frequency(spark, sf))
    return pairs.select(path_text("parent").alias("parent"), path_text("child").alias("child"), "frequency")


@query("t3_top_k_paths")
def t3_top_k_paths(spark, sf):
    return _text(rec.top_k_paths(cov.coverage_count(fx.path_frequency(spark, sf)), 20, 4))


@query("r1_top_k_routes")
def r1_top_k_routes(spark, sf):
    return _text(rec.top_k_routes(cov.coverage_count(fx.path_frequency(spark, sf)), td.zones(spark, sf), 25, 3))


@query("r3_overall_coverage")
def r3_overall_coverage(spark, sf):
    paths = fx.path_frequency(spark, sf)
    chosen = rec.top_k_paths(cov.coverage_count(paths), 25, 3)
    return rec.overall_coverage(chosen, paths)


@query("r4_sub_path_frequency")
def r4_sub_path_frequency(spark, sf):
    return cov.sub_path_frequency(fx.path_frequency(spark, sf)).withColumn("sub_path", path_text("sub_path"))


@query("r5_route_clusters")
def r5_route_clusters(spark, sf):
    """Routes of at least four zones, clustered where they share three quarters of their zones."""
    out = rc.route_clusters(fx.path_frequency(spark, sf), percent=75, m=4)
    return out.withColumns({c: path_text(c) for c in ("trip_path", "cluster")})


# --- filters and cleaning ---------------------------------------------------

@query("f5_borough_trip_frequency")
def f5_borough_trip_frequency(spark, sf):
    z = td.zones(spark, sf).where(F.col("borough") == "ASIA")
    return fq.trip_frequency(td.trips(spark, sf), zones=z)


@query("f7_code_list_filter")
def f7_code_list_filter(spark, sf):
    return (cl.code_list_filter(td.metered_trips(spark, sf))
            .select("PULocationID", "DOLocationID", "payment_type", "RatecodeID", "passenger_count", "fare_amount"))


@query("f9_sigma_filter")
def f9_sigma_filter(spark, sf):
    ev = td.outlier_values(spark, sf)
    return cl.within_sigma(ev, ev, "value").select("event_id", "value")


@query("f10_file_month_filter")
def f10_file_month_filter(spark, sf):
    m = td.metered_trips(spark, sf)
    return (m.where(cl.in_month("tpep_pickup_datetime"))
            .select("PULocationID", "DOLocationID", "file_path"))


@query("f14_clean_metered_trips")
def f14_clean_metered_trips(spark, sf):
    return cl.clean_metered_trips(td.metered_trips(spark, sf))


@query("f14_clean_green_trips")
def f14_clean_green_trips(spark, sf):
    return cl.clean_metered_trips(td.green_trips(spark, sf), cl.GREEN_COLUMNS)


@query("f9_file_moments")
def f9_file_moments(spark, sf):
    """Bounds per file from a side table that is extended as files arrive: the
    files of the years before 1995 first, then the others."""
    base, table = scratch_path(spark, "metered_files"), scratch_path(spark, "file_moments")
    m = td.metered_trips(spark, sf).withColumn("file_month", cl.year_month_of_file("file_path")).select("file_month", "total_amount")
    early = F.col("file_month") < "1995-01"

    def read(paths):
        return rd.read_tagged(spark, paths)

    for part in (m.where(early), m.where(~early)):
        part.repartition("file_month").write.mode("append").partitionBy("file_month").parquet(base)
        known, _ = fm.update(spark, fm.listing(spark, base), table, "total_amount", read)
    months = fm.merged(known.withColumn("file_month", cl.year_month_of_file("file_path")).where("n > 0"), ["file_month"])
    return _round(fm.sigma_bounds(months).select("file_month", "n", "lower_bound", "upper_bound"), "lower_bound", "upper_bound", digits=3)


def _fhv_raw(spark, sf):
    t = td.trips(spark, sf)
    return t.select(F.col("pu_datetime").alias("pickup_datetime"), F.col("do_datetime").alias("dropOff_datetime"),
                    F.col("pu_location_id").cast("string").alias("PUlocationID"),
                    F.col("do_location_id").cast("string").alias("DOlocationID"))


@query("f15_clean_fhv_trips")
def f15_clean_fhv_trips(spark, sf):
    return cl.clean_fhv_trips(_fhv_raw(spark, sf))


@query("p8_unify_providers")
def p8_unify_providers(spark, sf):
    return cl.unify_trips({"yellow": [td.metered_trips(spark, sf)], "fhv": [_fhv_raw(spark, sf)]})


@query("p8_unify_four_providers")
def p8_unify_four_providers(spark, sf):
    fhv = _fhv_raw(spark, sf)
    return cl.unify_trips({
        "yellow": [td.metered_trips(spark, sf)], "green": [td.green_trips(spark, sf)], "fhv": [fhv],
        "fhvhv": [fhv.withColumnsRenamed({"dropOff_datetime": "dropoff_datetime", "PUlocationID": "PULocationID", "DOlocationID": "DOLocationID"})]})


@query("l1_zone_lookup_clean")
def l1_zone_lookup_clean(spark, sf):
    return zn.clean_zone_lookup(td.raw_zone_lookup(spark, sf))


# --- set operations ---------------------------------------------------------

def _areas(spark, sf):
    z = td.zones(spark, sf)
    return z.select("location_id").unionAll(z.where(F.col("borough") == "ASIA").select("location_id"))


def _allowed(spark, sf):
    return td.zones(spark, sf).where(F.col("borough") == "AMERICA").select("location_id")


@query("u4_excluded_areas")
def u4_excluded_areas(spark, sf):
    return pf.excluded_areas(_areas(spark, sf), _allowed(spark, sf))


@query("u6_service_area_violations")
def u6_service_area_violations(spark, sf):
    return pf.service_area_violations(td.trips(spark, sf), _areas(spark, sf), _allowed(spark, sf),
                                      pu="pu_location_id", do="do_location_id")


# --- zone list exports ------------------------------------------------------

@query("k9_connected_zone_lists")
def k9_connected_zone_lists(spark, sf):
    z = td.zones(spark, sf)
    nodes = fx.graph_zones(spark, sf)
    connected = (z.join(nodes, "location_id", "left_semi")
                 .join(td.isolated_zones(spark, sf), "location_id", "left_anti"))
    return zn.borough_zone_lists(connected, z)


@query("k10_isolated_zone_lists")
def k10_isolated_zone_lists(spark, sf):
    z = td.zones(spark, sf)
    iso = z.join(td.isolated_zones(spark, sf), "location_id", "left_semi")
    return zn.borough_zone_lists(iso, z)


# --- sources and sinks: write to a fresh shared folder, read back ------------

def _unified(spark, sf):
    return cl.unify_trips({"yellow": [td.metered_trips(spark, sf)], "fhv": [_fhv_raw(spark, sf)]})


@query("s1_read_csv")
def s1_read_csv(spark, sf):
    path = scratch_path(spark, "zone_lookup_csv")
    wr.write_sorted_csv(td.raw_zone_lookup(spark, sf), path, ["LocationID"])
    return rd.read_csv(spark, path, schema=schemas.RAW_ZONE_LOOKUP)


@query("s2_read_month_range")
def s2_read_month_range(spark, sf):
    path = scratch_path(spark, "trips_by_month")
    t = _unified(spark, sf).withColumn("year", F.year("pu_datetime")).withColumn("month", F.month("pu_datetime"))
    wr.write_partitioned(t, path, ["tlc_type", "year", "month"])
    return (rd.read_months(spark, path, "yellow", "1996-01", "1997-06")
            .select("pu_datetime", "do_datetime", "pu_location_id", "do_location_id"))


@query("s3_read_provider_year")
def s3_read_provider_year(spark, sf):
    path = scratch_path(spark, "trips_by_provider_year")
    t = _unified(spark, sf).withColumn("year", F.year("pu_datetime"))
    wr.write_partitioned(t, path, ["tlc_type", "year"])
    return (rd.read_partitioned(spark, path, tlc_type="fhv", year=1996)
            .select("pu_datetime", "do_datetime", "pu_location_id", "do_location_id"))


@query("s4_read_drift_groups")
def s4_read_drift_groups(spark, sf):
    """Two file groups whose zone-id columns changed type (int -> string) and
    case; each group is read with its own schema, cleaned, then unioned."""
    m = td.metered_trips(spark, sf)
    early = scratch_path(spark, "yellow_int_ids")
    late = scratch_path(spark, "yellow_text_ids")
    cut = F.col("tpep_pickup_datetime") < F.lit("1998-01-01").cast("timestamp_ntz")
    m.where(cut).write.mode("overwrite").parquet(early)
    (m.where(~cut).select("tpep_pickup_datetime", "tpep_dropoff_datetime",
                          F.col("PULocationID").cast("string").alias("PUlocationID"),
                          F.col("DOLocationID").cast("string").alias("DOlocationID"))
     .write.mode("overwrite").parquet(late))
    return rd.read_groups(spark, [[early], [late]], lambda df: cl.unify_provider(df, "yellow"))


@query("s4_read_by_schema")
def s4_read_by_schema(spark, sf):
    """Monthly files of two providers whose id columns change type in different
    years; the files' footers say which are read together."""
    frames = []
    for provider, raw, change in (("yellow", td.metered_trips(spark, sf), 1995), ("fhv", _fhv_raw(spark, sf), 1997)):
        pickup, dropoff, pu, do = schemas.PROVIDER_COLUMNS[provider]
        base = scratch_path(spark, f"drift_{provider}")
        for early in (True, False):
            kind = "int" if early else "string"
            part = raw.where((F.year(pickup) < change) if early else (F.year(pickup) >= change))
            (part.select(pickup, dropoff, F.col(pu).cast(kind).alias(pu), F.col(do).cast(kind).alias(do if early else do.lower()),
                         F.year(pickup).alias("year"))
             .repartition("year").write.mode("append").partitionBy("year").parquet(base))
        frames.append(dr.read_by_schema(spark, dr.files_below(spark, base), lambda df, p=provider: cl.unify_provider(df, p), (pickup, dropoff, pu, do)))
    return cl.union_all(frames)


@query("s2_read_month_folders")
def s2_read_month_folders(spark, sf):
    """S2 on plain provider/YYYY/MM folders; months without a folder are left out."""
    base = scratch_path(spark, "month_folders")
    t = td.metered_trips(spark, sf).where(F.month("tpep_pickup_datetime") != 7).select(
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID")
    keyed = t.withColumns({"y": F.date_format("tpep_pickup_datetime", "yyyy"), "m": F.date_format("tpep_pickup_datetime", "MM")})
    wr.write_month_folders(keyed, f"{base}/yellow", "y", "m")
    return cl.unify_provider(rd.read_months(spark, base, "yellow", "1996-05", "1997-02", layout="folders"), "yellow")


@query("s5_read_tagged")
def s5_read_tagged(spark, sf):
    path = scratch_path(spark, "trips_by_file")
    m = td.metered_trips(spark, sf).withColumn("file_month", cl.year_month_of_file("file_path"))
    wr.write_partitioned(m.drop("file_path"), path, ["file_month"])
    tagged = rd.read_tagged(spark, path)
    return (tagged.groupBy(cl.year_month_of_file("file_path").alias("file_month"))
            .agg(F.count(F.lit(1)).alias("trips")))


@query("s6_reload_clean_trips")
def s6_reload_clean_trips(spark, sf):
    path = scratch_path(spark, "clean_trips")
    wr.write_clean_trips(td.trips(spark, sf).select(*schemas.TRIP.fieldNames()), path)
    return rd.read_clean_trips(spark, path)


@query("s7_read_borough")
def s7_read_borough(spark, sf):
    path = scratch_path(spark, "centroids_by_borough")
    wr.write_partitioned(zn.zone_centroids(fx.parsed_zones(spark, sf)), path, ["borough"])
    return rd.read_partitioned(spark, path, borough="ASIA").select("location_id", "avg_lat", "avg_lon")


@query("k1_sorted_csv")
def k1_sorted_csv(spark, sf):
    path = scratch_path(spark, "borough_location_count")
    wr.write_sorted_csv(zn.zones_per_borough(fx.parsed_zones(spark, sf)), path,
                        [F.desc("location_count"), F.asc("borough")])
    return rd.read_csv(spark, path, schema="borough string, location_count bigint")


@query("k2_sorted_tsv")
def k2_sorted_tsv(spark, sf):
    path = scratch_path(spark, "trip_paths_frequency")
    pf_ = fx.path_frequency(spark, sf)
    wr.write_sorted_tsv(pf_.select("frequency", path_text("trip_path").alias("trip_path")), path,
                        [F.desc("frequency"), F.desc(F.size(F.split("trip_path", ","))), F.asc("trip_path")])
    return rd.read_csv(spark, path, schema="frequency bigint, trip_path string", sep="\t")


@query("k3_tsv_empty_values")
def k3_tsv_empty_values(spark, sf):
    path = scratch_path(spark, "borough_isolated_locations")
    wr.write_sorted_tsv(k10_isolated_zone_lists(spark, sf), path, ["borough"], empty_value="")
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("k4_clean_trips_parquet")
def k4_clean_trips_parquet(spark, sf):
    path = scratch_path(spark, "taxi_trips")
    wr.write_clean_trips(td.trips(spark, sf), path)
    return spark.read.parquet(path)


@query("k5_clean_trips_by_provider")
def k5_clean_trips_by_provider(spark, sf):
    path = scratch_path(spark, "taxi_trips_by_type")
    wr.write_clean_trips(_unified(spark, sf), path, by_provider=True)
    return spark.read.parquet(path)


@query("k4_bucketed_trip_frequency")
def k4_bucketed_trip_frequency(spark, sf):
    """A1 over clean trips bucketed by (pu, do)."""
    path = scratch_path(spark, "bucketed_trips")
    name = "trips_" + path.rsplit("-", 1)[1]
    bk.write_bucketed_trips(td.trips(spark, sf), path, name)
    return bk.bucketed_trip_frequency(spark, name)


@query("k6_partitioned_provider_year")
def k6_partitioned_provider_year(spark, sf):
    path = scratch_path(spark, "trips_cab_year")
    t = (_unified(spark, sf).select(F.col("tlc_type").alias("cab"), F.year("pu_datetime").alias("year"),
                                    F.col("pu_location_id").alias("pulocationID"),
                                    F.col("do_location_id").alias("dolocationID")))
    wr.write_partitioned(t, path, ["cab", "year"])
    return spark.read.parquet(path)


@query("k7_borough_fanout")
def k7_borough_fanout(spark, sf):
    path = scratch_path(spark, "zone_centroids")
    wr.write_partitioned(zn.zone_centroids(fx.parsed_zones(spark, sf)), path, ["borough"])
    return spark.read.parquet(path)


@query("k8_verify_roundtrip")
def k8_verify_roundtrip(spark, sf):
    path = scratch_path(spark, "taxi_trips_check")
    t = td.trips(spark, sf)
    t, seen = wr.observed(t)
    wr.write_clean_trips(t, path)
    check = wr.verify_written(spark, seen.get["rows"], path)
    return spark.createDataFrame([tuple(check.values())], "source_count bigint, written_count bigint, counts_match boolean")


# --- variants, scalar functions, streaming ---------------------------------

@query("p6_pair_frequency_struct")
def p6_pair_frequency_struct(spark, sf):
    pairs = cl.clean_fhv_trips(_fhv_raw(spark, sf))
    out = fq.pair_frequency_struct(pairs, zones=fx.graph_zones(spark, sf), isolated=td.isolated_zones(spark, sf))
    return out.select("PUDOPair.pulocationID", "PUDOPair.dolocationID", "Frequency")


@query("a9_coverage_count_contiguous")
def a9_coverage_count_contiguous(spark, sf):
    return _text(cov.coverage_count(fx.path_frequency(spark, sf), cov.CONTIGUOUS))


@query("x1_x3_path_text_functions")
def x1_x3_path_text_functions(spark, sf):
    """X1 split/index/size, X2 array_join, X3 first segment of a zone name."""
    p = fx.path_frequency(spark, sf).select(path_text("trip_path").alias("t"))
    z = rec.zone_names(td.zones(spark, sf), short_names=False)
    parts = F.split("t", ",")
    out = p.select("t", F.size(parts).alias("n_stops"), F.get(parts, 0).cast("bigint").alias("first_stop"),
                   F.array_join(F.reverse(parts), ",").alias("reversed_path"))
    return (out.join(z, out.first_stop == z.location_id, "left")
            .select(F.col("t").alias("trip_path"), "n_stops", "first_stop", "reversed_path",
                    short_zone_name("name").alias("first_zone")))


@query("x4_x7_date_text_functions")
def x4_x7_date_text_functions(spark, sf):
    """X4 regexp_extract, X5 concat_ws/format_string, X6 year/month, X7 round."""
    m = td.metered_trips(spark, sf)
    return m.select(cl.year_month_of_file("file_path").alias("file_month"),
                    F.year("tpep_pickup_datetime").alias("pickup_year"),
                    F.month("tpep_pickup_datetime").alias("pickup_month"),
                    cl.year_month_of("tpep_pickup_datetime").alias("pickup_year_month"),
                    F.round(F.col("total_amount") / 3, 2).alias("third_of_total"))


@query("st_streaming_trip_frequency")
def st_streaming_trip_frequency(spark, sf):
    """A1 computed by a file-source stream over monthly drops of clean trips."""
    from routecov.streaming.incremental import run_to_table, trip_frequency_stream
    src = scratch_path(spark, "fhv_drops")
    raw = _fhv_raw(spark, sf)
    raw.repartition(F.date_format("pickup_datetime", "yyyy")).write.mode("overwrite").parquet(src)
    out, ck = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ckpt")
    q = run_to_table(trip_frequency_stream(spark, src, raw.schema, "fhv", max_files_per_trigger=1), out, ck)
    q.awaitTermination()
    return spark.read.parquet(out)
