"""End-to-end batch jobs over files, matching the reference's four programs:
trip ETL, zone ETL, neighbour-distance ETL and route recommendation.

Each job is one function ``(spark, paths..., options) -> dict`` that reads
its inputs lazily, writes every output in one Spark job per output (no
per-borough or per-file loops) and returns row counts for logging.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecov import schemas
from routecov.functions.paths import path_text
from routecov.operators import clean as cl
from routecov.operators import file_moments as fm
from routecov.operators import frequency as fq
from routecov.operators import graph as gr
from routecov.operators import zones as zn
from routecov.plans.pipeline import DEFAULT_K, DEFAULT_M, recommend_routes
from routecov.session import cut_lineage
from routecov.sinks import bucketed as bk
from routecov.sinks import writers as wr
from routecov.sources import drift as dr
from routecov.sources import readers as rd


def trip_groups(spark: SparkSession, base: str, provider: str, start: str | None = None, end: str | None = None,
                cuts: tuple[str, ...] | None = None) -> tuple[list[list[str]], list[str]]:
    """Files of the month folders ``base/provider/YYYY/MM`` that exist, in
    groups of one schema, and the folders outside ``start`` ... ``end``
    (inclusive, open if None).

    Groups follow the types of the provider's columns in the files' footers;
    with ``cuts`` (months) a new group begins at each instead, and whole folders
    are listed."""
    chosen, left_out = [], []
    for month, path in rd.existing_months(spark, base, provider):
        inside = not ((start and month < start) or (end and month > end))
        (chosen if inside else left_out).append((month, path))
    left = [path for _, path in left_out]
    if cuts is not None:
        groups: dict[int, list[str]] = {}
        for month, path in chosen:
            groups.setdefault(sum(month >= c for c in cuts), []).append(path)
        return [groups[g] for g in sorted(groups)], left
    files = [f for _, path in chosen for f in dr.files_below(spark, path)]
    return [paths for paths, _ in dr.schema_groups(spark, files, schemas.PROVIDER_COLUMNS[provider])], left


def trip_etl(spark: SparkSession, source: str, output: str,
             providers: tuple[str, ...] = tuple(schemas.PROVIDER_COLUMNS),
             groups: dict[str, list[list[str]]] | None = None, partitions: int | None = None,
             start: str | None = None, end: str | None = None, cuts: tuple[str, ...] | None = None,
             bucketed: str | None = None) -> dict:
    """Raw provider files -> one clean trip table (K4) + write-back check (K8).

    Every month folder found is read unless ``start`` / ``end`` exclude it.
    The result names the folders left out and the providers without any folder
    to read; ``raw_count`` is counted in one job of its own and ``dropped`` says
    how many rows the cleaning took.  ``bucketed``: also keep the trips in
    tables of that name, in place for the trip frequency (``sinks.bucketed``)."""
    frames, raws, left_out, chosen, without = [], [], [], [], []
    for p in providers:
        own, out = ((groups or {}).get(p, []), []) if groups else trip_groups(spark, source, p, start, end, cuts)
        left_out += out
        if not own:
            without.append(p)
        for paths in own:
            chosen += paths
            raw = spark.read.parquet(*paths)
            raws.append(raw.select(F.lit(p).alias("tlc_type")))
            frames.append(cl.unify_provider(raw, p))
    if not frames:
        raise ValueError(f"no month folders of {', '.join(providers)} under {source}")
    clean, seen = wr.observed(cl.union_all(frames))
    wr.write_clean_trips(clean, output, partitions=partitions)
    check = wr.verify_written(spark, seen.get["rows"], output)
    raw_count = cl.union_all(raws).count()
    if bucketed:
        bk.write_bucketed_trips(rd.read_clean_trips(spark, output), f"{output.rstrip('/')}_bucketed", bucketed)
    folders = {f.rsplit("/", 1)[0] if f.endswith(".parquet") else f for f in chosen}
    return {**check, "raw_count": raw_count, "dropped": raw_count - check["source_count"], "folders_read": len(folders),
            "folders_left_out": left_out, "providers_without_folders": without}


def cleaned_pairs(spark: SparkSession, source: str, provider: str, moments: str | None = None,
                  start: str | None = None, end: str | None = None) -> DataFrame:
    """(cab, year, pulocationID, dolocationID) of one provider's month folders
    by its cleaning rule: metered providers by F14 (bounds per file kept in
    the side table ``moments`` if given, else computed here), others by F15."""
    there = [path for month, path in rd.existing_months(spark, source, provider)
             if not ((start and month < start) or (end and month > end))]
    files = [f for path in there for f in dr.files_below(spark, path)]
    if not files:
        raise ValueError(f"no month folders of {provider} under {source}")
    metered = {"yellow": cl.YELLOW_COLUMNS, "green": cl.GREEN_COLUMNS}.get(provider)
    # the month of a file is in its name or, in these folders, in its path
    month = F.coalesce(F.nullif(cl.year_month_of_file("file_path"), F.lit("")),
                       F.concat_ws("-", F.regexp_extract("file_path", r"/(\d{4})/(\d{2})/[^/]*$", 1),
                                   F.regexp_extract("file_path", r"/(\d{4})/(\d{2})/[^/]*$", 2)))
    _, _, pu, do = schemas.PROVIDER_COLUMNS[provider]
    bounds = None
    if metered and moments:
        listed = fm.listing(spark, there)
        known, _ = fm.update(spark, listed, moments, "total_amount", lambda paths: dr.read_by_schema(
            spark, paths, lambda df: df.select(F.col("total_amount").cast("double"), F.col("_metadata.file_path").alias("file_path")), ["total_amount"]))
        bounds = fm.bounds_of_files(known)

    def clean(df: DataFrame) -> DataFrame:
        tagged = df.withColumn("file_path", F.col("_metadata.file_path"))
        year = F.substring(month, 1, 4).try_cast("int").alias("year")
        if not metered:
            return cl.not_null(tagged, [pu, do]).select(F.lit(provider).alias("cab"), year, cl.to_long(pu).alias("pulocationID"), cl.to_long(do).alias("dolocationID"))
        kept = cl.clean_metered_trips(tagged, metered, bounds=bounds, month=month, keep=["file_path"])
        return kept.select(F.lit(provider).alias("cab"), year, "pulocationID", "dolocationID")

    columns = [pu, do] + ([metered["pickup"], "total_amount", "fare_amount", "payment_type", "RatecodeID", "passenger_count"] if metered else [])
    return dr.read_by_schema(spark, files, clean, columns)


def cleaning_etl(spark: SparkSession, source: str, output: str, providers: tuple[str, ...] = tuple(schemas.PROVIDER_COLUMNS),
                 moments: str | None = None, start: str | None = None, end: str | None = None) -> dict:
    """Reduced trips of every provider by its own cleaning rule (F14, F15), in
    ``cab=.../year=...`` folders (K6), written in one job."""
    frames, without = [], []
    for p in providers:
        if rd.existing_months(spark, source, p):
            frames.append(cleaned_pairs(spark, source, p, f"{moments}/{p}" if moments else None, start, end))
        else:
            without.append(p)
    if not frames:
        raise ValueError(f"no month folders of {', '.join(providers)} under {source}")
    pairs, seen = wr.observed(cl.union_all(frames))
    wr.write_partitioned(pairs, output, ["cab", "year"])
    return {**wr.verify_written(spark, seen.get["rows"], output), "providers_without_folders": without}


def pair_frequency_etl(spark: SparkSession, pairs: str, distance_dir: str, isolated: DataFrame, output: str,
                       borough: str = "Manhattan") -> dict:
    """Reduced trips (``cleaning_etl``) -> frequency per provider, year and
    pair of the borough's connected zones (P6), in ``cab=.../year=...`` folders."""
    dist = (spark.read.option("header", True).schema("location_id bigint, neighbor_location_id bigint, distance int, borough string")
            .csv(distance_dir).where(F.col("borough") == borough))
    allowed = (dist.select("location_id").distinct()
               .join(isolated.select(F.col("location_id").cast("bigint").alias("location_id")), "location_id", "left_anti"))
    trips = spark.read.parquet(pairs).withColumnsRenamed({"pulocationID": fq.PU, "dolocationID": fq.DO})
    freq = (fq.keep_zones(fq.drop_same_zone(trips), allowed).groupBy("cab", "year", fq.PU, fq.DO)
            .agg(F.count(F.lit(1)).alias("Frequency")))
    out = freq.select("cab", "year", F.struct(F.col(fq.PU).alias("pulocationID"), F.col(fq.DO).alias("dolocationID")).alias("PUDOPair"), "Frequency")
    out = cut_lineage(out)  # at most a row a provider, year and pair of zones
    n = out.count()
    wr.write_partitioned(out, output, ["cab", "year"])
    # without any pair there is no file to read back
    return wr.verify_written(spark, n, output) if n else {"source_count": 0, "written_count": 0, "counts_match": True}


def zone_etl(spark: SparkSession, zones_csv: str, lookup_csv: str, profile_out: str,
             clean_out: str, axis_order: str = "xy") -> dict:
    """Zone polygons + lookup -> profiles (A5, A15), centroids per borough
    (G2, K7) and the cleaned lookup per borough."""
    raw = rd.read_csv(spark, zones_csv, schema=schemas.RAW_ZONE)
    zones = zn.parse_zones(raw)
    wr.write_sorted_csv(zn.zones_per_borough(zones), f"{profile_out}/borough_location_count",
                        [F.desc("location_count"), F.asc("borough")])
    stats = zn.boundary_stats(zones)
    stats.write.mode("overwrite").partitionBy("borough").option("header", True).csv(
        f"{profile_out}/borough_location_boundary_stats")
    zn.rejected_zones(raw).write.mode("overwrite").option("header", True).csv(f"{profile_out}/rejected_zones")
    centroids = zn.zone_centroids(zones, axis_order)
    centroids.write.mode("overwrite").partitionBy("borough").option("header", True).csv(f"{clean_out}/zones")
    lookup = zn.clean_zone_lookup(rd.read_csv(spark, lookup_csv, schema=schemas.RAW_ZONE_LOOKUP))
    lookup.write.mode("overwrite").partitionBy("borough").option("header", True).csv(f"{clean_out}/lookup")
    wr.write_sorted_csv(zn.zones_per_borough(lookup), f"{profile_out}/lookup_borough_location_count",
                        [F.desc("location_count"), F.asc("borough")])
    return {"zones": zones.count()}


def neighbor_etl(spark: SparkSession, centroid_dir: str, neighbors_csv: str | None, isolated: DataFrame,
                 lookup_dir: str, output: str, zones_csv: str | None = None, min_shared: int = 2) -> dict:
    """Neighbour relation + centroids -> distances per borough (G5), and the
    connected / isolated zone lists per borough (K9, K10, TSV).

    Without ``neighbors_csv`` the relation comes from the polygons of
    ``zones_csv``: zones of one borough that share ``min_shared`` points (G6)."""
    centroids = spark.read.option("header", True).schema(
        "location_id bigint, avg_lat double, avg_lon double, borough string").csv(centroid_dir)
    if neighbors_csv:
        pairs = rd.read_csv(spark, neighbors_csv, schema="location_id bigint, neighbor_location_id bigint")
    elif zones_csv:
        zones = zn.parse_zones(rd.read_csv(spark, zones_csv, schema=schemas.RAW_ZONE))
        found = zn.shared_point_neighbours(zones, min_shared)
        own = zones.select("location_id", "borough").distinct()
        pairs = cut_lineage(found.join(own, "location_id").join(
            own.select(F.col("location_id").alias("neighbor_location_id"), "borough"), ["neighbor_location_id", "borough"])
            .select("location_id", "neighbor_location_id").distinct())
    else:
        raise ValueError("neighbours need a table of pairs or the zone polygons")
    dist = gr.neighbor_distance(pairs, centroids)
    missing = gr.missing_centroids(pairs, centroids)
    missing.select("zone").write.mode("overwrite").option("header", True).csv(f"{output}/zones_without_centroid")
    borough = centroids.select("location_id", "borough")
    (dist.join(borough, "location_id").write.mode("overwrite").partitionBy("borough")
     .option("header", True).csv(f"{output}/location_neighbors_distance"))
    lookup = spark.read.option("header", True).schema(
        "location_id bigint, zone string, borough string").csv(lookup_dir)
    iso = isolated.select(F.col("location_id").cast("bigint"))
    connected = lookup.join(iso, "location_id", "left_anti")
    wr.write_sorted_tsv(zn.borough_zone_lists(connected, lookup), f"{output}/borough_connected_locations",
                        ["borough"], empty_value="")
    wr.write_sorted_tsv(zn.borough_zone_lists(lookup.join(iso, "location_id", "left_semi"), lookup),
                        f"{output}/borough_isolated_locations", ["borough"], empty_value="")
    return {"edges": dist.count(), "zones_without_centroid": missing.count()}


def recommendation(spark: SparkSession, trips_path: str, distance_dir: str, lookup_dir: str,
                   isolated: DataFrame, output: str, borough: str = "Manhattan",
                   k: int = DEFAULT_K, m: int = DEFAULT_M) -> dict:
    """Clean trips + neighbour distances + lookup -> profiles (A2-A4), path
    frequency, coverage, readable routes and their percentages (R6), as
    sorted TSV/CSV outputs."""
    # borough is a folder partition: the filter prunes the other boroughs' files
    dist = (spark.read.option("header", True)
            .schema("location_id bigint, neighbor_location_id bigint, distance int, borough string")
            .csv(distance_dir).where(F.col("borough") == borough))
    edges = gr.build_graph(dist)
    lookup = (spark.read.option("header", True).schema("location_id bigint, zone string, borough string")
              .csv(lookup_dir))
    zones = lookup.where(F.col("borough") == borough).select("location_id")
    report = recommend_routes(rd.read_clean_trips(spark, trips_path), edges, lookup,
                              zones=zones, isolated=isolated, k=k, m=m)
    prof = f"{output}/profile/{borough}"
    wr.write_sorted_csv(fq.same_zone_distribution(report.trip_frequency),
                        f"{prof}/single_location_trip_count_dist", [F.desc("frequency")])
    wr.write_sorted_csv(fq.from_zone_distribution(report.trip_frequency),
                        f"{prof}/cross_location_from_trip_count_dist", [F.desc("frequency")])
    wr.write_sorted_csv(fq.to_zone_distribution(report.trip_frequency),
                        f"{prof}/cross_location_to_trip_count_dist", [F.desc("frequency")])
    by_len = F.desc(F.size(F.split("trip_path", ",")))
    wr.write_sorted_parts(report.unreachable, f"{output}/unreachable_pairs", [F.desc("frequency"), F.asc("pu_location_id"), F.asc("do_location_id")])
    wr.write_sorted_parts(report.path_frequency.select("frequency", path_text("trip_path").alias("trip_path")),
                        f"{output}/trip_paths_frequency", [F.desc("frequency"), by_len, F.asc("trip_path")])
    wr.write_sorted_parts(report.coverage.select("coverage_count", path_text("trip_path").alias("trip_path")),
                        f"{output}/trip_paths_coverage_count", [F.desc("coverage_count"), by_len, F.asc("trip_path")])
    wr.write_sorted_tsv(report.routes.select("coverage_count", "route"), f"{output}/hr_routes_coverage_count",
                        [F.desc("coverage_count"), F.asc("route")])
    wr.write_sorted_tsv(report.route_percentage.select("coverage_percentage", "route"),
                        f"{output}/hr_routes_coverage_percentage", [F.desc("coverage_percentage"), F.asc("route")])
    lost = report.unreachable.agg(F.count("*").alias("pairs"), F.coalesce(F.sum("frequency"), F.lit(0)).alias("trips")).first()
    check = gr.graph_check(edges, zones.join(isolated.select(F.col("location_id").cast("bigint").alias("location_id")), "location_id", "left_anti"))
    return {"pairs": report.trip_frequency.count(), "paths": report.path_frequency.count(),
            "routes": report.routes.count(), "unreachable_pairs": lost["pairs"], "unreachable_trips": lost["trips"],
            **{f"graph_{k}": v for k, v in check.first().asDict().items()}}
