"""The four batch jobs end to end on files derived from the test tables."""

import glob
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from routecov.plans import jobs
from routecov.sources import testdata as td


def test_jobs_end_to_end(spark):
    base = tempfile.mkdtemp(prefix="routecov-jobs-")
    # raw yellow files in the reference's provider/yyyy/MM layout, two schema groups
    m = td.metered_trips(spark, SF001).drop("file_path")
    early = F.col("tpep_pickup_datetime") < F.lit("1997-01-01").cast("timestamp_ntz")
    m.where(early).write.parquet(f"{base}/raw/yellow/1996/01")
    (m.where(~early).withColumn("PULocationID", F.col("PULocationID").cast("string"))
     .write.parquet(f"{base}/raw/yellow/1997/01"))
    groups = {"yellow": [[f"{base}/raw/yellow/1996/*/*"], [f"{base}/raw/yellow/1997/*/*"]]}
    res = jobs.trip_etl(spark, f"{base}/raw", f"{base}/clean", providers=("yellow",), groups=groups)
    assert res["counts_match"] and res["written_count"] == m.count()

    td.raw_zone_polygons(spark, SF001).write.option("header", True).csv(f"{base}/zones_csv")
    td.raw_zone_lookup(spark, SF001).write.option("header", True).csv(f"{base}/lookup_csv")
    z = jobs.zone_etl(spark, f"{base}/zones_csv", f"{base}/lookup_csv", f"{base}/profile", f"{base}/zones")
    assert z["zones"] > 0
    assert glob.glob(f"{base}/zones/zones/borough=*")

    # the fixture's neighbour pairs over the zone ids that have polygons (nation keys 1..24)
    pairs = td.neighbor_pairs(spark, SF001).where("location_id > 0 AND neighbor_location_id > 0")
    pairs.write.option("header", True).csv(f"{base}/neighbors_csv")
    iso = td.isolated_zones(spark, SF001)
    n = jobs.neighbor_etl(spark, f"{base}/zones/zones", f"{base}/neighbors_csv", iso,
                          f"{base}/zones/lookup", f"{base}/graph")
    assert n["edges"] == pairs.count()

    out = jobs.recommendation(spark, f"{base}/clean", f"{base}/graph/location_neighbors_distance",
                              f"{base}/zones/lookup", iso, f"{base}/out", borough="ASIA", k=5, m=2)
    assert out["pairs"] > 0 and out["paths"] > 0 and 0 < out["routes"] <= 5
    lines = open(glob.glob(f"{base}/out/hr_routes_coverage_percentage/part-*")[0]).read().splitlines()
    assert lines[0] == "coverage_percentage\troute" and len(lines) == out["routes"] + 1


def test_trip_etl_reads_every_month_folder(spark):
    base = tempfile.mkdtemp(prefix="routecov-months-")
    m = td.metered_trips(spark, SF001).drop("file_path")
    for i, month in enumerate(("2019/12", "2020/10", "2023/01", "2023/05", "2023/11", "2024/01")):
        part = m.limit(10 + i)
        if month >= "2023/02":
            part = part.withColumn("PULocationID", F.col("PULocationID").cast("string"))
        part.write.parquet(f"{base}/raw/yellow/{month}")
    res = jobs.trip_etl(spark, f"{base}/raw", f"{base}/all", providers=("yellow",))
    assert res["raw_count"] == res["written_count"] == res["source_count"] == 75 and res["counts_match"]
    assert res["folders_read"] == 6 and res["folders_left_out"] == []
    res = jobs.trip_etl(spark, f"{base}/raw", f"{base}/some", providers=("yellow",), start="2020-01", end="2023-12")
    assert res["written_count"] == 50 and [p[-7:] for p in res["folders_left_out"]] == ["2019/12", "2024/01"]


def test_neighbour_job_reports_zones_without_centroid(spark):
    base = tempfile.mkdtemp(prefix="routecov-lost-")
    spark.createDataFrame([(1, 1.0, 2.0, "A"), (2, 1.5, 2.0, "A")], "location_id long, avg_lat double, avg_lon double, borough string").write.option(
        "header", True).csv(f"{base}/centroids")
    spark.createDataFrame([(1, 2), (2, 3)], "location_id long, neighbor_location_id long").write.option("header", True).csv(f"{base}/pairs")
    spark.createDataFrame([(1, "x", "A"), (2, "y", "A")], "location_id long, zone string, borough string").write.option("header", True).csv(f"{base}/lookup")
    iso = spark.createDataFrame([], "location_id long")
    res = jobs.neighbor_etl(spark, f"{base}/centroids", f"{base}/pairs", iso, f"{base}/lookup", f"{base}/out")
    assert res == {"edges": 1, "zones_without_centroid": 1}


def _month_files(spark, base):
    """Yellow ids turn to text in 1995-02, fhv ids in 1995-03: each provider has two schemas."""
    m = td.metered_trips(spark, SF001).drop("file_path")
    for i, month in enumerate(("1995/01", "1995/02", "1995/03")):
        y = m.where(F.date_format("tpep_pickup_datetime", "yyyy/MM") == month)
        f = y.select(F.col("tpep_pickup_datetime").alias("pickup_datetime"), F.col("tpep_dropoff_datetime").alias("dropOff_datetime"),
                     F.col("PULocationID").alias("PUlocationID"), F.col("DOLocationID").alias("DOlocationID"))
        if i >= 1:
            y = y.withColumn("PULocationID", F.col("PULocationID").cast("string"))
        if i >= 2:
            f = f.withColumn("PUlocationID", F.col("PUlocationID").cast("string"))
        y.write.parquet(f"{base}/raw/yellow/{month}")
        f.write.parquet(f"{base}/raw/fhv/{month}")
    return m.where(F.date_format("tpep_pickup_datetime", "yyyy/MM").isin("1995/01", "1995/02", "1995/03"))


def test_providers_that_change_in_different_months(spark):
    base = tempfile.mkdtemp(prefix="routecov-drift-")
    n = _month_files(spark, base).count()
    res = jobs.trip_etl(spark, f"{base}/raw", f"{base}/clean", bucketed="jobs_trips")
    assert res["written_count"] == res["raw_count"] == 2 * n and res["dropped"] == 0 and res["counts_match"]
    assert res["folders_read"] == 6 and sorted(res["providers_without_folders"]) == ["fhvhv", "green"]
    assert spark.table("jobs_trips_pairs").count() + spark.table("jobs_trips_hot_pairs").count() == 2 * n
    for k in ("pairs", "hot_pairs"):
        spark.sql(f"DROP TABLE jobs_trips_{k}")


def test_cleaning_and_pair_frequency_jobs(spark):
    from routecov.operators import clean as cl
    base = tempfile.mkdtemp(prefix="routecov-clean-")
    m = _month_files(spark, base)
    path = F.concat(F.lit("/"), F.date_format("tpep_pickup_datetime", "yyyy-MM"), F.lit(".parquet"))
    metered = cl.clean_metered_trips(m.withColumn("file_path", path)).count()
    plain = jobs.cleaning_etl(spark, f"{base}/raw", f"{base}/pairs")
    assert plain["counts_match"] and sorted(plain["providers_without_folders"]) == ["fhvhv", "green"]
    back = spark.read.parquet(f"{base}/pairs")
    assert {(r.cab, r.year): r["count"] for r in back.groupBy("cab", "year").count().collect()} == {("yellow", 1995): metered, ("fhv", 1995): m.count()}
    for _ in range(2):  # the second run finds every file in the side table
        kept = jobs.cleaning_etl(spark, f"{base}/raw", f"{base}/pairs2", moments=f"{base}/moments")
        assert kept["written_count"] == plain["written_count"]
    assert spark.read.parquet(f"{base}/moments/yellow").count() == len(glob.glob(f"{base}/raw/yellow/*/*/part-*.parquet"))
    ids = sorted({r[0] for r in back.where("pulocationID != dolocationID and cab = 'fhv'").limit(40).select("pulocationID").union(
        back.where("cab = 'fhv'").limit(40).select("dolocationID")).collect()})
    allowed = [i for i in ids if i != 5]
    spark.createDataFrame([(i, 2, 5, "A") for i in ids] + [(5, 1, 3, "A"), (99, 1, 1, "B")],
                          "location_id long, neighbor_location_id long, distance int, borough string").write.partitionBy("borough").option(
        "header", True).csv(f"{base}/dist")
    iso = spark.createDataFrame([(5,)], "location_id long")
    res = jobs.pair_frequency_etl(spark, f"{base}/pairs", f"{base}/dist", iso, f"{base}/freq", borough="A")
    got = {(r.cab, r.PUDOPair.pulocationID, r.PUDOPair.dolocationID): r.Frequency for r in spark.read.parquet(f"{base}/freq").collect()}
    want = {(r.cab, r.pulocationID, r.dolocationID): r["count"] for r in back.where(F.col("pulocationID").isin(allowed) & F.col("dolocationID").isin(allowed) & (F.col("pulocationID") != F.col("dolocationID")))
            .groupBy("cab", "pulocationID", "dolocationID").count().collect()}
    assert got == want and want and res["counts_match"]
    none = jobs.pair_frequency_etl(spark, f"{base}/pairs", f"{base}/dist", iso, f"{base}/none", borough="Nowhere")
    assert none == {"source_count": 0, "written_count": 0, "counts_match": True}


def test_neighbour_job_from_polygons(spark):
    base = tempfile.mkdtemp(prefix="routecov-poly-")
    squares = [(f"MULTIPOLYGON ((({x} 0, {x + 1} 0, {x + 1} 1, {x} 1, {x} 0)))", x + 1, "A" if x < 3 else "B") for x in range(5)]
    spark.createDataFrame(squares, "the_geom string, LocationID int, borough string").write.option("header", True).csv(f"{base}/zones_csv")
    spark.createDataFrame([(i, f"z{i}", "A" if i < 4 else "B", "s") for i in range(1, 6)], "LocationID int, Zone string, Borough string, service_zone string").select(
        "LocationID", "Borough", "Zone", "service_zone").write.option("header", True).csv(f"{base}/lookup_csv")
    jobs.zone_etl(spark, f"{base}/zones_csv", f"{base}/lookup_csv", f"{base}/profile", f"{base}/zones")
    counts = open(glob.glob(f"{base}/profile/lookup_borough_location_count/part-*")[0]).read().splitlines()
    assert counts == ["borough,location_count", "A,3", "B,2"]
    iso = spark.createDataFrame([], "location_id long")
    res = jobs.neighbor_etl(spark, f"{base}/zones/zones", None, iso, f"{base}/zones/lookup", f"{base}/out", zones_csv=f"{base}/zones_csv")
    assert res == {"edges": 6, "zones_without_centroid": 0}  # 1-2, 2-3, 4-5, both ways; 3-4 are of two boroughs
