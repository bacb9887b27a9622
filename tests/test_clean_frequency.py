"""P*, F*, A1-A7, A12-A14, U*: cleaning rules and trip frequency."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from routecov.operators import clean as cl
from routecov.operators import frequency as fq
from routecov.operators import profile as pf

T = dt.datetime


def test_trip_frequency_filters(spark):
    trips = spark.createDataFrame(
        [(1, 2), (1, 2), (2, 2), (None, 2), (3, 1), (1, 9), (4, 1)],
        "pu_location_id bigint, do_location_id bigint")
    zones = spark.createDataFrame([(1,), (2,), (3,), (4,)], "location_id bigint")
    iso = spark.createDataFrame([(4,)], "location_id bigint")
    got = rows(fq.trip_frequency(trips, zones=zones, isolated=iso))
    assert got == [(1, 2, 2), (2, 2, 1), (3, 1, 1)]
    assert rows(fq.trip_frequency(trips, zones=zones, isolated=iso, exclude_same_zone=True)) == [(1, 2, 2), (3, 1, 1)]
    assert rows(fq.trip_frequency(trips, isolated=iso)) == [(1, 2, 2), (1, 9, 1), (2, 2, 1), (3, 1, 1)]


def test_trip_frequency_plan_does_not_shuffle_trips_for_zone_lists(spark):
    trips = spark.range(1000).select((F.col("id") % 5).alias("pu_location_id"),
                                     (F.col("id") % 7).alias("do_location_id"))
    zones = spark.range(5).select(F.col("id").alias("location_id"))
    plan = fq.trip_frequency(trips, zones=zones)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_distributions_and_empty_input(spark):
    freq = spark.createDataFrame([(1, 1, 3), (1, 2, 5), (2, 1, 15)],
                                 "pu_location_id bigint, do_location_id bigint, frequency bigint")
    assert rows(fq.same_zone_distribution(freq)) == [(1, 1, 3, 100.0)]
    assert rows(fq.from_zone_distribution(freq)) == [(1, 5, 25.0), (2, 15, 75.0)]
    assert rows(fq.total_trips(freq)) == [(23,)]
    empty = freq.where("false")
    assert rows(fq.total_trips(empty)) == [(0,)]
    assert fq.from_zone_distribution(empty).count() == 0


def metered(spark):
    cols = ("tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, PULocationID bigint, "
            "DOLocationID bigint, passenger_count double, fare_amount double, total_amount double, "
            "payment_type bigint, RatecodeID bigint, file_path string")
    f = "/y/yellow_tripdata_2021-03.parquet"
    good = (T(2021, 3, 5), T(2021, 3, 5), 1, 2, 1.0, 5.0, 10.0, 1, 1, f)
    data = [good,
            (T(2021, 3, 5), T(2021, 3, 5), 1, 1, 1.0, 5.0, 10.0, 1, 1, f),      # same zone
            (T(2021, 4, 5), T(2021, 4, 5), 1, 2, 1.0, 5.0, 10.0, 1, 1, f),      # month mismatch
            (T(2021, 3, 5), T(2021, 3, 5), 1, 2, 0.0, 5.0, 10.0, 1, 1, f),      # no passengers
            (T(2021, 3, 5), T(2021, 3, 5), 1, 2, 1.0, 0.0, 10.0, 1, 1, f),      # zero fare
            (T(2021, 3, 5), T(2021, 3, 5), 1, 2, 1.0, 5.0, 10.0, 4, 1, f),      # bad payment type
            (T(2021, 3, 5), T(2021, 3, 5), 1, 2, 1.0, 5.0, 10.0, 1, 2, f),      # bad rate code
            (T(2021, 3, 5), T(2021, 3, 5), None, 2, 1.0, 5.0, 10.0, 1, 1, f),   # null id
            (T(2021, 3, 5), T(2021, 3, 5), 3, 4, 1.0, 5.0, 10000.0, 1, 1, f)]   # outlier
    data += [(T(2021, 3, 5), T(2021, 3, 5), 5, 6, 1.0, 5.0, 10.0 + i % 3, 1, 1, f) for i in range(30)]
    return spark.createDataFrame(data, cols)


def test_clean_metered_rules(spark):
    got = rows(cl.clean_metered_trips(metered(spark)))
    assert got == [(1, 2)] + [(5, 6)] * 30


def test_sigma_bounds_per_file(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 100.0), ("b", 100.0)],
                               "file_path string, v double")
    b = {r["file_path"]: (r["lower_bound"], r["upper_bound"]) for r in cl.sigma_bounds(df, "v", "file_path").collect()}
    assert b["a"] == (2.0 - 3.0, 2.0 + 3.0) and b["b"] == (100.0, 100.0)
    assert cl.within_sigma(df, df, "v", "file_path").count() == 5


def test_unify_providers_and_dirty_ids(spark):
    fhv = spark.createDataFrame([(T(2021, 1, 1), T(2021, 1, 1), "7", "x"), (None, T(2021, 1, 1), "1", "2")],
                                "pickup_datetime timestamp, dropOff_datetime timestamp, PUlocationID string, DOlocationID string")
    out = cl.unify_trips({"fhv": [fhv]})
    assert out.columns == ["tlc_type", "pu_datetime", "do_datetime", "pu_location_id", "do_location_id"]
    assert rows(out, "tlc_type", "pu_location_id", "do_location_id") == [("fhv", 7, None)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (1, 3), (1, 2), (None, 4)], "pulocationID bigint, dolocationID bigint")
    top = [tuple(r) for r in pf.top_value_counts(df, "pulocationID", 2).collect()]
    assert top == [(1, 3, 60.0), (2, 1, 20.0)]
    route = pf.top_undirected_routes(df.where("pulocationID is not null")).collect()[0]
    assert (list(route["trip_route"]), route["counts"], route["percentage"]) == ([1, 2], 3, 75.0)
    areas = spark.createDataFrame([(1,), (1,), (2,), (3,)], "location_id bigint")
    allowed = spark.createDataFrame([(2,)], "location_id bigint")
    assert rows(pf.excluded_areas(areas, allowed)) == [(1,), (1,), (3,)]
    assert rows(pf.service_area_violations(df, areas, allowed)) == [(1,), (3,)]
    s = pf.column_summary(spark.range(1, 101).select(F.col("id").cast("double").alias("x")), "x").collect()[0]
    assert (s["count"], s["min"], s["max"]) == (100, 1.0, 100.0)


def test_approx_percentiles_within_rank_bound(spark):
    import bisect
    vals = [float((i * 7919) % 1000) for i in range(50000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    acc = 100
    q = pf.column_percentiles(df, "x", accuracy=acc).collect()[0]
    srt = sorted(vals)
    n = len(srt)
    for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        lo = bisect.bisect_left(srt, q[name])
        hi = bisect.bisect_right(srt, q[name])
        target = p * n
        assert lo - n / acc <= target <= hi + n / acc, (name, q[name])


def test_year_month_token_ignores_uuid_digits(spark):
    df = spark.createDataFrame(
        [("/ck/e115e50f-1234-56ab-9f00/file_month=1995-03/part-00000-8f6c-2000-11ae.parquet",),
         ("/trips/yellow_tripdata_2021-03.parquet",), ("/x/part-1234-56.parquet",)], "p string")
    got = [r[0] for r in df.select(cl.year_month_of_file("p")).collect()]
    assert got == ["1995-03", "2021-03", "1234-56"]


def test_size_proof(spark):
    from routecov.operators.sizing import broadcast_if_small, is_small
    assert is_small(spark.range(10), 10) and not is_small(spark.range(11), 10)
    assert is_small(spark.range(0), 0)
    big = spark.range(0, 10_000_000, 1, 16)
    assert not is_small(big, 1000)
    plan = big.join(broadcast_if_small(spark.range(5)), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_green_service_area_rule_with_seed_lists(spark):
    from routecov import seed
    areas = seed.area_list(spark, seed.MANHATTAN_AREAS)
    allowed = seed.area_list(spark, seed.GREEN_TAXI_MANHATTAN_AREAS)
    trips = spark.createDataFrame([(166, 41), (4, 166), (74, 103), (7, 8)], "pulocationID bigint, dolocationID bigint")
    # 4 and 103 are Manhattan zones outside the green-taxi area; 7 and 8 are not Manhattan
    assert rows(pf.service_area_violations(trips, areas, allowed)) == [(4,), (103,)]
    assert pf.excluded_areas(areas, allowed).where("location_id = 103").count() == 3  # listed three times


def test_broadcast_side_is_read_anew_and_bounded_in_bytes(spark):
    import tempfile

    from routecov.operators import sizing
    path = tempfile.mkdtemp(prefix="routecov-zones-") + "/z"
    for ids in ([1, 2], [2, 3]):
        spark.createDataFrame([(i,) for i in ids], "id long").write.mode("overwrite").parquet(path)
        side = sizing.broadcast_if_small(spark.read.parquet(path))
        assert sorted(r.id for r in spark.range(5).join(side, "id").collect()) == ids
    wide = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert sizing.text_bytes(wide) > 100_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.range(1000).join(sizing.broadcast_if_small(wide, max_bytes=50_000), "id")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_exact_percentiles(spark):
    import math
    import random

    from routecov.operators import profile as pf
    rnd = random.Random(3)
    for n in (0, 1, 2, 7, 500):
        values = [round(rnd.gauss(0, 3), 1) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(5)
        want = tuple(sorted(values)[max(1, math.ceil(q * n)) - 1] if n else None for q in (0.25, 0.5, 0.75))
        assert tuple(pf.exact_percentiles(df, "x").first()) == want


def test_month_rule_is_no_join_key(spark):
    """Pick-up time and file from two sides of a join: the month's texts must not be its sort keys."""
    pickups = spark.createDataFrame([(1, T(2021, 3, 31, 23, 59)), (2, T(2021, 4, 1)), (3, T(2021, 4, 1)), (4, None), (5, T(2021, 5, 2)), (6, T(2021, 3, 1))],
                                    "k long, pickup timestamp")
    files = spark.createDataFrame([(1, "/y/t_2021-03.parquet"), (2, "/y/t_2021-03.parquet"), (3, "/y/t_2021-04.parquet"), (4, "/y/t_2021-04.parquet"),
                                   (5, "/y/part-2021.parquet"), (6, None), (1, "/y/t_2021-02.parquet")], "k long, file_path string")
    joined = files.join(pickups.hint("merge"), "k")
    got = joined.where(cl.in_month("pickup"))
    assert rows(got, "k", "file_path") == [(1, "/y/t_2021-03.parquet"), (3, "/y/t_2021-04.parquet")]
    assert rows(got) == rows(joined.where(cl.year_month_of("pickup") == cl.year_month_of_file()))
    raw = (joined.withColumnsRenamed({"pickup": "tpep_pickup_datetime"})
           .selectExpr("*", "k AS PULocationID", "k + 1 AS DOLocationID", "1 AS passenger_count", "5.0D AS fare_amount", "10.0D + k AS total_amount",
                       "1 AS payment_type", "1 AS RatecodeID"))
    bounds = spark.createDataFrame([("/y/t_2021-03.parquet", 0.0, 99.0), ("/y/t_2021-04.parquet", 0.0, 12.5)], "file_path string, lower_bound double, upper_bound double")
    clean = cl.clean_metered_trips(raw, bounds=bounds)
    assert rows(clean) == [(1, 2)]
    for df in (got, clean):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        keys = [line.split("Inner")[0] for line in plan.splitlines() if "SortMergeJoin" in line]
        assert keys and not any("date_format" in k or "regexp_extract" in k for k in keys)
