"""Moments per file, merged and extended; raw rows read once."""

import random
import statistics
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from routecov.operators import clean as cl
from routecov.operators import file_moments as fm
from routecov.sources import drift, readers as rd


def test_merged_equals_whole(spark):
    rnd = random.Random(4)
    data = [(rnd.choice("ab"), rnd.randrange(5), rnd.choice([None, rnd.gauss(1e6, 3)])) for _ in range(400)]
    data += [("c", 1, 5.0), ("d", 1, None), (None, 2, 1.0), (None, 3, 4.0)]
    df = spark.createDataFrame(data, "g string, part int, v double")
    parts = fm.moments(df, "v", ["g", "part"])
    got = {r.g: r for r in fm.sigma_bounds(fm.merged(parts, ["g"])).collect()}
    for g in ("a", "b", "c", "d", None):
        values = [v for x, _, v in data if x == g and v is not None]
        assert got[g].n == len(values)
        assert got[g].mean == (pytest.approx(statistics.fmean(values), rel=1e-12) if values else None)
        assert got[g].stddev == (pytest.approx(statistics.stdev(values), rel=1e-6) if len(values) > 1 else None)


def test_side_table_reads_new_files_only(spark):
    base, table = tempfile.mkdtemp(prefix="routecov-moments-") + "/raw", tempfile.mkdtemp(prefix="routecov-moments-") + "/side"
    asked = []

    def read(paths):
        asked.append(len(paths))
        return rd.read_tagged(spark, paths)

    def put(name, values):
        spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).write.mode("overwrite").parquet(f"{base}/{name}")

    def bounds():
        known, new = fm.update(spark, fm.listing(spark, base), table, "v", read)
        return {r.n: (r.mean, r.m2) for r in known.collect()}, new

    put("one", [1.0, 2.0, 3.0])
    put("two", [5.0])
    assert bounds() == ({3: (2.0, 2.0), 1: (5.0, 0.0)}, 2)
    assert bounds() == ({3: (2.0, 2.0), 1: (5.0, 0.0)}, 0)
    put("three", [0.0, 4.0])
    assert bounds() == ({3: (2.0, 2.0), 1: (5.0, 0.0), 2: (2.0, 8.0)}, 1)
    put("two", [1.0, 1.0, 1.0, 1.0, 9.0])  # replaced: a new version
    assert bounds()[0] == {3: (2.0, 2.0), 2: (2.0, 8.0), 5: (2.6, pytest.approx(51.2))}
    assert asked == [2, 1, 1]


def _metered(spark, seen=None):
    rnd = random.Random(1)
    data = [(f"/y_2020-0{rnd.randint(1, 3)}.parquet", rnd.randint(1, 5), rnd.randint(1, 5), rnd.gauss(10, 2) if rnd.random() < 0.95 else 500.0) for _ in range(500)]
    rdd = spark.sparkContext.parallelize(data, 3)
    if seen is not None:
        def count(part):
            for x in part:
                seen.add(1)
                yield x
        rdd = rdd.mapPartitions(count)
    raw = spark.createDataFrame(rdd, "file_path string, PULocationID int, DOLocationID int, total_amount double")
    return data, raw.withColumns({"tpep_pickup_datetime": F.expr("cast(concat(substring(file_path, 4, 7), '-15 10:00:00') as timestamp_ntz)"),
                                  "fare_amount": F.lit(1.0), "payment_type": F.lit(1), "RatecodeID": F.lit(1), "passenger_count": F.lit(1)})


def test_bounds_read_the_raw_rows_once(spark):
    """500 raw rows: 500 for the bounds while the plan is built, 500 for the cleaning."""
    seen = spark.sparkContext.accumulator(0)
    _, raw = _metered(spark, seen)
    clean = cl.clean_metered_trips(raw)
    assert seen.value == 500
    clean.count()
    assert seen.value == 1000


def test_given_bounds_take_the_place_of_a_pass(spark):
    seen = spark.sparkContext.accumulator(0)
    _, raw = _metered(spark, seen)
    want = rows(cl.clean_metered_trips(raw))
    known = fm.sigma_bounds(fm.moments(raw, "total_amount", ["file_path"])).select("file_path", "lower_bound", "upper_bound")
    known = spark.createDataFrame(known.collect())
    before = seen.value
    assert rows(cl.clean_metered_trips(raw, bounds=known)) == want and want
    assert seen.value == before + 500


def test_files_are_grouped_by_their_footers(spark):
    base = tempfile.mkdtemp(prefix="routecov-drift-")
    kinds = ["int", "int", "bigint", "string", "int"]
    for i, kind in enumerate(kinds):
        df = spark.range(i + 1).select(F.col("id").cast(kind).alias("PULocationID" if i % 2 else "pulocationid"), F.lit(float(i)).alias(f"extra{i % 2}"))
        df.coalesce(1).write.parquet(f"{base}/m{i}")
    files = drift.files_below(spark, base)
    assert len(files) == 5 and not any("_SUCCESS" in f for f in files) and drift.files_below(spark, base + "/none") == []
    groups = drift.schema_groups(spark, files, ["PULocationID"])
    assert [len(paths) for paths, _ in groups] == [3, 1, 1]
    assert [len(paths) for paths, _ in drift.schema_groups(spark, files)] == [2, 1, 1, 1]
    got = drift.read_by_schema(spark, files, lambda df: df.select(cl.to_long("PULocationID").alias("z")), ["PULocationID"])
    assert rows(got) == sorted((z,) for i in range(5) for z in range(i + 1))
    with pytest.raises(ValueError):
        drift.read_by_schema(spark, [], lambda df: df)
