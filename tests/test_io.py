"""S*, K*: readers and writers round trip in a fresh folder; layouts."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from routecov import schemas, seed
from routecov.sinks import writers as wr
from routecov.sources import readers as rd


def fresh():
    return tempfile.mkdtemp(prefix="routecov-io-")


def test_sorted_single_file_tsv_with_unquoted_empty(spark):
    d = fresh() + "/out"
    df = spark.createDataFrame([("Queens", "2,27"), ("Brooklyn", ""), ("Bronx", "46")],
                               "borough string, location_ids string")
    wr.write_sorted_tsv(df, d, ["borough"], empty_value="")
    files = glob.glob(d + "/part-*")
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    assert lines == ["borough\tlocation_ids", "Bronx\t46", "Brooklyn\t", "Queens\t2,27"]


def test_clean_trip_layouts(spark):
    d = fresh()
    t = spark.createDataFrame([("yellow", None, None, 1, 2), ("fhv", None, None, 3, 4)], schemas.TRIP)
    wr.write_clean_trips(t, d + "/all", partitions=4)
    assert len(glob.glob(d + "/all/part-*.parquet")) <= 4
    assert rows(rd.read_clean_trips(spark, d + "/all"), "pu_location_id") == [(1,), (3,)]
    wr.write_clean_trips(t, d + "/by", by_provider=True, partitions=2)
    assert sorted(p for p in os.listdir(d + "/by") if p.startswith("tlc_type=")) == ["tlc_type=fhv", "tlc_type=yellow"]
    got = rd.read_partitioned(spark, d + "/by", tlc_type="yellow")
    assert rows(got, "pu_location_id") == [(1,)]
    check = wr.verify_roundtrip(spark, t, d + "/all").collect()[0]
    assert check["counts_match"] and check["written_count"] == 2


def test_month_range_reader(spark):
    assert rd.month_paths("/b", "green", "2020-11", "2021-02") == [
        "/b/green/2020/11", "/b/green/2020/12", "/b/green/2021/01", "/b/green/2021/02"]
    d = fresh() + "/m"
    df = spark.createDataFrame([("yellow", 2020, 12, 1), ("yellow", 2021, 1, 2), ("yellow", 2021, 3, 3),
                                ("green", 2021, 1, 4)], "tlc_type string, year int, month int, v int")
    wr.write_partitioned(df, d, ["tlc_type", "year", "month"])
    got = rd.read_months(spark, d, "yellow", "2020-12", "2021-02")
    assert rows(got, "v") == [(1,), (2,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_tagged_read_and_csv(spark):
    d = fresh()
    spark.range(3).write.parquet(d + "/p")
    tagged = rd.read_tagged(spark, d + "/p")
    assert tagged.where(F.col("file_path").contains("/p/part-")).count() == 3
    spark.createDataFrame([(1, "a")], "id int, s string").write.option("header", True).csv(d + "/c")
    assert rows(rd.read_csv(spark, d + "/c", schema="id int, s string")) == [(1, "a")]
    assert rd.read_csv(spark, d + "/c", infer_schema=True).dtypes == [("id", "int"), ("s", "string")]


def test_seed_lists(spark):
    iso = seed.isolated_zones(spark, "Manhattan")
    assert rows(iso, "location_id") == [(103,), (104,), (105,), (153,), (194,), (202,)]
    lookup = spark.createDataFrame([(103, "Manhattan"), (4, "Manhattan"), (46, "Bronx")],
                                   "location_id bigint, borough string")
    assert rows(seed.connected_zones(lookup, seed.isolated_zones(spark), "Manhattan")) == [("Manhattan", 4)]


def test_hot_key_is_spread_over_several_files(spark):
    d = fresh() + "/hot"
    hot = spark.range(0, 200000, 1, 8).select(F.lit("yellow").alias("tlc_type"), F.lit(None).cast("timestamp").alias("pu_datetime"),
                                   F.lit(None).cast("timestamp").alias("do_datetime"),
                                   F.lit(1).cast("bigint").alias("pu_location_id"),
                                   (F.col("id") % 2 + 2).alias("do_location_id"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        wr.write_clean_trips(hot, d + "/rebalanced")
        wr.write_clean_trips(hot, d + "/counted", partitions=16)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for sub in ("counted", "rebalanced"):
        back = spark.read.parquet(d + "/" + sub)
        assert back.count() == 200000
        files = back.where("do_location_id = 2").select("_metadata.file_path").distinct().count()
        assert files > 1, sub  # one hot pair is written by several tasks


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_trips_are_counted_in_place(spark):
    """K4/K5: no exchange below A1's aggregate over the bucketed pairs; a hot pair lies apart."""
    from routecov.operators.frequency import trip_frequency
    from routecov.sinks import bucketed as bk
    d = fresh()
    t = spark.range(6000).select(
        F.when(F.col("id") % 50 == 0, F.lit("a")).otherwise("b").alias("tlc_type"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 500 == 1, F.lit(None)).otherwise(F.col("id") % 40).cast("bigint").alias("pu_location_id"),
        F.when(F.col("id") % 3 == 0, F.lit(2)).otherwise(F.col("id") % 17).cast("bigint").alias("do_location_id"))
    n = bk.write_bucketed_trips(t, d, "io_trips", 4)
    assert n["pairs"] + n["hot_pairs"] == 6000 and n["hot_pairs"] == t.where("pu_location_id is null or (pu_location_id = 1 and do_location_id = 2)").count()
    assert rows(bk.bucketed_trip_frequency(spark, "io_trips")) == rows(trip_frequency(t))
    assert bk.read_bucketed_trips(spark, "io_trips").exceptAll(t).isEmpty()
    plan = _plan(trip_frequency(spark.table("io_trips_pairs")))
    assert "Exchange" not in plan and "Bucketed: true" in plan and "HashAggregate" in plan
    assert len({f.split("_")[-1].split(".")[0] for f in glob.glob(d + "/pairs/part-*.parquet")}) <= 4
    for k in ("pairs", "hot_pairs"):
        spark.sql(f"DROP TABLE io_trips_{k}")


def test_month_folders_with_gaps(spark):
    d = fresh()
    df = spark.createDataFrame([("2020", "11", 1), ("2020", "12", 2), ("2021", "02", 3), ("2021", "02", 4)], "y string, m string, v int")
    wr.write_month_folders(df, d + "/green", "y", "m")
    assert sorted(os.listdir(d + "/green")) == ["2020", "2021"] and sorted(os.listdir(d + "/green/2021")) == ["02"]
    assert rows(rd.read_months(spark, d, "green", "2020-12", "2021-06", layout="folders"), "v") == [(2,), (3,), (4,)]
    assert [p[-7:] for p in rd.missing_months(spark, d, "green", "2020-11", "2021-03")] == ["2021/01", "2021/03"]
    import pytest
    with pytest.raises(ValueError):
        rd.read_months(spark, d, "green", "2022-01", "2022-02", layout="folders")


def test_only_scratch_folders_are_deleted(spark):
    import pytest
    from routecov.session import delete_path, scratch_path
    path = scratch_path(spark, "gone")
    spark.range(2).write.parquet(path)
    delete_path(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
    with pytest.raises(ValueError):
        delete_path(spark, fresh())
