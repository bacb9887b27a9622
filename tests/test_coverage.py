"""A9/A10/J3/T3/J2/R2-R4 on hand-made path tables (README step 4/5 examples)."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from routecov.functions.paths import is_contiguous, is_subsequence, path_text
from routecov.operators import coverage as cov
from routecov.operators import recommend as rec

STEP4 = [("1,2", 2), ("2,3", 2), ("3,4", 2), ("1,2,3", 2), ("2,3,4", 2), ("1,2,3,4", 2),
         ("4,5", 1), ("3,4,5", 1)]


def paths(spark, data):
    df = spark.createDataFrame(data, "t string, frequency bigint")
    return df.select(F.transform(F.split("t", ","), lambda x: x.cast("bigint")).alias("trip_path"),
                     "frequency")


def as_text(df, col="trip_path"):
    return df.withColumn(col, path_text(col))


def test_readme_step4_golden(spark):
    got = rows(as_text(cov.coverage_count(paths(spark, STEP4))), "trip_path", "coverage_count")
    assert got == sorted([("1,2,3,4", 12), ("1,2,3", 6), ("2,3,4", 6), ("3,4,5", 4),
                          ("1,2", 2), ("2,3", 2), ("3,4", 2), ("4,5", 1)])


@pytest.mark.parametrize("mode,expect", [
    ("subsequence", {"1,2,3": 11, "1,2,3,4": 17, "1,3": 5}),
    ("contiguous", {"1,2,3": 6, "1,2,3,4": 12, "1,3": 5}),
])
def test_containment_modes_differ_on_gapped_child(spark, mode, expect):
    got = dict(rows(as_text(cov.coverage_count(paths(spark, STEP4 + [("1,3", 5)]), mode)),
                    "trip_path", "coverage_count"))
    for k, v in expect.items():
        assert got[k] == v


def test_duplicate_path_rows_are_summed(spark):
    got = dict(rows(as_text(cov.coverage_count(paths(spark, [("4,5", 1), ("4,5", 1), ("3,4,5", 1)]))),
                    "trip_path", "coverage_count"))
    assert got == {"4,5": 2, "3,4,5": 3}


def test_id_substring_trap(spark):
    df = spark.createDataFrame([([1], [11]), ([1, 2], [11, 2]), ([1, 3], [1, 2, 3])],
                               "c array<bigint>, p array<bigint>")
    got = [tuple(r) for r in df.select(is_subsequence("c", "p"), is_contiguous("c", "p")).collect()]
    assert got == [(False, False), (False, False), (True, False)]


def test_covered_sub_paths_lists_self_first(spark):
    df = cov.covered_sub_paths(paths(spark, STEP4))
    got = {r["p"]: r["s"] for r in df.select(path_text("trip_path").alias("p"),
                                             F.transform("sub_paths", lambda x: F.array_join(x, ",")).alias("s"))
           .collect()}
    assert got["1,2,3"] == ["1,2,3", "1,2", "2,3"]
    assert got["4,5"] == ["4,5"]


def test_top_k_with_min_stops_and_tie_break(spark):
    top = rec.top_k_paths(cov.coverage_count(paths(spark, STEP4)), 2, 3)
    got = [(r["t"], r["coverage_count"]) for r in top.select(path_text("trip_path").alias("t"),
                                                             "coverage_count").collect()]
    assert got == [("1,2,3,4", 12), ("1,2,3", 6)]


def test_readable_paths_keep_order_and_mark_missing(spark):
    lookup = spark.createDataFrame([(1, "Penn Station/Madison Sq West"), (2, "Flatiron")],
                                   "location_id bigint, zone string")
    df = paths(spark, [("1,2,9", 3), ("2,1", 1)])
    got = rows(rec.readable_paths(df, rec.zone_names(lookup)).select("route"))
    assert got == [("Flatiron,Penn Station",), ("Penn Station,Flatiron,NA",)]


def test_coverage_percentage_and_overall(spark):
    pf = paths(spark, STEP4)
    covdf = cov.coverage_count(pf)
    pct = rec.coverage_percentage(rec.top_k_paths(covdf, 1, 2), pf)
    assert [r["coverage_percentage"] for r in pct.collect()] == [round(12 / 14 * 100, 2)]
    overall = rec.overall_coverage(rec.top_k_paths(covdf, 1, 2), pf).collect()[0]
    assert (overall["covered_trips"], overall["total_trips"]) == (12, 14)
    assert overall["coverage_percentage"] <= 100


def test_sub_path_frequency(spark):
    got = dict(rows(as_text(cov.sub_path_frequency(paths(spark, [("1,2,3", 2), ("2,3", 1)])), "sub_path"),
                    "sub_path", "frequency"))
    assert got == {"1,2": 2, "2,3": 3, "1,2,3": 2}


def test_coverage_plan_has_no_cartesian_or_python(spark):
    plan = cov.coverage_count(paths(spark, STEP4))._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_repeated_nodes_count_child_once(spark):
    got = dict(rows(as_text(cov.coverage_count(paths(spark, [("1,2,1,3", 1), ("1,3", 4), ("2,1", 2)]))),
                    "trip_path", "coverage_count"))
    assert got == {"1,2,1,3": 7, "1,3": 4, "2,1": 2}


def _brute_coverage(table, contiguous=False):
    def sub(c, p):
        if contiguous:
            return any(p[i:i + len(c)] == c for i in range(len(p) - len(c) + 1))
        it = iter(p)
        return all(x in it for x in c)
    merged = {}
    for path, f in table:
        merged[path] = merged.get(path, 0) + f
    return {",".join(map(str, p)): sum(f for c, f in merged.items() if sub(list(c), list(p)))
            for p in merged}


@pytest.mark.parametrize("seed,mode", [(11, "subsequence"), (12, "subsequence"), (13, "contiguous")])
def test_coverage_matches_brute_force(spark, seed, mode):
    import random
    rnd = random.Random(seed)
    table = []
    for _ in range(60):
        n = rnd.randint(1, 6)
        table.append((tuple(rnd.randrange(8) for _ in range(n)), rnd.randint(1, 9)))
    data = [(",".join(map(str, p)), f) for p, f in table]
    got = dict(rows(as_text(cov.coverage_count(paths(spark, data), mode)), "trip_path", "coverage_count"))
    want = _brute_coverage(table, contiguous=(mode == "contiguous"))
    assert got == want
    assert all(got[k] >= dict(data).get(k, 0) for k in got)


def test_endpoint_pairs_of_a_long_path(spark):
    import time
    df = spark.createDataFrame([(list(range(1000)),), ([1, 2, 1, 3],)], "parent array<long>")
    t = time.time()
    got = cov.endpoint_pairs(df)
    assert got.where("size(parent) = 1000").count() == 500_500 and time.time() - t < 60
    assert sorted((r["first"], r["last"]) for r in got.where("size(parent) = 4").collect()) == [
        (1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, 3)]


@pytest.mark.parametrize("seed,zones", [(1, 3), (2, 8), (3, 50)])
def test_sub_paths_match_brute_force(spark, seed, zones):
    """R4 over paths that repeat zones and whole slices."""
    import random
    rnd = random.Random(seed)
    table = [(tuple(rnd.randrange(zones) for _ in range(rnd.randint(1, 9))), rnd.randint(1, 9)) for _ in range(60)]
    df = spark.createDataFrame([(list(p), f) for p, f in table] + [(None, 1), ([], 2)], "trip_path array<long>, frequency long").repartition(3)
    for least in (1, 2, 4):
        want = {}
        for p, f in table:
            for s in {p[i:j] for i in range(len(p)) for j in range(i + least, len(p) + 1)}:
                want[s] = want.get(s, 0) + f
        got = {tuple(r.sub_path): r.frequency for r in cov.sub_path_frequency(df, least).collect()}
        assert got == want, least


def test_contiguous_pairs_beyond_the_broadcast_bound(spark, monkeypatch):
    data = [("1,2,1,2,1", 3), ("1,2", 4), ("2,1", 5), ("1,2,1", 6), ("12", 7), ("1", 8)]
    want = rows(as_text(cov.coverage_count(paths(spark, data), "contiguous")), "trip_path", "coverage_count")
    assert dict(want) == {"1,2,1,2,1": 26, "1,2": 12, "2,1": 13, "1,2,1": 23, "12": 7, "1": 8}
    monkeypatch.setattr(cov, "BROADCAST_MAX_ROWS", 0)
    assert rows(as_text(cov.coverage_count(paths(spark, data), "contiguous")), "trip_path", "coverage_count") == want
    assert rows(as_text(cov.coverage_count(paths(spark, data))), "trip_path", "coverage_count")


def test_hot_end_points_are_split(spark, monkeypatch):
    """Half of the parents' rows under one end-point key, children above the broadcast bound."""
    monkeypatch.setattr(cov, "BROADCAST_MAX_ROWS", 0)
    table = [((1, 2, k, 3), 1) for k in range(100, 160)] + [((k, k + 1), 1) for k in range(200, 230)] + [((2, 3), 5)]
    got = dict(rows(as_text(cov.coverage_count(paths(spark, [(",".join(map(str, p)), f) for p, f in table]))), "trip_path", "coverage_count"))
    assert got == _brute_coverage(table)


def test_share_counts_trips_without_a_path(spark):
    pf = paths(spark, [("1,2", 6)])
    lost = spark.createDataFrame([(1, 9, 4)], "pu_location_id bigint, do_location_id bigint, frequency bigint")
    assert [r.coverage_percentage for r in rec.coverage_percentage(cov.coverage_count(pf), pf, lost).collect()] == [60.0]


def test_slices_of_a_long_path_are_not_cubic(spark):
    import time
    df = spark.createDataFrame([(list(range(600)), 1)], "trip_path array<long>, frequency long")
    t = time.time()
    assert cov.slices(df, "trip_path", 2, 2).count() == 600 * 599 // 2 and time.time() - t < 60
