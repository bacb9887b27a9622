"""R6 end to end on hand-made inputs (README step 3-5 shape) and edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from routecov import schemas
from routecov.functions.paths import path_text
from routecov.operators import graph as gr
from routecov.plans.pipeline import recommend_routes


def _inputs(spark, pairs):
    t = dt.datetime(2021, 1, 1)
    trips = spark.createDataFrame([("yellow", t, t, a, b) for a, b, n in pairs for _ in range(n)], schemas.TRIP)
    chain = spark.createDataFrame([(a, a + 1, 10) for a in range(1, 5)], "src bigint, dst bigint, weight bigint")
    edges = gr.undirected(chain)
    lookup = spark.createDataFrame([(1, "Penn Station/Madison Sq West"), (2, "Flatiron"), (3, "Gramercy"),
                                    (4, "Kips Bay"), (5, "Murray Hill")], "location_id bigint, zone string")
    return trips, edges, lookup


def test_pipeline_golden(spark):
    trips, edges, lookup = _inputs(spark, [(1, 4, 2), (2, 4, 1), (1, 2, 1), (3, 5, 1), (2, 2, 7), (9, 1, 3)])
    iso = spark.createDataFrame([(5,)], "location_id bigint")
    rep = recommend_routes(trips, edges, lookup, isolated=iso, k=2, m=3)
    freq = {(r[0], r[1]): r[2] for r in rep.trip_frequency.collect()}
    assert freq == {(1, 4): 2, (2, 4): 1, (1, 2): 1, (2, 2): 7}  # 9 is no node, 5 is isolated
    got = [(r["route"], r["coverage_count"], r["coverage_percentage"])
           for r in rep.route_percentage.orderBy(F.desc("coverage_count")).collect()]
    # paths 1,2,3,4 (2) ⊇ 2,3,4 (1) and 1,2 (1); total path trips = 4
    assert got == [("Penn Station,Flatiron,Gramercy,Kips Bay", 4, 100.0), ("Flatiron,Gramercy,Kips Bay", 1, 25.0)]
    assert sorted(r[0] for r in rep.coverage.select(path_text("trip_path")).collect()) == ["1,2", "1,2,3,4", "2,3,4"]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_pipeline_on_empty_trips(spark):
    trips, edges, lookup = _inputs(spark, [])
    rep = recommend_routes(trips, edges, lookup)
    assert rep.trip_frequency.count() == 0
    assert rep.path_frequency.count() == 0 and rep.route_percentage.count() == 0
